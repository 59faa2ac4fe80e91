from __future__ import annotations

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from trackloom.llm import quality


def made(n: int, seed: int):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(r.choices("abcdefghi", k=r.randrange(2, 9))) for _ in range(r.randrange(5, 80))]
        good, kind = int(r.random() < 0.8), r.randrange(3)
        if not good:
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w for w in words for _ in range(4)] if kind == 1 else [w + r.choice(["###", "%%"]) for w in words]
        rows.append((i, " ".join(words), good))
    return rows


def test_held_out_accuracy(spark):
    rows = made(1500, 1)
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    out = quality.score(df, quality.train_on(df, df, most=300), keep=["doc_id", "quality"]).withColumn("held", quality.held_out(F.col("doc_id"))).collect()
    assert {r["doc_id"] for r in out if r["held"]} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    held = [r for r in out if r["held"]]
    assert sum((r["score"] >= 0.7) == bool(r["quality"]) for r in held) / len(held) > 0.97


def test_votes_equal_plain_loops():
    rows = made(260, 2)
    m = quality.train([t for _, t, _ in rows[:200]], [y for *_, y in rows[:200]], [1.0 + 3 * y for *_, y in rows[:200]])
    matrix = np.stack([quality.Tokens().vector(t) for _, t, _ in rows[200:]])
    for got, v in zip(m.scores(matrix), matrix):
        latent = [sum(v[f] * m.axes[f, d] for f in np.flatnonzero(v)) for d in range(m.axes.shape[1])]
        size = math.sqrt(sum(x * x for x in latent))
        sims = sorted(((max(0.0, sum(a * b for a, b in zip(latent, u)) / size), k) for k, u in enumerate(m.vectors)), reverse=True)
        near = [(s, k) for s, k in sims if s >= sims[quality.NEIGHBOURS - 1][0] - 1e-12]
        total = sum(s**8 * m.weight[k] for s, k in near)
        assert abs(got - sum(s**8 * m.weight[k] * m.labels[k] for s, k in near) / total) < 1e-5


def test_features():
    word = lambda t: quality.features_of(t)
    assert word(b"Ab") == word(b"aB")[:1] + word(b"Ab")[1:] and word(b"AB")[2] != word(b"Ab")[2] != word(b"ab")[2]
    assert word(b"ab!!")[1] != word(b"ab")[1] and word(b"|")[2] == word(b"##")[2]
    t = quality.Tokens(most=4)
    v = [t.vector("a b c d e f g a a"), t.vector("a b c d e f g a a"), quality.Tokens().vector("a b c d e f g a a")]
    assert np.array_equal(v[0], v[1]) and np.array_equal(v[0], v[2]) and abs(np.linalg.norm(v[0]) - 1) < 1e-12
    assert v[0][quality._SAME] > 0 and not quality.Tokens().vector(" \n").any()


def test_scores_depend_on_the_text_alone(spark, docs, data):
    model = quality.train_on(docs, spark.read.parquet(f"{data}/labels.parquet"))
    plain = {r["doc_id"]: r["score"] for r in quality.score(docs, model, keep=["doc_id"]).collect()}
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "doc_id": F.col("doc_id") + 1000}).repartition(7)
    moved = {r["doc_id"] - 1000: r["score"] for r in quality.score(other, model, keep=["doc_id"], block=3).collect()}
    assert all(abs(plain[d] - moved[d]) < 1e-6 for d in plain) and len(plain) == len(moved)


def test_odd_rows_and_labels(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 0), (4, 0), (8, 1)], "doc_id long, quality int")
    model = quality.train_on(odd, labels)
    out = quality.score(odd, model)
    assert out.columns == [*(c for c in odd.columns if c != "score"), "score"]
    assert all(0 <= r["score"] <= 1 for r in out.collect()) and out.count() == odd.count()
    assert len({r["score"] for r in out.where("doc_id in (3, 4, 5)").collect()}) == 1
    empty = quality.train_on(odd, labels.limit(0))
    assert {r["score"] for r in quality.score(odd, empty).collect()} == {0.5}
    assert quality.score(odd.limit(0), empty).count() == 0
