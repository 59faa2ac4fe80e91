from __future__ import annotations

import pickle
import random
import zlib

import numpy as np

from pyspark.sql import functions as F

from trackloom.llm import toxicity


def made(n: int, seed: int):
    r = random.Random(seed)
    tell = {"en": ["the", "and", "of"], "de": ["der", "und", "nicht"]}
    bad = {"en": ["bozo", "dimwit"], "de": ["dummkerl", "dummsack", "dummtropf"]}
    rows = []
    for i in range(n):
        lang = r.choice(["en", "de"])
        words = [r.choice(tell[lang]) if r.random() < 0.3 else "".join(r.choices("abcdefghi", k=5)) for _ in range(r.randrange(5, 80))]
        toxic = int(r.random() < 0.3)
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(bad[lang]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_accuracy(spark):
    rows = made(1500, 1)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train_on(df, df)
    out = toxicity.score(df, model, keep=["doc_id", "toxic"]).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    assert {r["doc_id"] for r in out if r["held"]} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    held = [r for r in out if r["held"]]
    assert sum((r["score"] >= 0.5) == bool(r["toxic"]) for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


def test_scores_depend_on_the_text_alone(spark, docs, data):
    model = toxicity.train_on(docs, spark.read.parquet(f"{data}/labels.parquet"))
    plain = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "doc_id": F.col("doc_id") + 1000}).repartition(7)
    moved = {r["doc_id"] - 1000: r["score"] for r in toxicity.score(other, model, keep=["doc_id"]).collect()}
    assert all(abs(plain[d] - moved[d]) < 1e-4 for d in plain) and len(plain) == len(moved)


def test_odd_rows_and_labels(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 0), (4, 0), (8, 1)], "doc_id long, toxic int")
    model = toxicity.train_on(odd, labels)
    out = toxicity.score(odd, model)
    assert out.columns == [*(c for c in odd.columns if c != "score"), "score"]
    assert all(0 <= r["score"] <= 1 for r in out.collect())
    empty = toxicity.train_on(odd, labels.limit(0))
    assert {r["score"] < 0.5 for r in toxicity.score(odd, empty).collect()} == {True}
    assert toxicity.score(odd.limit(0), empty).count() == 0
    assert toxicity.language_of(toxicity.words_of("der Hund und die Katze")) == "de" and toxicity.language_of([]) == "other"


def plain_response(m: toxicity.Model, doc: np.ndarray) -> np.ndarray:
    """Largest response of each filter, window by window; windows begin at words and run on into padding."""
    vec = [sum(m.table[b] for b in word) for word in doc] + [m.table[toxicity.BUCKETS]] * 2
    return np.array([
        max(sum(vec[i + j] @ w[j][:, f] for j in range(len(w))) for i in range(len(doc))) + m.bias[k * toxicity.FILTERS + f]
        for k, w in enumerate(m.filters) for f in range(toxicity.FILTERS)
    ])


def small_model() -> tuple[toxicity.Model, list[np.ndarray]]:
    m = toxicity.Model.fresh(3)
    m.table, m.filters = m.table.astype(np.float64) * 30, [w.astype(np.float64) for w in m.filters]
    m.bias, m.out = m.bias.astype(np.float64), m.out.astype(np.float64)
    texts = ["one", "", "some words that go on", "bozo and dimwit and bozo", "a b c d e f g h i j"]
    return m, [toxicity.ids_of(toxicity.words_of(t)) for t in texts]


def test_forward_pass_is_a_plain_convolution():
    m, docs = small_model()
    want = np.stack([plain_response(m, d) for d in docs])
    assert np.allclose(m.pooled(docs)[0], want)
    assert np.allclose(m.logits(docs), np.maximum(want, 0) @ m.out + m.shift)


def test_gradients_are_finite_differences():
    m, docs = small_model()
    y, weight = np.array([0, 1, 1, 0, 1]), np.array([1.0, 2.0, 0.5, 1.0, 1.5])

    def loss() -> float:
        p = 1 / (1 + np.exp(-m.logits(docs)))
        return float((weight * -np.where(y == 1, np.log(p), np.log(1 - p))).mean())

    def slope(x: np.ndarray, at: tuple) -> float:
        old, e = x[at], 1e-6
        x[at] = old + e
        up = loss()
        x[at] = old - e
        down = loss()
        x[at] = old
        return (up - down) / (2 * e)

    g = toxicity.gradients(m, docs, y, weight)
    r = np.random.default_rng(0)
    for k, w in enumerate(m.filters):
        for at in [tuple(r.integers(0, n) for n in w.shape) for _ in range(12)]:
            assert abs(slope(w, at) - g.filters[k][at]) < 1e-4
    for x, got in ((m.bias, g.bias), (m.out, g.out)):
        assert all(abs(slope(x, (i,)) - got[i]) < 1e-4 for i in range(len(x)))
    for i, row in enumerate(g.rows):
        if row != toxicity.BUCKETS:
            assert all(abs(slope(m.table, (row, c)) - g.table[i, c]) < 1e-4 for c in (0, 3))


def test_training_reads_sampled_rows_only(spark):
    """Documents that repeat an id bring one row, and the corpus scan isn't one task."""
    docs = spark.createDataFrame([(i % 40, f"{'bozo' if i % 2 else 'fine'} word {i}") for i in range(400)], "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    seen = spark.sparkContext.statusTracker
    spark.sparkContext.setJobGroup("tox", "training")
    toxicity.train_on(docs, labels)
    jobs = seen().getJobIdsForGroup("tox")
    sizes = [seen().getStageInfo(s).numTasks for j in jobs for s in seen().getJobInfo(j).stageIds if seen().getStageInfo(s)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 6 in sizes


def test_all_labelled_rows_are_learnt(spark):
    """One word is toxic only in rows that come after the first 3,000 toxic ones by a hash of the id."""
    ids = spark.range(9000).where(~toxicity.held_out(F.col("id"))).withColumn("toxic", (F.col("id") % 2).cast("int"))
    later = {r["id"] for r in ids.where("toxic = 1").orderBy(F.xxhash64("id"), "id").offset(3000).collect()}
    assert len(later) > 400
    r = random.Random(5)
    rows = []
    for i in range(9000):
        words = ["".join(r.choices("abcdefghi", k=4)) for _ in range(4)]
        rows.append((i, " ".join(words + ["zorbling" if i in later else "bozo"] * (i % 2)), i % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train_on(df, df)
    news = spark.createDataFrame([(k, f"{r.choice('abcd')}bca zorbling hgfe") for k in range(20)] + [(99, "abca dehi hgfe")], "doc_id long, text string")
    score = {x["doc_id"]: x["score"] for x in toxicity.score(news, model).collect()}
    assert all((s >= 0.5) == (k != 99) for k, s in score.items())


def test_shards_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(made(900, 4), "doc_id long, text string, toxic int")
    one, other = (toxicity.train_on(x, x.repartition(3), shard_rows=100) for x in (df.coalesce(1), df.repartition(7)))
    assert np.array_equal(one.table, other.table) and all(map(np.array_equal, one.filters, other.filters))
    assert one.centre == other.centre and set(one.centre) >= {"", "en", "de"}
    out = toxicity.score(df, one, keep=["doc_id", "toxic"]).where(toxicity.held_out(F.col("doc_id"))).collect()
    assert sum((x["score"] >= 0.5) == bool(x["toxic"]) for x in out) / len(out) > 0.9


def test_changes_lead_from_state_to_state():
    docs = [toxicity.ids_of(toxicity.words_of(t)) for t in ("bozo and more", "fine words", "", "a bozo")]
    before, after = (toxicity.State.fresh(3) for _ in range(2))
    toxicity.fit(after, docs, np.array([1, 0, 0, 1]), np.ones(4), epochs=3)
    before.add(*toxicity.changes(before, after))
    assert np.allclose(before.model.table, after.model.table, atol=1e-6) and np.allclose(before.dense(), after.dense(), atol=1e-6)
    assert np.allclose(before.model.logits(docs), after.model.logits(docs), atol=1e-4)


def test_cut_counts_every_row():
    m = toxicity.Model.fresh(1)
    toxicity.calibrate(m, [("en", 0, 10, 9), ("en", 0, 30, 1), ("en", 1, 20, 5), ("en", 1, 40, 3), ("de", 1, 100, 2)])
    assert m.centre["en"] == (11 + 20) / 2 / toxicity.STEPS and "de" not in m.centre and m.centre[""] == m.centre["en"]


def test_model_is_small_enough_for_the_driver():
    """Results and broadcasts of several megabytes cost the driver many times their size."""
    assert len(pickle.dumps(toxicity.Model.fresh(1))) < 3_000_000
