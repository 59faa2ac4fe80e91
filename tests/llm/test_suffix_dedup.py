from __future__ import annotations

import hashlib
import random

import pytest

from trackloom.llm import suffix_dedup as sd


def brute(rows: list[tuple[int, bytes]], length: int = 100) -> dict[int, tuple]:
    seen, out = set(), {}
    for d, b in sorted(rows):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_against_brute_force(docs, texts):
    got = {r["doc_id"]: tuple(r)[1:] for r in sd.report(docs).collect()}
    assert got == brute([(d, t.encode()) for d, t in texts.items()])


@pytest.mark.parametrize("batch, length", [(2_000_000, 100), (700, 100), (700, 40), (5000, 33)])
def test_hot_passages_runs_and_pieces(spark, batch, length):
    """Passages around 100 bytes in many documents, runs of one letter, periods, long documents cut to pieces."""
    r = random.Random(1)
    noise = lambda n: "".join(r.choices("abcdefgh ", k=n))
    passages = [noise(n) for n in (99, 100, 101, 130, 400)]
    rows = [(i, noise(r.randrange(120)) + r.choice(passages) + noise(r.randrange(120)) + r.choice(passages)) for i in range(80)]
    rows += [(200, "a" * 500), (201, "a" * 300 + "b"), (202, "ab" * 200), (203, noise(3000) + passages[4] + noise(3000)), (204, "é" * 90 + passages[3]), (205, "x" * 99), (206, "x" * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute([(d, t.encode()) for d, t in rows], length)
    got = {x["doc_id"]: tuple(x)[1:] for x in sd.report(df, length=length, batch_bytes=batch).collect()}
    assert got == want


def test_one_trigger_with_many_phrases(spark):
    """One passage goes on differently in every document: all of its edge phrases share a trigger and one side."""
    r = random.Random(2)
    noise = lambda n: "".join(r.choices("abcdefgh ", k=n))
    ends = [noise(70) for _ in range(40)]
    passage = noise(150)
    rows = [(i, noise(80) + passage[r.randrange(60) :] + r.choice(ends)[: r.randrange(70)] + noise(60)) for i in range(600)]
    got = {x["doc_id"]: tuple(x)[1:] for x in sd.report(spark.createDataFrame(rows, "doc_id long, text string"), batch_bytes=4000).collect()}
    assert got == brute([(d, t.encode()) for d, t in rows])


def test_refinement_shuffles_once(spark):
    """All rounds of the refinement run on the partitioning that they are given."""
    schema = "root long, k1 long, k2 long, low int, high int, a int, b int, left binary, right binary, doc long, at long"
    plan = sd.refined(spark.createDataFrame([], schema).repartition(8, "root"), 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Window ") >= 7


def test_spans_and_odd_rows(spark, odd):
    rows = sd.report(odd, with_spans=True).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 10)}
    assert by[1]["n_removed"] == 0 and by[2]["n_removed"] == by[2]["n_bytes"] and by[2]["n_spans"] == 1 and by[13]["n_removed"] == by[13]["n_bytes"]
    assert by[3]["n_bytes"] == 0 and by[11]["spans"][0]["start"] == 1
    assert sd.report(odd.limit(0)).count() == 0
