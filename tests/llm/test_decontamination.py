from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from trackloom.llm import decontamination as dec


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    wins = [(i, w[k : k + 13]) for i, t in items if (w := words(t)) for k in range(max(1, len(w) - 12))]
    out = []
    for d, t in docs:
        w = words(t)
        hit, ids = set(), set()
        for i, x in wins:
            for k in range(len(w) - len(x) + 1):
                if w[k : k + len(x)] == x:
                    hit.update(range(k, k + len(x)))
                    ids.add(str(i))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [50_000, 40])
def test_against_brute_force(spark, data, docs, texts, block):
    """The same with one block of windows, and with many that are sent one after another."""
    items = spark.read.parquet(f"{data}/benchmark.parquet").limit(8)
    listed = [(r["item_id"], r["text"]) for r in items.collect()]
    some = docs.where("doc_id < 60")
    planted = spark.createDataFrame([(1000, "x " * 30 + listed[0][1] + " y" * 30), (1001, "z " * 900 + listed[1][1].upper()), (1002, listed[2][1] + ". " + listed[2][1])], "doc_id long, text string")
    both = some.select("doc_id", "text").union(planted)
    got = sorted((tuple(r) for r in dec.report(both, items, block_windows=block).collect()), key=repr)
    assert got == brute([(r["doc_id"], r["text"]) for r in both.collect()], listed)


def test_many_blocks_write_no_text(spark, data, docs, tmp_path):
    """Twenty blocks: repeated rows, and scratch far smaller than the documents."""
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    listed = [(r["item_id"], r["text"]) for r in items.collect()]
    planted = spark.createDataFrame([(5000 + k % 3, "x " * 30 + listed[k % 4][1] + " y" * 30) for k in range(12)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(planted)
    n = dec.item_windows(items, "item_id", "text", 13).select("window").distinct().count()
    key = lambda df: sorted(map(repr, df.collect()))
    one, many = dec.report(both, items), dec.report(both, items, block_windows=-(-n // 20))
    assert key(one) == key(many) and one.where("contaminated").count() >= 12
    plan = many._jdf.queryExecution().toString()
    written = [x for x in plan.split() if "trackloom-" in x and ("hits" in x or "filed" in x or "windows" in x)]
    assert written and "FileScan parquet [digest" in plan
    for found in dec.find_hits(both, items, block_windows=10, keep=["doc_id"]).collect():
        spans = [(h["start"], h["end"]) for h in found["hits"]]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and found["items"] == sorted(set(found["items"]))


def test_one_window_in_very_many_items(spark):
    text = " ".join(f"word{k}" for k in range(13))
    items = spark.range(100_000).select(F.col("id").alias("item_id"), F.lit(text).alias("text"))
    rows = dec.report(spark.createDataFrame([(1, "so " + text + " it is"), (2, "none")], "doc_id long, text string"), items).collect()
    ids = ",".join(sorted(map(str, range(100_000))))
    assert {r["doc_id"]: (r["n_items"], r["n_hit"]) for r in rows} == {1: (100_000, 13), 2: (0, 0)}
    assert next(r for r in rows if r["doc_id"] == 1)["items_sha256"] == hashlib.sha256(ids.encode()).hexdigest()


@pytest.mark.parametrize("block", [50_000, 2])
def test_short_items_odd_rows_and_filter(spark, odd, block):
    items = spark.createDataFrame([(1, "Nothing in particular"), (2, ""), (3, None), (None, "goes on"), (1, "a"), (1, "a")], "item_id long, text string")
    rows = {r["doc_id"]: r for r in dec.report(odd, items, block_windows=block).collect() if r["doc_id"] not in (None, 10)}
    one = rows[1]
    assert one["n_hit"] == 3 + 2 + 2 and one["n_items"] == 1 and one["contaminated"]
    assert rows[3]["n_hit"] == 0 and not rows[3]["contaminated"] and rows[6]["contaminated"]
    kept = dec.drop_contaminated(odd, items, block_windows=block)
    assert kept.columns == odd.columns and {1, 2, 6, 7}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert dec.drop_contaminated(odd, items.limit(0)).count() == odd.count()
    assert dec.report(odd.limit(0), items).count() == 0
