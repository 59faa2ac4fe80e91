from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from trackloom.llm import lexical

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, items, k=50):
    """Every document's score for every item."""
    counts = [(d, Counter(TERM.findall((t or "").encode().lower()))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").encode().lower()))
    out = []
    for i, ts in asked.items():
        scored = []
        for d, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0 and d is not None:
                scored.append((-s, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def pairs(df, i, t):
    return [(r[i], r[t]) for r in df.select(i, t).collect()]


def test_against_every_score(spark, docs, data):
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    assert rows(lexical.search(docs, items)) == plain(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"))


@pytest.mark.parametrize("k, block", [(1, 400_000), (5, 400_000), (5, 60)])
def test_ties_copies_and_blocks(spark, k, block):
    r = random.Random(k + block)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(r.choices(words, weights=[1 / (i + 1) for i in range(40)], k=r.randrange(1, 60))) for _ in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string").repartition(6)
    items = spark.createDataFrame([(i, " ".join(r.sample(words, r.randrange(1, 20)))) for i in range(30)], "item_id long, text string")
    assert rows(lexical.search(docs, items, k=k, block_pairs=block)) == plain(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"), k)


def test_buckets_and_coordinates_are_left_out_and_nothing_is_lost(monkeypatch):
    r = np.random.default_rng(3)
    monkeypatch.setattr(lexical, "FOCUS", 2)
    lists = [sorted(r.choice(60, r.integers(1, 20), replace=False)) for _ in range(3000)]
    values = [r.integers(1, 1000, len(x)) * (1 + 50 * (k < 60)) for k, x in enumerate(lists)]
    order = sorted(range(3000), key=lambda k: -float((values[k].astype(float) ** 2).sum()))
    items = {0: np.array([5, 9, 30, 31]), 1: np.array([59])}
    best = {i: lexical.Best(10, 0) for i in items}
    scans = []
    real = np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **k: (scans.append(1), real(*a, **k))[1])
    for at in range(0, 3000, 100):
        part = order[at : at + 100]
        lengths = np.array([math.sqrt(float((values[k].astype(float) ** 2).sum())) for k in part])
        ends = np.concatenate([[0], np.cumsum([len(lists[k]) for k in part])])
        lexical.visit(best, items, np.array(part), lengths, ends, np.concatenate([lists[k] for k in part]), np.concatenate([values[k] for k in part]))
    assert len(scans) < 30 * 2 * 2  # some buckets were never looked into
    for i, c in items.items():
        want = sorted((-int(sum(v for t, v in zip(lists[k], values[k]) if t in set(c.tolist()))), k) for k in range(3000))[:10]
        assert [(-int(s), int(d)) for s, d in zip(best[i].scores, best[i].docs)] == want


def test_odd_rows(spark, odd):
    items = spark.createDataFrame(
        [(1, "Hello WORLD"), (1, "lorem"), (2, None), (3, ""), (None, "mail tail"), (4, "nowhere-to-be-found"), (5, "İ ß ünïcode"), (6, "id no nothing lorem " * 3000)],
        "item_id long, text string",
    )
    got = rows(lexical.search(odd, items))
    assert got == plain(pairs(odd, "doc_id", "text"), pairs(items, "item_id", "text")) and {x[0] for x in got} == {1, 5, 6, None}
    assert lexical.search(odd.limit(0), items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0
    assert lexical.search(odd.where("doc_id in (3, 4, 5)"), items).count() == 0
