from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from trackloom.llm import sharding


def draw(key: int, level: int, child: int, weight: float) -> float:
    seed = 42
    for value, size in ((key, 8), (level, 4), (child, 4)):
        seed = spark_hash(value, size, seed)
    return -math.log(((seed >> 12) + 0.5) / 2**52) / weight


def spark_hash(value: int, size: int, seed: int) -> int:
    """xxHash64 of a little-endian integer of eight or four bytes, as the SQL function has it."""
    return xxhash.xxh64_intdigest(value.to_bytes(size, "little", signed=True), seed)


def plain_shard(key: int, nodes) -> int:
    total = lambda x: sum(map(total, x)) if isinstance(x, list) else x
    region = min(range(len(nodes)), key=lambda r: draw(key, 0, r, total(nodes[r])) if len(nodes) > 1 else 0)
    rack0 = sum(len(x) for x in nodes[:region])
    rack = min(range(len(nodes[region])), key=lambda k: draw(key, 1, rack0 + k, total(nodes[region][k])))
    shard0 = sum(len(s) for x in nodes[:region] for s in x) + sum(len(s) for s in nodes[region][:rack])
    shards = nodes[region][rack]
    return shard0 + min(range(len(shards)), key=lambda k: draw(key, 2, shard0 + k, shards[k]))


def test_against_brute_force(docs, texts):
    rows = sharding.assign(docs).collect()
    assert len(rows) == len(texts)
    small, grown = sharding.tree(16), sharding.tree(17)
    for r in rows:
        b = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(b) + 1, zlib.crc32(b), "key")
        assert r["shard"] == plain_shard(r["doc_id"], small) and r["grown_shard"] == plain_shard(r["doc_id"], grown)
    for s in range(16):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))


def test_growth_moves_rows_into_the_new_shard_only(spark):
    rows = spark.range(40_000).select("id", sharding.shard_of(F.col("id"), sharding.tree(16)).alias("a"), sharding.shard_of(F.col("id"), sharding.tree(17)).alias("b")).collect()
    moved = [r for r in rows if r["a"] != r["b"]]
    assert {r["b"] for r in moved} == {16} and abs(len(moved) / 40_000 - 1 / 17) < 0.01
    assert all(abs(n - 2500) < 300 for n in Counter(r["a"] for r in rows).values())


@pytest.mark.parametrize("founded", [1, 3, 6, 16])
def test_the_law_holds_for_every_number_of_shards(founded):
    counts = range(founded, 41)
    placed = {n: [plain_shard(k, sharding.tree(n, founded=founded)) for k in range(600)] for n in counts}
    for n in counts[1:]:
        assert {b for a, b in zip(placed[n - 1], placed[n]) if a != b} <= {n - 1}
    assert set(placed[40]) == set(range(40))


def test_fewer_shards_than_founded_are_refused():
    with pytest.raises(ValueError):
        sharding.tree(15)
    assert len(sharding.tree(15, founded=15)) == 4


def test_a_heavier_shard_draws_rows_into_its_subtree_only(spark):
    heavy = [1.0] * 16
    heavy[5] = 3.0
    old, new = sharding.tree(16), sharding.tree(16, weights=heavy)
    rows = spark.range(40_000).select(sharding.shard_of(F.col("id"), old).alias("a"), sharding.shard_of(F.col("id"), new).alias("b")).collect()
    moved = [(r["a"], r["b"]) for r in rows if r["a"] != r["b"]]
    assert moved and all(b // 4 == 1 for _, b in moved)  # into the region of shard 5
    assert all(b // 2 == 2 for a, b in moved if a // 4 == 1)  # from inside it, into the rack
    assert all(b == 5 for a, b in moved if a // 2 == 2)  # from inside the rack, into the shard
    share = sum(r["b"] == 5 for r in rows) / 40_000
    assert abs(share - 3 / 18) < 0.01


def test_odd_rows(odd):
    rows = sharding.assign(odd, cells=3).collect()
    assert len(rows) == odd.count() and {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {1}
    by: dict[int, list[int]] = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.assign(odd.limit(0)).count() == 0
