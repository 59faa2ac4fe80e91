"""Placement of rows on shards by a hierarchical weighted hash tree, in DataFrame functions only.

The tree has regions, racks and shards.  A row descends it by one weighted draw per level:
each child of the node gets the draw ``-ln(u) / weight``, with ``u`` hashed from the row's key
and the child, and the least draw wins (an exponential race, so children win in proportion to
their weights).  A draw depends on the key, the child and its weight alone.  If a weight grows,
rows move only into that child's subtree; siblings never exchange rows.

Shards are numbered in order.  ``tree`` lays the shards that a cluster was founded with out in
racks and regions.  Each shard that is added later opens a region of its own, so that every row
that it draws goes to it: with any number of shards, one more takes rows only into itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Tree = list[list[list[float]]]


def tree(shards: int, per_rack: int = 2, racks_per_region: int = 2, weights: Sequence[float] | None = None, founded: int = 16) -> Tree:
    """Weights by region, rack and shard; all 1 unless given.  The first ``founded`` shards fill racks and regions."""
    w = list(weights) if weights is not None else [1.0] * shards
    if not 1 <= founded <= shards or len(w) != shards or min(w) <= 0:
        raise ValueError("at least as many shards as were founded, which is one or more, and one positive weight for each")
    racks = [w[i : min(i + per_rack, founded)] for i in range(0, founded, per_rack)]
    return [racks[i : i + racks_per_region] for i in range(0, len(racks), racks_per_region)] + [[[x]] for x in w[founded:]]


def _draw(key: Column, level: int, child: int, weight: float) -> Column:
    """An exponential variate with rate ``weight``: the high 52 bits of a hash, as a number in (0, 1)."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(child)), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.ln(u) / F.lit(float(weight))


def _winner(key: Column, level: int, children: list[tuple[int, float]]) -> Column:
    """The child with the least draw; the smaller number on a tie."""
    draws = [F.struct(_draw(key, level, n, w).alias("d"), F.lit(n).alias("n")) for n, w in children]
    return F.array_min(F.array(*draws))["n"] if len(draws) > 1 else F.lit(children[0][0])


def shard_of(key: Column, nodes: Tree) -> Column:
    """The shard that ``key`` belongs to, as an int column.  A null key has a place like any other."""
    total = lambda x: sum(map(total, x)) if isinstance(x, list) else x
    region = _winner(key, 0, [(r, total(x)) for r, x in enumerate(nodes)])
    rack_no = shard_no = 0
    out = []
    for r, racks in enumerate(nodes):
        named, inside = [], []
        for shards in racks:
            named.append((rack_no, total(shards)))
            inside.append((rack_no, _winner(key, 2, [(shard_no + i, w) for i, w in enumerate(shards)])))
            rack_no, shard_no = rack_no + 1, shard_no + len(shards)
        rack = _winner(key, 1, named)
        out.append((region == r, reduce(lambda c, x: c.when(rack == x[0], x[1]), inside[1:], F.when(rack == inside[0][0], inside[0][1]))))
    return reduce(lambda c, x: c.when(*x), out[1:], F.when(*out[0])).cast("int")


def number_within(df: DataFrame, group: str, order: Sequence[str], cells: int = 256) -> DataFrame:
    """Add ``slot``: the rows of each group, gapless from 0.

    A group may hold most of the rows, so it is never sorted in one task: rows are dealt to
    ``cells`` hash cells of each group, numbered within their cell, and moved up by the sizes
    of the cells before it.  Only the cell sizes, at most ``cells`` for each group, are
    gathered.  ``cells`` should be about the number of tasks that the cluster runs.
    """
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    sizes = dealt.groupBy(group, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    cell = Window.partitionBy(group, "_cell").orderBy(*order)
    placed = dealt.withColumn("_k", F.row_number().over(cell).cast("long") - 1)
    return placed.join(starts, [group, "_cell"]).withColumn("slot", F.col("_start") + F.col("_k")).drop("_cell", "_k", "_start")


def assign(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, cells: int = 256, founded: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``df``.

    ``size`` is the UTF-8 bytes of the text plus one; a null text has size 1 and the checksum
    of no bytes.  The shard follows from the id and the number of shards (law ``key``): rows
    with equal or null ids share a shard.  ``grown_shard`` is the shard with one shard more.
    ``founded`` is the layout's constant: fewer shards than that are refused.
    ``slot`` numbers a shard's rows from 0; ties between repeated rows are numbered either way.
    Other columns are ignored, also those with the names of the result.
    """
    text = F.coalesce(F.col("_text").cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree(shards, founded=founded)).alias("shard"),
        shard_of(F.col("doc_id"), tree(shards + 1, founded=founded)).alias("grown_shard"),
    )
    placed = number_within(rows, "shard", ["doc_id", "size", "text_crc32"], cells)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
