"""Connected components of a large, sparse graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges ``(a, b)`` with ``a > b``."""
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges
    least = near.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    linked = near.join(least, "a")
    if large:
        out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, root)`` for every node of ``links``; root is the smallest node it can reach.

    Alternates large-star and small-star steps, which need a number of rounds that is
    logarithmic in the longest path.  Every round is a handful of equi-joins and combining
    aggregates on the edge list; the driver sees only one checksum per round.  Nulls and
    self-links are ignored; nodes without links are not returned.
    """
    a, b = F.col(left), F.col(right)
    edges = (
        links.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
    )
    edges, seen = materialize(edges, "edges"), None
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(mark) == seen or mark[0] == 0:
            break
        seen, old = tuple(mark), edges
        edges = materialize(_stars(_stars(old, True), False), "edges")
        discard(old)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
