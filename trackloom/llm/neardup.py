"""Near-duplicate groups at a stated similarity of word shingles.

Candidates come from two sides.  The SimHash operator's covering masks bring together every pair
whose fingerprints (of distinct shingles) differ in at most two bits.  At a similarity of 0.8
fingerprints differ in about ten of 64 bits, where covering masks would keep next to nothing of
the fingerprint; so MinHash tables complete the candidates.  Two documents agree in one MinHash
value with a probability that is their Jaccard similarity, whatever the edits between them
were; those that agree in all ``ROWS`` values of some table meet.  At 0.8 a pair meets nowhere
with a probability of ``(1 - 0.8 ** ROWS) ** TABLES``, 3e-6.

Every link is verified: the exact similarity of the whole sets of shingles (64-bit hashes) is
high enough.  Of a bucket, each document is first compared with the one of the least number.
Where that leaves more than one component in the bucket, all documents of different components
are compared, block by block of about ``BLOCK`` documents, so that a task holds two blocks of
one bucket.  So all pairs that meet are compared or joined by other links, however large the
bucket.  Groups are the components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .common import bitmap, discard, materialize, may_hold, numbered, partitions
from .components import connected_components

TABLES, ROWS = 24, 4
BLOCK = 512
_ODD = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(TABLES * ROWS)], np.uint64)
_MINS = (_ODD >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def shingles_of(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text has one, an empty one none."""
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - size + 1)
    joined = map(b" ".join, zip(*(words[k:] for k in range(size)))) if len(words) >= size else iter([b" ".join(words)])
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined), np.uint64, n))


def minima_of(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of a set of shingles; the greatest value where it is empty."""
    least = np.full(len(_MINS), 0xFFFFFFFF, np.uint32)
    short = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    for at in range(0, len(short), 2048):
        x = short[at : at + 2048] * _MINS[:, None]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA6B)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def keys_of(minima: np.ndarray) -> np.ndarray:
    """One bucket for each row and table."""
    x = (minima.astype(np.uint64) + np.uint64(1)) * _ODD
    x ^= x >> np.uint64(32)
    x = x.reshape(len(x), TABLES, ROWS).sum(axis=2, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def links_between(roots: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """Pairs of ``roots``, the documents' components, that can be joined.

    Documents of one block are compared only if all are of one block.  Each document outside the
    largest component is compared with all of other components that are long enough.
    """
    size = np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(size) - size
    held = np.zeros(len(values), np.uint8)
    part = np.unique(roots, return_inverse=True)[1]
    one = (blocks == blocks[0]).all()
    for i in np.flatnonzero((part != np.bincount(part).argmax()) & (size > 0)):
        near = (part != part[i]) & (np.minimum(size, size[i]) >= similarity * np.maximum(size, size[i]))
        others = np.flatnonzero(near if one else near & (blocks != blocks[i]))
        if not len(others):
            continue
        held[flat[starts[i] : starts[i] + size[i]]] = 1
        if len(others) * 8 < len(roots) or not size.all():
            both = np.array([held[flat[starts[k] : starts[k] + size[k]]].sum(dtype=np.int64) for k in others])
        else:
            both = np.add.reduceat(held[flat], starts, dtype=np.int64)[others]
        held[flat[starts[i] : starts[i] + size[i]]] = 0
        for k in others[both >= similarity * (size[others] + size[i] - both)]:
            if part[k] != part[i]:
                yield roots[i], roots[k]
                part[part == part[k]] = part[i]


def _sketches(src: DataFrame, size: int) -> DataFrame:
    """``n, node, fp, keys``: a digest of the folded words, the SimHash fingerprint and the MinHash buckets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, fps, least = [], [], np.zeros((b.num_rows, len(_MINS)), np.uint32)
            for k, t in enumerate(b.column(1)):
                words = words_of(t.as_py())
                found = shingles_of(words, size)
                node.append(xxhash.xxh3_128_digest(b" ".join(words)))
                fps.append(simhash.fingerprint_of(found))
                least[k] = minima_of(found)
            keys = pa.array([row.tobytes() for row in keys_of(least)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(node, pa.binary()), pa.array(fps, pa.int64()), keys], names=["n", "node", "fp", "keys"])

    return src.select("n", "text").mapInArrow(work, "n long, node binary, fp long, keys binary")


def _buckets(nodes: DataFrame) -> DataFrame:
    """``key, id, leader`` for each document that has company in a bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(b.column(0).to_numpy(), TABLES))], names=["key", "id"])

    bucket = Window.partitionBy("key")
    keyed = nodes.select("id", "keys").mapInArrow(work, "key long, id long")
    return keyed.withColumns({"leader": F.min("id").over(bucket), "_last": F.max("id").over(bucket)}).where("leader != _last").drop("_last")


def _covered(nodes: DataFrame) -> DataFrame:
    """``a, b``: each document with the first of its fingerprint, and first ones of fingerprints within two bits."""
    first = materialize(nodes.groupBy("fp").agg(F.min("id").alias("a")), "fingerprints")
    same = nodes.select("fp", F.col("id").alias("b")).join(first, "fp").where("a != b").select("a", "b")
    near = simhash.link(first.select("fp")).join(first, "fp").drop("fp")
    return same.union(near.join(first.select(F.col("fp").alias("other"), F.col("a").alias("b")), "other").select("a", "b"))


def _shingles(src: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """``id, shingles`` of the documents of ``pairs``, and of a few others that a bitmap can't tell from them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                found = [shingles_of(words_of(t.as_py()), size).tobytes() for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["id", "shingles"])

    words = bitmap(pairs.select(F.explode(F.array("a", "b")).alias("id")), F.xxhash64("id"), "paired")
    return may_hold(src.select("n", "text"), words, F.xxhash64("n")).mapInArrow(work, "id long, shingles binary")


def _verified(pairs: DataFrame, have: DataFrame, similarity: float) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [jaccard(*(np.frombuffer(x.as_py(), np.uint64) for x in two)) >= similarity for two in zip(b.column(2), b.column(3))]
            yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    left, right = (have.select(F.col("id").alias(x), F.col("shingles").alias(f"of_{x}")).hint("merge") for x in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b").mapInArrow(work, "a long, b long")


def _missing_links(buckets: DataFrame, roots: DataFrame, have: DataFrame, similarity: float, block: int) -> DataFrame:
    """``a, b``: roots of components (``node, root``) that documents of one bucket link.

    A document of a bucket with several components is sent to each pair of its block with
    another: the blocks of a bucket are as many as it takes to have about ``block`` documents each.
    """
    named = materialize(buckets.select("key", "id").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")), "named")
    mixed = named.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high"), F.ceil(F.count("*") / block).alias("blocks")).where("_low != _high")
    own = named.join(mixed.select("key", "blocks"), "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = own.select("key", "id", "root", "block", other).select("key", "id", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("k"))
    full = dealt.join(have.hint("merge"), "id").select("key", "i", "k", "id", "root", "block", "shingles")
    ordered = full.repartition(partitions(buckets.sparkSession), "key", "i", "k").sortWithinPartitions("key", "i", "k", "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []

        def take() -> pa.RecordBatch:
            roots, blocks = (np.array(x, np.int64) for x in list(zip(*held))[:2])
            found = list(links_between(roots, blocks, [x[2] for x in held], similarity)) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([int(x[c]) for x in found], pa.int64()) for c in (0, 1)], names=["a", "b"])

        for batch in batches:
            for key, i, k, root, blk, found in zip(*batch.select(["key", "i", "k", "root", "block", "shingles"]).columns):
                at = (key.as_py(), i.as_py(), k.as_py())
                if at != cell:
                    if held:
                        yield take()
                    cell, held = at, []
                held.append((root.as_py(), blk.as_py(), np.frombuffer(found.as_py(), np.uint64)))
        if held:
            yield take()

    return ordered.mapInArrow(work, "a long, b long").distinct()


def later_copies(src: DataFrame, size: int = 5, similarity: float = 0.8, block: int = BLOCK) -> DataFrame:
    """``n`` of the rows of ``src`` (``n``, ``text``) that aren't the least of their group.

    Rows whose folded words are the same sequence are one node, named by its least ``n``.
    Candidates are made for a similarity of 0.8 or more; below that some are missed.  Links that
    are found in buckets join components as a whole, so only roots are searched again.
    """
    rows = materialize(_sketches(src, size), "sketch")
    nodes = materialize(rows.groupBy("node").agg(F.min("n").alias("id"), *[F.first(c).alias(c) for c in ("fp", "keys")]), "nodes")
    buckets = materialize(_buckets(nodes), "buckets")
    pairs = buckets.where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).union(_covered(nodes))
    pairs = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    have = materialize(_shingles(src, pairs, size), "shingles")
    roots = connected_components(_verified(pairs, have, similarity), "a", "b")
    more = materialize(_missing_links(buckets, roots, have, similarity, block), "more-links")
    discard(pairs, have, buckets)
    joined = roots.union(connected_components(more, "a", "b")).where("node != root").select(F.col("node").alias("n"))
    same = rows.select("n", "node").join(nodes.select("node", "id"), "node").where("n != id").select("n")
    return same.union(joined).distinct()


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8, block: int = BLOCK) -> DataFrame:
    """``df`` with one document of each group: the one with the smallest id.

    Texts without words are copies of each other, null ones too.  Rows that repeat an id are
    documents of their own, in the order of a hash of their texts; null ids come last.
    """
    src = numbered(df, id_col, text_col)
    gone = materialize(later_copies(src, size, similarity, block), "gone")
    words, mark = bitmap(gone, F.xxhash64("n"), "gone-bitmap"), F.xxhash64("n")
    slim = src.select("row", "n")
    apart = may_hold(slim, words, mark).join(gone.hint("merge"), "n", "left_anti").select("row")
    return may_hold(slim, words, mark, how="left_anti").select("row").union(apart).select("row.*")
