"""SimHash fingerprints and near-duplicate classes by covering locality-sensitive hashing.

A document's fingerprint has bit *j* set if more than half of its shingle hashes have it
set.  Two fingerprints are linked if they differ in at most ``radius`` bits.  Candidates come
from *covering* masks: every bit position gets a non-zero vector of ``radius + 1`` bits, and
table *v* keeps the positions whose vector has an odd inner product with *v*.  The vectors of
any ``radius`` positions span less than the whole space, so some table masks all of them:
every pair within the radius shares a bucket in some table, without exception.

Pairs are never listed.  A fingerprint that has company in a bucket puts itself under its own
value and under each value one masked-out bit away.  Two fingerprints share such a value
exactly when they differ in at most two bits, and no value has more than 65 of them, so that
large buckets stay linear.  This is why ``link`` works for a radius of 1 or 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, hex64, materialize
from .components import connected_components

BITS = 64
STEP = 1 << 15


def shingle_bit_counts(words: list[bytes], size: int, seed: int) -> tuple[np.ndarray, int]:
    """How many shingle hashes have each bit (bit 0 first), and the number of shingles."""
    if len(words) <= size:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
        n = len(words) - size + 1
    counts = np.zeros(BITS, np.int64)
    digest, left = xxhash.xxh64_intdigest, n
    while left:
        take = min(left, STEP)
        part = np.fromiter((digest(s, seed) for s, _ in zip(shingles, range(take))), "<u8", take)
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(take, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
        left -= take
    return counts, n


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """Signed 64-bit fingerprint of one text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower folds A-Z only
    if not words:
        return 0
    counts, n = shingle_bit_counts(words, size, seed)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_of(hashes: np.ndarray) -> int:
    """Signed 64-bit fingerprint of shingle hashes (unsigned, 64 bits each); 0 without any."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), STEP):
        part = np.ascontiguousarray(hashes[at : at + STEP], "<u8")
        counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, fp)`` for every row: null and empty texts have fingerprint 0.

    Rows with a null or repeated id keep their own row.  Other columns of ``df`` are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, size, seed) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(work, "doc_id long, fp long")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The ``2 ** (radius + 1) - 1`` masks, each keeping a little over half of the bits."""
    n = (1 << (radius + 1)) - 1
    vectors = [1 + i % n for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if bin(m & v).count("1") & 1) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(fp, other)`` that join all distinct fingerprints within ``radius`` bits.

    ``fps`` has one row per distinct fingerprint.  Each link is between fingerprints within
    the radius; every such pair is joined by a path of links.
    """
    if radius not in (1, 2):
        raise ValueError("radius is 1 or 2")
    masks = covering_masks(radius)
    keyed = fps.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
            for t, m in enumerate(masks)
        ])).alias("k"),
    ).select("fp", "k.t", "k.key")
    bucket = Window.partitionBy("t", "key").orderBy("fp")
    crowded = keyed.withColumn(
        "mate", F.coalesce(F.lag("fp").over(bucket), F.lead("fp").over(bucket))
    ).where(F.col("mate").isNotNull())
    masked_out = F.array(*[
        F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(BITS) if not m >> i & 1])
        for m in masks
    ])
    hubs = crowded.select(
        "fp", F.explode(F.transform(F.element_at(masked_out, F.col("t") + 1), lambda x: x.bitwiseXOR(F.col("fp")))).alias("hub")
    )
    if radius == 1:  # then a hub counts only if it is a fingerprint itself
        near = hubs.join(fps.select(F.col("fp").alias("hub")), "hub", "left_semi")
        return near.where("fp != hub").select("fp", F.col("hub").alias("other")).distinct()
    near = hubs.withColumn("other", F.min("fp").over(Window.partitionBy("hub")))
    return near.where("fp != other").select("fp", "other").distinct()


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """One row per row of ``df``: ``doc_id, fingerprint, component_id, n_same``.

    ``component_id`` is the smallest id reachable over links (null if only null ids are);
    ``n_same`` counts the rows with the same fingerprint.  Equal fingerprints are one node of
    the graph, whatever their number, and combine before they are shuffled.
    """
    rows = materialize(fingerprints(df, id_col, text_col, size, seed), "simhash")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n_same")), "simhash-nodes")
    roots = materialize(connected_components(link(nodes.select("fp"), radius), "fp", "other"), "simhash-roots")
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    # Written first, so that both sides of the join are plain shuffles, of which Spark splits those that one fingerprint fills.
    named = materialize(named.join(least, "root").select("fp", "component_id", "n_same"), "simhash-classes")
    discard(nodes, roots)
    return rows.join(named, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id", "n_same")
