"""Ranked lexical search: the best documents for each item, by impacts in integers.

A document's vector has, for each term that some item asks for, the impact ``w * gain`` that the
term brings it; its score for an item is the sum over the item's terms.  Vectors are ordered by
length within each partition and cut into buckets.  By Cauchy and Schwarz no score of a bucket
is above its greatest length times the root of the number of terms, which leaves out whole
buckets once an item's fifty-th best score is known.  Inside a bucket a few coordinates are
summed first and the rest is bounded by what they leave of the document's length; survivors are
scored exactly, in 64-bit integers.

Texts are read once.  What is kept of a document is its number of terms and the counts of those
terms that pass a fixed-size bitmap of the items' terms.  Items are sent to the tasks in blocks
of a bounded number of terms; a further block reads the vectors again, never the texts.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bitmap, discard, materialize

#: Everything in ASCII but digits and letters separates; A-Z become a-z.
_FOLD = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
BUCKET = 1024
FOCUS = 6
#: Pairs of item and term that are sent to the tasks at a time.
BLOCK_PAIRS = 400_000


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, term``, distinct: rows that share an id are one item, null ids too."""
    schema = "item long, term binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                found = sorted(set(terms_of(t.as_py())))
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(found), pa.int64()), pa.array(found, pa.binary())], names=["item", "term"])

    src = items.select(F.col(f"`{id_col}`").cast("long").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return src.mapInArrow(work, schema).distinct()


def counted(docs: DataFrame, asked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, tfs``: of each text all its terms' number, and the counts of terms that may be asked for."""
    spark = docs.sparkSession
    many = asked.select("term").distinct().count()
    bits = 1 << min(25, max(16, (32 * many).bit_length()))
    words = bitmap(asked, F.xxhash64("term"), "asked", bits)
    table = np.zeros(bits // 64, np.int64)
    for r in words.collect():  # at most bits / 64 rows
        table[r["_word"]] = r["_bits"]
    discard(words)
    sent = spark.sparkContext.broadcast(table)
    schema = "doc_id long, n long, terms array<binary>, tfs array<int>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_bits = sent.value.view(np.uint64)
        known: dict[bytes, bool] = {}

        def asked_for(t: bytes) -> bool:
            at = xxhash.xxh64_intdigest(t, 42) % bits
            return bool(int(set_bits[at >> 6]) >> (at & 63) & 1)

        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ns, terms, tfs = [], [], []
                for t in part.column(1):
                    found = terms_of(t.as_py())
                    if len(known) > 300_000:
                        known.clear()
                    counts = Counter(found)
                    own = []
                    for x in counts:
                        if (yes := known.get(x)) is None:
                            yes = known[x] = asked_for(x)
                        if yes:
                            own.append(x)
                    ns.append(len(found))
                    terms.append(own)
                    tfs.append([counts[x] for x in own])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.binary())), pa.array(tfs, pa.list_(pa.int32()))],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return src.mapInArrow(work, schema).where("n > 0")


def weighted(asked: DataFrame, counts: DataFrame, n_docs: int) -> DataFrame:
    """``item, term, w`` for terms that occur: ``floor(1000 * ln((2 N + 2) / (2 df + 1)))``."""
    df = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    w = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    return asked.join(df, "term").select("item", "term", w.alias("w"))


def impacts(counts: DataFrame, weights: dict[bytes, tuple[int, int]], n_docs: int, n_terms: int) -> DataFrame:
    """``doc_id, length, ids, parts, bucket``: vectors by falling length within each partition, in buckets.

    ``weights`` has each term's coordinate and weight.  Coordinates of no impact are left out,
    and documents without any.
    """
    sent = counts.sparkSession.sparkContext.broadcast(weights)
    schema = "doc_id long, length double, ids array<int>, parts array<long>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in batches:
            docs, lengths, ids, parts = [], [], [], []
            for doc, n, terms, tfs in zip(*(b.column(k).to_pylist() for k in range(4))):
                m = 50 + (50 * n * n_docs) // n_terms
                own = sorted((*known[t], tf) for t, tf in zip(terms, tfs) if t in known)
                scored = [(i, x) for i, w, tf in own if (x := w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m)))]
                if scored:
                    docs.append(doc)
                    ids.append([i for i, _ in scored])
                    parts.append([x for _, x in scored])
                    lengths.append(math.sqrt(math.fsum(float(x) * x for _, x in scored)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(lengths, pa.float64()), pa.array(ids, pa.list_(pa.int32())), pa.array(parts, pa.list_(pa.int64()))],
                names=["doc_id", "length", "ids", "parts"],
            )

    run = counts.where("doc_id is not null").mapInArrow(work, schema).sortWithinPartitions(F.desc("length"), "doc_id")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return run.withColumn("bucket", F.shiftright(place, BUCKET.bit_length() - 1))


class Best:
    """An item's ``k`` highest scores so far, equal scores by id, and the least score that can still matter."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.scores, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        scores, docs = np.concatenate([self.scores, scores]), np.concatenate([self.docs, docs])
        order = np.lexsort((docs, -scores))[: self.k]
        self.scores, self.docs = scores[order], docs[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def visit(best: dict[int, Best], items: dict[int, np.ndarray], docs: np.ndarray, lengths: np.ndarray, ends: np.ndarray, ids: np.ndarray, parts: np.ndarray) -> None:
    """One bucket against all items.  An item's coordinates stand by falling weight.

    A document is left out when its bound is below the item's least score; bounds are doubles,
    a billionth too high.  Each coordinate lists a document once, so sums are plain additions.
    """
    row = np.repeat(np.arange(len(docs)), np.diff(ends))
    order = np.argsort(ids, kind="stable")
    ids, row, parts = ids[order], row[order], parts[order]
    longest = float(lengths.max()) * (1 + 1e-9)
    for item, coordinates in items.items():
        mine = best[item]
        if longest * math.sqrt(len(coordinates)) < mine.least:
            continue
        lo, hi = np.searchsorted(ids, coordinates), np.searchsorted(ids, coordinates, "right")
        total = np.zeros(len(docs), np.int64)
        squares = np.zeros(len(docs))
        for a, z in zip(lo[:FOCUS], hi[:FOCUS]):
            total[row[a:z]] += parts[a:z]
            squares[row[a:z]] += parts[a:z].astype(float) ** 2
        rest = np.sqrt(np.maximum(lengths**2 * (1 + 1e-9) - squares, 0)) * math.sqrt(max(len(coordinates) - FOCUS, 0))
        left = (total + rest) * (1 + 1e-9) >= mine.least
        if not left.any():
            continue
        for a, z in zip(lo[FOCUS:], hi[FOCUS:]):
            total[row[a:z]] += parts[a:z]
        keep = np.flatnonzero(left & (total >= max(mine.least, 1)))
        if len(keep):
            mine.add(total[keep], docs[keep])


def best_of(vectors: DataFrame, items: dict[int, np.ndarray], least: dict[int, int], k: int) -> DataFrame:
    """``item, doc_id, score``: each task's best ``k`` for each item (by its number), at least ``least``."""
    sent = vectors.sparkSession.sparkContext.broadcast(pickle.dumps((items, least)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, floor = pickle.loads(sent.value)
        best = {i: Best(k, floor.get(i, 0)) for i in asked}
        for whole in batches:
            for at in range(0, whole.num_rows, BUCKET):
                b = whole.slice(at, BUCKET)
                docs, lengths = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
                ends = np.concatenate([[0], np.cumsum(b.column(2).value_lengths().to_numpy(zero_copy_only=False))])
                visit(best, asked, docs, lengths, ends, b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy())
        for i, x in best.items():
            if len(x.docs):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x.docs), i), pa.int64()), pa.array(x.docs), pa.array(x.scores)], names=["item", "doc_id", "score"]
                )

    return vectors.select("doc_id", "length", "ids", "parts").mapInArrow(work, "item long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, score above 0.

    Whole texts of all documents count for the statistics; null and empty texts have no terms.
    Documents with a null id are counted but not ranked, repeated ids are ranked row by row.
    Items without a term that occurs have no rows, nor has anything if a table is empty.
    """
    spark = docs.sparkSession
    asked = materialize(item_terms(items, item_col, item_text_col), "item-terms")
    counts = materialize(counted(docs, asked, id_col, text_col), "term-counts")
    size = counts.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    told = materialize(weighted(asked, counts, size["docs"]), "item-weights")
    blocks = max(1, -(-told.count() // block_pairs))
    of_block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    out = None
    used: list[DataFrame] = [asked, counts, told]
    for block in range(blocks):
        pairs = told.where(of_block == block).collect()  # about block_pairs rows
        weights = {t: (i, w) for i, (t, w) in enumerate(sorted({(bytes(r["term"]), r["w"]) for r in pairs}))}
        names = {name: i for i, name in enumerate(sorted({r["item"] for r in pairs}, key=lambda x: (x is None, x or 0)))}
        lists: dict[int, list[tuple[int, int]]] = {i: [] for i in names.values()}
        for r in pairs:
            at, w = weights[bytes(r["term"])]
            lists[names[r["item"]]].append((-w, at))
        coordinates = {i: np.array([at for _, at in sorted(x)], np.int32) for i, x in lists.items()}
        vectors = materialize(impacts(counts, weights, size["docs"], size["terms"]), "impacts")
        # The first bucket of each run tells a score that fifty documents reach.
        seeds = _ranked(best_of(vectors.where("bucket = 0"), coordinates, {}, k), k).where(F.col("rank") == k).select("item", "score").collect()
        found = _ranked(best_of(vectors, coordinates, {r["item"]: r["score"] for r in seeds}, k), k)
        named = spark.createDataFrame([(i, name) for name, i in names.items()], "item long, item_id long")
        ranked = materialize(found.join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked")
        out = ranked if out is None else out.union(ranked)
        discard(vectors)
    discard(*used)
    return out
