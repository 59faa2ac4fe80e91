"""Canonical exact fingerprints of documents, and classes of equal ones.

The canonical form of a text is Unicode NFKC, case folded, with runs of white space made one
space and trimmed.  Its fingerprint is a 128-bit xxHash.  ``classes`` compares the canonical
bytes inside a bucket of equal hashes before it calls two documents equal.
"""

from __future__ import annotations

import hashlib
import unicodedata
import zlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions


def canonical(text: str | None) -> bytes:
    """Canonical bytes.  Folding can undo the normal form, so the text is normalised once more."""
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(text.casefold().split()).encode("utf-8", "surrogatepass")


def digest(text: str | None) -> str:
    """32 hex digits."""
    return xxhash.xxh3_128_hexdigest(canonical(text))


def likeness(a: str, b: str) -> float:
    """Of two exact fingerprints: 1 if they are equal, else 0."""
    return float(a == b)


def check(text: str | None) -> str:
    """A second digest of the canonical bytes: tells apart the texts of a bucket whose hashes collide."""
    return hashlib.sha256(canonical(text)).hexdigest()[:32]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hex_digits: int = 32) -> DataFrame:
    """``doc_id, fingerprint, check`` for every row; a null text is the empty one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() for t in b.column(1)]
            columns = [[digest(t)[:hex_digits] for t in texts], [check(t) for t in texts]]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string()) for c in columns)], names=["doc_id", "fingerprint", "check"])

    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return src.mapInArrow(work, "doc_id long, fingerprint string, check string")


def bits_for(rows: int) -> int:
    """Bits for a bitmap of that many rows: twice as many, up to 2 ** 25."""
    return 1 << max(12, min(25, (2 * rows).bit_length()))


def crowded(hashes: DataFrame, bits: int) -> list[int]:
    """A bitmap of ``bits`` bits with the fingerprints that occur more than once.

    Built from combined partial counts; at most ``bits / 64`` words reach the driver, whatever
    the data.  With more repeated fingerprints than bits it lets everything through, which
    costs time and changes no result.
    """
    repeated = hashes.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1")
    place = repeated.select((F.crc32("fingerprint") % bits).alias("p"))
    words = place.select((F.col("p") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b"))
    out = [0] * (bits // 64)
    for r in words.groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        out[r["w"]] = r["b"] & (1 << 64) - 1
    return out


def verified(df: DataFrame, hashes: DataFrame, id_col: str = "doc_id", text_col: str = "text", hex_digits: int = 32, bits: int | None = None) -> DataFrame:
    """``fingerprint, check, class_id`` for the fingerprints that several rows share.

    The canonical bytes of these rows, and of no others but a few that the bitmap can't tell,
    are part of the grouping key: Spark compares them byte for byte inside a hash bucket, and
    combines equal rows before it shuffles, so that a group with a third of the rows sends one
    row for each task.
    """
    bits = bits or bits_for(hashes.count())
    sent = df.sparkSession.sparkContext.broadcast(crowded(hashes, bits))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        for b in batches:
            rows = []
            for i, t in zip(b.column(0), b.column(1)):
                text = t.as_py()
                d = digest(text)[:hex_digits]
                p = zlib.crc32(d.encode()) % bits
                if words[p // 64] >> p % 64 & 1:
                    rows.append((i.as_py(), d, check(text), canonical(text)))
            for k in range(0, len(rows), 256):
                cols = zip(zip(*rows[k : k + 256]), (pa.int64(), pa.string(), pa.string(), pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in cols], names=["doc_id", "fingerprint", "check", "bytes"])

    src = df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    rows = src.mapInArrow(work, "doc_id long, fingerprint string, check string, bytes binary")
    equal = rows.groupBy("fingerprint", "check", "bytes").agg(F.min("doc_id").alias("class_id"))
    return equal.groupBy("fingerprint", "check").agg(
        F.when(F.count("*") == 1, F.min("class_id")).otherwise(F.raise_error(F.lit("two digests collide")).cast("long")).alias("class_id")
    )


def with_class(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Add ``class_id``; a fingerprint that occurs once is a class of its own.

    The classes are written first, so that both sides of the join are plain shuffles, of which
    Spark splits those that one fingerprint fills.
    """
    found = materialize(found, "classes")
    return rows.join(found.withColumn("_shared", F.lit(True)), ["fingerprint", "check"], "left").withColumn(
        "class_id", F.when(F.col("_shared"), F.col("class_id")).otherwise(F.col("doc_id"))
    ).drop("_shared")


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hex_digits: int = 32, bits: int | None = None) -> DataFrame:
    """``doc_id, fingerprint, class_id`` for every row: equal canonical bytes share a class.

    ``class_id`` is the smallest id of the class; null ids are passed over, and a class of null
    ids only has none.
    """
    rows = materialize(fingerprints(df, id_col, text_col, hex_digits), "fingerprints")
    return with_class(rows, verified(df, rows, id_col, text_col, hex_digits, bits)).select("doc_id", "fingerprint", "class_id")


_ROW = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("check", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_EDGE = [*_ROW, ("part", pa.int64()), ("edge", pa.string()), ("text", pa.string())]
_SQL = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
_ROW_SCHEMA, _EDGE_SCHEMA = (", ".join(f"`{n}` {_SQL[t]}" for n, t in x) for x in (_ROW, _EDGE))


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _beside(doc_id: int | None, text: str, own: str, after: str, next_fp: str) -> tuple:
    """A row's fingerprint against those of its edited text and of the next document."""
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    e = digest(edited)
    return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, check(text), e, likeness(own, e), likeness(own, next_fp)


def beside_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row beside an edited copy and the next document in descending order of ids.

    The edited text has its last half replaced by the beginning of the next document's; after
    the last row comes the first.  Null ids come last, rows with equal ids in the order of a
    hash of their texts.  Texts are dealt out by ranges of ids and streamed in order, so a task
    holds two of them; only the first and last row of each range are joined once more.
    """
    spark = df.sparkSession
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.desc("doc_id"), F.desc(F.xxhash64("text"))]
    ranged = src.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        blank = (None,) * (len(_ROW) - 4)
        for b in batches:
            rows = []
            for i, t in zip(b.column(0), b.column(1)):
                doc_id, text = i.as_py(), t.as_py()
                own = digest(text)
                if last is None:
                    rows.append((doc_id, None, None, own, *blank, part, "first", text))
                else:
                    rows.append((*_beside(*last, text, own), None, None, None))
                last = (doc_id, text, own)
            if rows:
                yield _batch(rows, _EDGE)
        if last is not None:
            doc_id, text, own = last
            yield _batch([(doc_id, None, None, own, *blank, part, "last", text)], _EDGE)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _batch([_beside(*r.values()) for r in b.to_pylist()], _ROW)

    rows = materialize(ranged.mapInArrow(work, _EDGE_SCHEMA), "beside")
    parts = sorted(r["part"] for r in rows.where("edge = 'first'").select("part").collect())
    following = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part long, next_part long")
    ends = rows.where("edge = 'last'").select("part", "doc_id", "text", "fingerprint").join(following, "part")
    begins = rows.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("after"), F.col("fingerprint").alias("next_fp"))
    joined = ends.join(begins, "next_part").select("doc_id", "text", "fingerprint", "after", "next_fp")
    return rows.where("edge is null").select(*[n for n, _ in _ROW]).union(joined.mapInArrow(finish, _ROW_SCHEMA))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``beside_next`` with ``class_id``, the byte-compared class of equal canonical texts."""
    rows = materialize(beside_next(df, id_col, text_col), "beside-all")
    return with_class(rows, verified(df, rows.select("fingerprint"), id_col, text_col)).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id"
    )
