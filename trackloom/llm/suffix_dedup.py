"""Removal of repeated passages by a prefix-free parse of the corpus.

Rolling-hash triggers cut every text: position *q* is a trigger if the hash of the ``GRAM``
bytes there is the least (leftmost on ties) of some string of ``length`` bytes.  So every such
string holds a trigger, and equal strings hold it at the same place.  A trigger's *phrase* is
the text that the strings with this trigger cover; no phrase is longer than ``2 * length``.

The corpus becomes a parse (occurrences of phrases in corpus order) over a dictionary (distinct
phrases).  For highly repetitive text the dictionary is small, and the work is done on it:

* An occurrence of a phrase that the parse has earlier repeats it whole.  Triggers sorted by
  hash, phrase and place show these in one streamed pass.
* First occurrences can still share strings with other phrases around the same trigger, at the
  edges of repeated passages.  The starts of phrases whose trigger has several phrases in the
  dictionary are sorted by their strings, as in a suffix array truncated at ``length`` bytes,
  with corpus order (the parse) among equal ones; see ``refined``.

A string never reaches beyond its phrase, so the parse's own suffix array is needed to a depth
of one phrase only: occurrences sorted by phrase and by place.  Copies within one batch are
resolved before they are shuffled, so a passage that a third of the documents hold sends one
row for each batch.  Phrases are told apart by a rolling hash of the trigger and an xxHash of
their bytes, 64 bits each; keys of strings have 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions

GRAM = 32
BATCH_BYTES = 2_000_000
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        x = np.full(n + 1, base, _U)
        x[0] = 1
        return np.multiply.accumulate(x)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> _U(31)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(29)
    return h


def triggers(pieces: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Trigger hash, phrase hash, piece, first start, number of starts and offset of the trigger, one entry for each trigger.

    The starts are those of the strings of ``length`` bytes whose trigger it is; the phrase
    reaches from the first start to the end of the last string.
    """
    lens = np.array([len(p) for p in pieces])
    data = b"".join(pieces)
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, t) for t in (_U, _U, np.int64, np.int64, np.int64, np.int64))
    power, inverse = (x[: n + 1] for x in _powers(max(n, 2 * BATCH_BYTES)))
    total = np.zeros(n + 1, _U)
    np.cumsum((np.frombuffer(data, np.uint8).astype(_U) + _U(1)) * power[:-1], out=total[1:])
    span = lambda a, b: _mix((total[b] - total[a]) * inverse[a])
    low = _mix((total[GRAM:] - total[:-GRAM]) * inverse[: n + 1 - GRAM])
    low = low >> _U(24) << _U(24) | np.arange(len(low), dtype=_U)
    width, wide = length - GRAM + 1, 1
    while wide * 2 <= width:
        low = np.minimum(low[:-wide], low[wide:])
        wide *= 2
    if width > wide:
        low = np.minimum(low[: len(low) - (width - wide)], low[width - wide :])
    low = (low & _U((1 << 24) - 1)).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    owner = np.repeat(np.arange(len(pieces)), lens)[: len(low)]
    p = np.flatnonzero(np.arange(len(low)) + length <= (starts + lens)[owner])
    if not len(p):
        return triggers([], length)
    cut = np.flatnonzero((np.diff(low[p]) != 0) | (np.diff(owner[p]) != 0)) + 1
    first, last = p[np.concatenate([[0], cut])], p[np.concatenate([cut - 1, [len(p) - 1]])]
    at = low[first]
    digest = xxhash.xxh3_64_intdigest
    phrase = np.fromiter((digest(data[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())), _U, len(first))
    phrase ^= (at - first).astype(_U) * _U(0xD6E8FEB86659FD93)
    return span(at, at + GRAM), phrase, owner[first], first - starts[owner[first]], last - first + 1, at - first


def _pack(start: np.ndarray, count: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return start << 16 | count << 8 | offset


def _unpack(place: int) -> tuple[int, int, int]:
    return place >> 16, place >> 8 & 255, place & 255


def _batches(rows: Iterator[tuple[int, bytes]], length: int, most: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts by about ``most`` bytes; longer ones in pieces that overlap by ``length - 1`` bytes."""
    ids: list[int] = []
    begins: list[int] = []
    pieces: list[bytes] = []
    held = 0
    for doc, data in rows:
        for a in range(0, max(1, len(data) - length + 1), most):
            piece = data[a : a + most + length - 1]
            if held and held + len(piece) > most:
                yield ids, begins, pieces
                ids, begins, pieces, held = [], [], [], 0
            ids.append(doc)
            begins.append(a)
            pieces.append(piece)
            held += len(piece)
    if pieces:
        yield ids, begins, pieces


def parse(docs: DataFrame, length: int, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``trigger, phrase, doc, place`` for each occurrence; the trigger is null where the batch has an earlier one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((i.as_py(), (t.as_py() or "").encode("utf-8")) for b in batches for i, t in zip(b.column(0), b.column(1)))
        for ids, begins, pieces in _batches(rows, length, batch_bytes):
            trigger, phrase, piece, start, count, offset = triggers(pieces, length)
            if not len(trigger):
                continue
            doc = np.array(ids, np.int64)[piece]
            place = _pack(start + np.array(begins, np.int64)[piece], count, offset)
            trigger, phrase = trigger.view(np.int64), phrase.view(np.int64)
            o = np.lexsort((place, doc, phrase, trigger))
            again = np.zeros(len(o), bool)
            again[o[1:]] = (trigger[o[1:]] == trigger[o[:-1]]) & (phrase[o[1:]] == phrase[o[:-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(trigger, mask=again), pa.array(np.where(again, 0, phrase)), pa.array(doc), pa.array(place)],
                names=["trigger", "phrase", "doc", "place"],
            )

    return docs.mapInArrow(work, "trigger long, phrase long, doc long, place long")


def repeats(occurrences: DataFrame) -> DataFrame:
    """``doc, place, edge``: repeated occurrences, and first ones of phrases that share their trigger (``edge``)."""
    n = partitions(occurrences.sparkSession)
    ordered = occurrences.repartition(n, F.coalesce("trigger", F.xxhash64("doc", "place"))).sortWithinPartitions("trigger", "phrase", "doc", "place")

    def emit(doc, place, edge) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, place, edge)], names=["doc", "place", "edge"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), np.int64)  # the newest first occurrence: trigger, phrase, doc, place
        shared = False  # whether a phrase before it has its trigger
        for b in batches:
            done = b.column(0).is_null().to_numpy(zero_copy_only=False)
            doc, place = b.column(2).to_numpy(), b.column(3).to_numpy()
            if done.any():
                k = int(done.sum())
                yield emit(doc[done], place[done], np.zeros(k, bool))
            rows = np.stack([b.column(0).fill_null(0).to_numpy()[~done], b.column(1).to_numpy()[~done], doc[~done], place[~done]])
            if not rows.shape[1]:
                continue
            carried = held.shape[1]
            rows = np.concatenate([held, rows], axis=1)
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
            again = ~new
            yield emit(rows[2, again], rows[3, again], np.zeros(int(again.sum()), bool))
            firsts = rows[:, new]
            same = firsts[0, 1:] == firsts[0, :-1]
            edge = np.zeros(firsts.shape[1], bool)
            edge[1:] |= same
            edge[:-1] |= same
            if carried:
                edge[0] |= shared
            shared, held = bool(edge[-1]), firsts[:, -1:]
            edge[-1] = False  # it is told when what follows is known
            if edge.any():
                yield emit(firsts[2, edge], firsts[3, edge], np.ones(int(edge.sum()), bool))
        if shared:
            yield emit(held[2], held[3], np.ones(1, bool))

    return ordered.mapInArrow(work, "doc long, place long, edge boolean")


def refined(suffixes: DataFrame, length: int) -> DataFrame:
    """``doc, start, n``: runs of starts in the dictionary's edge phrases whose strings come earlier.

    This is the dictionary's suffix array, truncated at ``length`` bytes, as far as equal
    strings go.  A row stands for the starts of a phrase whose trigger lies at the offsets
    ``low`` to ``high`` of their strings, clipped to what the phrase has (``a`` to ``b``).  Rows
    with the same key ``k1, k2`` agree on the trigger, on ``low`` bytes to its left and on
    ``length - GRAM - high`` bytes to its right, which all of these strings share; ``left`` and
    ``right`` are the bytes beyond.  Each round sorts the rows of a key by these bytes and by
    corpus order.  A row that equals the one before it repeats all its strings.  The first of
    each value goes on with both halves of the offsets, as two rows whose keys take up more
    bytes, unless its key has no other value.  At one offset the key is the whole string.

    All rounds run in one stage, on one partitioning by the first key, with spilling sorts.
    Nothing depends on how many phrases a trigger has.
    """
    rows, size = suffixes.withColumn("done", F.lit(False)), (length - GRAM) // 2 + 1
    while size > 1:
        rows, size = _halved(_compared(rows)), (size + 1) // 2
    return _compared(rows).where("done").select("doc", (F.col("at") - F.col("b")).alias("start"), (F.col("b") - F.col("a") + 1).cast("long").alias("n"))


def _compared(rows: DataFrame) -> DataFrame:
    """Mark rows that repeat an earlier one; drop rows whose key has no other value."""
    order = Window.partitionBy("root", "k1", "k2", "done").orderBy("a", "b", "left", "right", "doc", "at")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    value = F.struct("a", "b", "left", "right")
    seen = rows.withColumn("_v", value).withColumns({"_before": F.lag("_v").over(order), "_least": F.first("_v").over(whole), "_most": F.last("_v").over(whole)})
    again = F.col("done") | F.coalesce(F.col("_before") == F.col("_v"), F.lit(False))
    return seen.withColumn("done", again).where(F.col("done") | (F.col("_least") != F.col("_most"))).drop("_v", "_before", "_least", "_most")


def _halved(rows: DataFrame) -> DataFrame:
    """Each row that isn't done as the lower and the upper half of its offsets, where it has any there."""
    low, high, a, b, left, right = (F.col(n) for n in ("low", "high", "a", "b", "left", "right"))
    middle = F.floor((low + high) / 2).cast("int")
    first = lambda text, n: F.substring(text, F.lit(1), n)
    rest = lambda text, n: F.substring(text, n + 1, F.length(text))
    last = lambda text, n: F.substring(text, F.length(text) - n + 1, n)
    keyed = lambda side, text: [F.xxhash64(k, F.lit(side), text).alias(k) for k in ("k1", "k2")]
    down, up = F.least(b, middle), F.greatest(a, middle + 1)
    lower = F.struct(
        *keyed("right", first(right, high - middle)), low, middle.alias("high"), a, down.alias("b"),
        last(left, down - low).alias("left"), rest(right, high - middle).alias("right"),
    )
    upper = F.struct(
        *keyed("left", last(left, middle + 1 - low)), (middle + 1).alias("low"), high, up.alias("a"), b,
        first(left, b - middle - 1).alias("left"), first(right, high - up).alias("right"),
    )
    whole = F.struct("k1", "k2", "low", "high", "a", "b", "left", "right")
    parts = F.when(F.col("done"), F.array(whole)).otherwise(F.array(F.when(a <= middle, lower), F.when(b > middle, upper)))
    kept = ("root", "doc", "at", "done")
    return rows.select(*kept, F.explode(parts).alias("_p")).where("_p is not null").select(*kept, "_p.*")


def _suffixes(joined: DataFrame, length: int) -> DataFrame:
    """Two rows for each edge phrase: its starts with most of the string to the right of the trigger, and to the left."""
    last = length - GRAM
    half = last // 2
    fields = [("root", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), *((n, pa.int32()) for n in ("low", "high", "a", "b")), ("left", pa.binary()), ("right", pa.binary()), ("doc", pa.int64()), ("at", pa.int64())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, edges in zip(batch.column(0), batch.column(1), batch.column(2)):
                data, doc = (text.as_py() or "").encode("utf-8"), doc.as_py()
                for place in edges.as_py():
                    start, count, offset = _unpack(place)
                    at = start + offset
                    end = at + GRAM
                    for low, high in ((0, half), (half + 1, last)):
                        a, b = max(low, offset - count + 1), min(high, offset)
                        if a <= b:
                            key = xxhash.xxh3_128_digest(bytes([low]) + data[at - low : end + last - high])
                            k1, k2 = int.from_bytes(key[:8], "little", signed=True), int.from_bytes(key[8:], "little", signed=True)
                            rows.append((k1 ^ k2, k1, k2, low, high, a, b, data[at - b : at - low], data[end + last - high : end + last - a], doc, at))
            for k in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows[k : k + 4096]), fields)], names=[n for n, _ in fields])

    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    return joined.mapInArrow(work, ", ".join(f"`{n}` {kinds[t]}" for n, t in fields))


def _numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, text, doc_id``, with ``doc`` unique and in corpus order: the id itself where ids are unique."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = src.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    if ids.isEmpty():
        return src.select(F.col("doc_id").alias("doc"), "text", "doc_id")
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    ranged = src.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    return materialize(ranged.select(F.monotonically_increasing_id().alias("doc"), "text", "doc_id"), "numbered")


def repeated_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, DataFrame]:
    """The documents as ``doc, text, doc_id``, and ``doc, runs``: runs of starts whose strings come earlier."""
    if not GRAM < length <= 127 + GRAM:
        raise ValueError(f"length is over {GRAM} and at most {127 + GRAM}")
    docs = _numbered(df, id_col, text_col)
    n = partitions(df.sparkSession)
    found = materialize(repeats(parse(docs.select("doc", "text"), length, batch_bytes)), "repeats")
    edges = found.where("edge").groupBy("doc").agg(F.collect_list("place").alias("edges"))
    with_edges = docs.join(edges, "doc").select("doc", "text", "edges")
    edge_runs = refined(_suffixes(with_edges, length).repartition(n, "root"), length)
    whole = found.where("not edge").select("doc", F.expr("shiftright(place, 16)").alias("start"), F.expr("shiftright(place, 8) & 255").alias("n"))
    runs = whole.union(edge_runs).groupBy("doc").agg(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("n").cast("long").alias("n"))).alias("runs"))
    return docs, runs


def removed_spans(runs: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal stretches of bytes that the runs' strings cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["start"], r["start"] + r["n"] - 1 + length) for r in runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, with_spans: bool = False, **limits: int) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row, and ``spans`` if asked for.

    Null and empty texts have no bytes.  Where ids repeat or are null, rows are documents of
    their own, null ids first, equal ids in the order of a hash of their texts.  ``limits`` are
    those of ``repeated_runs``; they bound memory and don't change results.
    """
    docs, runs = repeated_runs(df, id_col, text_col, length, **limits)
    joined = docs.join(runs, "doc", "left").select("doc_id", "text", "runs")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_spans:
        fields.append(("spans", kind))
        schema += ", spans array<struct<start:long,end:long>>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, t, r in zip(b.column(0), b.column(1), b.column(2)):
                data = (t.as_py() or "").encode("utf-8")
                spans = removed_spans(r.as_py() or [], length)
                kept, at = hashlib.sha256(), 0
                for s, e in spans:
                    kept.update(data[at:s])
                    at = e
                kept.update(data[at:])
                rows.append((doc.as_py(), len(data), sum(e - s for s, e in spans), len(spans), kept.hexdigest(), [{"start": s, "end": e} for s, e in spans]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])

    return joined.mapInArrow(work, schema)
