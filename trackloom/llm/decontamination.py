"""Benchmark decontamination by a prefix-filtered join on exact word windows.

A window of an item must occur whole, so all of its words are necessary; the shortest prefix
in an order by rarity that any match must share is then its single rarest word.  Windows are
filed under that word.  A document probes the file with its words; a probe fixes where the
window would begin, which must lie inside the document and leave room for its whole length
(positional and length bounds), and the words there are then compared one by one.

Rarity counts the words over all documents.  The file is sent to the tasks in blocks of at most
``block_windows`` windows, so what is broadcast has a fixed bound however large the benchmark
is.  With several blocks, one reading counts the words of all of them, each block reads the
documents once to probe, and what is written is the hits of the texts that have some; they find their documents by a
128-bit digest of the text.  Nothing is left out, and no text is written.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, discard, materialize, may_hold, packed

# Words are runs of ASCII letters and digits and of anything outside ASCII; A-Z are folded.
_FOLD = bytes(
    x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct ``(window, item_id)``: windows of ``size`` words, or all words of a shorter item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of(text)
                found = list({b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}) if w else []
                for k in range(0, len(found), 4096):
                    part = found[k : k + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x.decode() for x in part], pa.string()), pa.array([item] * len(part), pa.string())],
                        names=["window", "item_id"],
                    )

    src = items.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return src.mapInArrow(work, "window string, item_id string").distinct()


def word_counts(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often each word of a bounded vocabulary occurs in all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[bytes] = Counter()
        known = sent.value.__contains__
        for b in batches:
            for text in b.column(0):
                n.update(filter(known, words_of(text.as_py())))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in n]), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    found = docs.select(F.col(text_col).cast("string")).mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"].encode(): r["n"] for r in found.collect()}


def file_windows(windows: list[tuple[bytes, list[str]]], count: dict[bytes, int]) -> dict[bytes, list[tuple[int, list[bytes], list[str]]]]:
    """Windows by their rarest word: ``word -> [(its offset, the window's words, item ids)]``."""
    out: dict[bytes, list[tuple[int, list[bytes], list[str]]]] = defaultdict(list)
    for window, items in windows:
        w = window.split(b" ")
        at = min(range(len(w)), key=lambda i: (count.get(w[i], 0), w[i], i))
        out[w[at]].append((at, w, items))
    return dict(out)


def scan(words: list[bytes], filed: dict[bytes, list[tuple[int, list[bytes], list[str]]]]) -> tuple[list[tuple[int, int]], set[str]]:
    """The stretches of words that filed windows cover, and the items whose windows occur."""
    if filed.keys().isdisjoint(words):
        return [], set()
    spans, items = [], set()
    for i, word in enumerate(words):
        for at, window, ids in filed.get(word, ()):
            start = i - at
            if start >= 0 and start + len(window) <= len(words) and words[start : start + len(window)] == window:
                spans.append((start, start + len(window)))
                items.update(ids)
    return spans, items


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def find_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = 13, block_windows: int = 50_000, keep: list[str] | None = None) -> DataFrame:
    """``row, n_words, hits, items`` for each row of ``docs``; ``row`` has ``keep`` (every column by default).

    ``hits`` are disjoint stretches of hit words as ``(start, end)``, end exclusive; ``items``
    the ids, as strings, of the items with a window in the text.  Null and empty texts have no
    words; items without words have no windows; windows of items with a null id are hit but
    not named.  Repeated rows each keep their own.
    """
    rows = materialize(item_windows(items, item_id, item_text, size), "windows")
    blocks = max(1, -(-rows.select("window").distinct().count() // block_windows))
    by_window = rows.groupBy("window").agg(F.collect_set("item_id").alias("ids"))
    src = packed(docs, docs.columns if keep is None else keep, text=F.col(text_col).cast("string"))
    if blocks > 1:
        return _found_in_blocks(src, by_window, blocks)
    listed = [(r["window"].encode(), r["ids"]) for r in by_window.collect()]
    vocabulary = {w for window, _ in listed for w in window.split(b" ")}
    filed = file_windows(listed, word_counts(docs, text_col, vocabulary) if listed else {})
    sent = docs.sparkSession.sparkContext.broadcast(filed)
    discard(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(len(w), *scan(w, sent.value)) for w in (words_of(t.as_py()) for t in b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), pa.array([n for n, *_ in found], pa.int64()), pa.array([_stretches(x) for _, x, _ in found], STRETCHES),
                    pa.array([sorted(ids) for *_, ids in found], pa.list_(pa.string())),
                ],
                names=["row", "n_words", "hits", "items"],
            )

    return src.mapInArrow(work, _schema(src))


STRETCHES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_NO_HITS, _NO_ITEMS = "array<struct<start:int,end:int>>", "array<string>"


def _schema(src: DataFrame):
    none = F.array()
    return src.select("row", F.lit(0).cast("long").alias("n_words"), none.cast(_NO_HITS).alias("hits"), none.cast(_NO_ITEMS).alias("items")).schema


def _stretches(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": s, "end": e} for s, e in union_of(spans)]


def _digest(text: str | None) -> bytes:
    return xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass"))


def _filed(src: DataFrame, by_window: DataFrame) -> DataFrame:
    """``window, ids, word, at``: each window's rarest word and its place.

    The words of all windows are counted in one reading of the documents, behind a fixed-size bitmap of them.
    """
    places = by_window.select("window", F.posexplode(F.split("window", " ")).alias("at", "word"))
    bits = 1 << 22
    table = np.zeros(bits // 64, np.int64)
    marks = bitmap(places, F.xxhash64("word"), "words", bits)
    for r in marks.collect():  # at most bits / 64 rows
        table[r["_word"]] = r["_bits"]
    discard(marks)
    sent = src.sparkSession.sparkContext.broadcast(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bool] = {}
        n: Counter[bytes] = Counter()

        def marked(w: bytes) -> bool:
            at = xxhash.xxh64_intdigest(w, 42) % bits
            return bool(int(sent.value[at >> 6]) >> (at & 63) & 1)

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in n], pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for t in b.column(0):
                if len(known) > 300_000:
                    known.clear()
                for w, k in Counter(words_of(t.as_py())).items():
                    if (yes := known.get(w)) is None:
                        yes = known[w] = marked(w)
                    if yes:
                        n[w] += k
                if len(n) > 100_000:
                    yield told()
                    n.clear()
        if n:
            yield told()

    counts = src.select("text").mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    best = places.join(counts, "word", "left").groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("b"))
    return best.join(by_window, "window").select("window", "ids", "b.word", "b.at")


def _found_in_blocks(src: DataFrame, by_window: DataFrame, blocks: int) -> DataFrame:
    filed = materialize(_filed(src, by_window).withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks))), "filed-windows")
    context, parts = src.sparkSession.sparkContext, []
    for k in range(blocks):
        block: dict[bytes, list] = defaultdict(list)
        for r in filed.where(F.col("block") == k).collect():
            block[r["word"].encode()].append((r["at"], r["window"].encode().split(b" "), r["ids"]))
        sent = context.broadcast(dict(block))

        def probe(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [(t, *scan(words_of(t), sent.value)) for t in (x.as_py() for x in b.column(0))]
                hit = [(_digest(t), _stretches(spans), sorted(ids)) for t, spans, ids in found if spans]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, *_ in hit], pa.binary()), pa.array([x for _, x, _ in hit], STRETCHES), pa.array([x for *_, x in hit], pa.list_(pa.string()))],
                    names=["digest", "hits", "items"],
                )

        # Texts that repeat have the same hits: one of them is kept.
        once = src.select("text").mapInArrow(probe, f"digest binary, hits {_NO_HITS}, items {_NO_ITEMS}").dropDuplicates(["digest"])
        parts.append(materialize(once, "hits"))
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    together = materialize(every.groupBy("digest").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")), "all-hits")
    discard(filed, *parts)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(words_of(t)) for t in texts], pa.int64()), pa.array([_digest(t) for t in texts], pa.binary())], names=["row", "n_words", "digest"])

    schema = src.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(b"").alias("digest")).schema
    rows = src.mapInArrow(keyed, schema)
    # Rows whose text can't have hits don't move; the bitmap has 32 bits for each text with hits, and a megabyte at most.
    bits = 1 << min(23, max(16, (32 * together.count()).bit_length()))
    marks = bitmap(together, F.xxhash64("digest"), "hit-texts", bits)
    mark = F.xxhash64("digest")
    clean = may_hold(rows, marks, mark, bits, "left_anti").select("row", "n_words", F.array().cast(_NO_HITS).alias("hits"), F.array().cast(_NO_ITEMS).alias("items"))
    joined = may_hold(rows, marks, mark, bits).join(together, "digest", "left")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = [_stretches([(x["start"], x["end"]) for x in h or ()]) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(hits, STRETCHES), pa.array([x or [] for x in b.column(3).to_pylist()], pa.list_(pa.string()))], names=["row", "n_words", "hits", "items"]
            )

    return clean.union(joined.select("row", "n_words", "hits", "items").mapInArrow(merged, _schema(src)))


def n_hit() -> Column:
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def contaminated(share: int = 20) -> Column:
    """Hit words are at least one in ``share``."""
    return (n_hit() > 0) & (n_hit() * share >= F.col("n_words"))


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``."""
    found = find_hits(docs, items, text_col, keep=[id_col], **options)
    return found.select(
        F.col(f"row.{id_col}").alias("doc_id"),
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they were."""
    return find_hits(docs, items, text_col, **options).where(~contaminated()).select("row.*")
