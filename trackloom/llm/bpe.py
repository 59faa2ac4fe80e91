"""Byte-level BPE with reuse of content-defined chunks.

A rolling hash over the last eight bytes cuts texts into chunks, so that a passage that occurs
in many documents has the same chunks in each.  ``shared_chunks`` counts the chunks of all
documents; those that save most, up to a stated number, are encoded once on the cluster and
sent to all tasks with their bytes.  Other chunks are encoded where they are met and kept
there for a while.

Chunks are encoded by themselves, which can differ from encoding the whole at the joins.  Each
join is therefore encoded again, over a stretch that grows to both sides until it begins and
ends with tokens that its chunks have too, at places where the encodings must agree: where the
pre-tokenizer starts a new piece whatever stands on either side, and merges do not cross
pieces.  Its pieces hold one kind of character (letters, numbers, white space, others) behind at most one
space, so that is wherever the kind changes, except behind white space and between an apostrophe
and a letter.  A chunk without such places joins its neighbours whole; a stretch that still doesn't
agree is a reason to encode the text in one piece.

The special token is split off first, as the tokenizer does.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
#: Fixed value: how this vocabulary's tokenizer splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MEAN_CHUNK = 512
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, 9)], np.uint64)


#: Fixed value: what the pre-tokenizer takes for white space.
WHITE = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def cuts(data: bytes, mean: int = MEAN_CHUNK) -> list[int]:
    """Byte positions where chunks end, by a rolling hash of eight bytes; never inside a character.

    No chunk is longer than eight times the mean: a run without a cut is cut there, counted from the cut before it.
    """
    if len(data) <= 16:
        return []
    x = np.frombuffer(data, np.uint8).astype(np.uint64)
    h = np.zeros(len(x) - 8, np.uint64)
    for k in range(8):
        h += x[k : k + len(h)] * _POWERS[k]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    at = np.flatnonzero(h >> np.uint64(40) < np.uint64((1 << 24) // mean)) + 8
    found = at[(x[at] & np.uint64(0xC0)) != 0x80].tolist()
    most = 8 * mean
    if all(b - a <= most for a, b in pairwise([0, *found, len(data)])):
        return found
    out, last = [], 0
    for end in [*found, len(data)]:
        while end - last > most:
            last += most
            while data[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if end < len(data):
            out.append(end)
            last = end
    return out


@cache
def kind_of(char: str) -> str | None:
    """``L``, ``N``, ``S`` or ``P`` for any other; an apostrophe is itself, and what isn't assigned is unknown."""
    if char in WHITE:
        return "S"
    kind = unicodedata.category(char)
    return None if kind == "Cn" else "'" if char == "'" else kind[0] if kind[0] in "LN" else "P"


def splits(before: str | None, after: str | None) -> bool:
    """Whether a new piece begins between characters of these kinds, whatever stands beside them."""
    if before is None or after is None or before == "S":
        return False
    if before == "'":
        return after in "SN"
    return before != ("P" if after == "'" else after)


def _edge(data: bytes, last: bool) -> str | None:
    """The kind of the first or last character of some bytes, if all of it is there."""
    if last:
        at = max(len(data) - 1, 0)
        while at > 0 and len(data) - at < 4 and data[at] & 0xC0 == 0x80:
            at -= 1
        data = data[at:]
    else:
        n = 1
        while n < min(4, len(data)) and data[n] & 0xC0 == 0x80:
            n += 1
        data = data[:n]
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return kind_of(text) if len(text) == 1 else None


def chunks_of(part: str) -> list[bytes]:
    data = part.encode("utf-8")
    ends = [*cuts(data), len(data)]
    return [data[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Encodes and decodes texts; keeps the chunks that it has encoded up to ``keep_bytes`` bytes.

    ``shared`` has chunks that were encoded elsewhere.
    """

    def __init__(self, ranks_path: str, keep_bytes: int = 1 << 22):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.base = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.token = [b""] * (max(*ranks.values(), SPECIAL_ID) + 1)
        for piece, n in ranks.items():
            self.token[n] = piece
        self.token[SPECIAL_ID] = SPECIAL.encode()
        self.first = [_edge(t, False) for t in self.token]
        self.last = [_edge(t, True) for t in self.token]
        self.kept: dict[bytes, tuple] = {}
        self.shared: dict[bytes, bytes] = {}
        self.keep_bytes, self.held, self.fresh, self.reused, self.wholes = keep_bytes, 0, 0, 0, 0

    def alone(self, chunk: bytes) -> array:
        """A chunk's own ids, two bytes each: the vocabulary has under 65,536 entries."""
        return array("H", self.base.encode_ordinary(chunk.decode("utf-8")))

    def _safe(self, ids: array, places: range) -> list[int]:
        """The first two of ``places`` where a token begins at which any encodings agree."""
        out: list[int] = []
        for k in places:
            # A character can be in several tokens: then its bytes are put together.
            before = self.last[ids[k - 1]] or _edge(self._bytes(ids[max(0, k - 4) : k]), True)
            if before is None or before == "S" or self.token[ids[k]][0] & 0xC0 == 0x80:
                continue
            if splits(before, self.first[ids[k]] or _edge(self._bytes(ids[k : k + 4]), False)):
                out.append(k)
                if len(out) == 2:
                    break
        return out

    def _chunk(self, chunk: bytes) -> tuple:
        """Ids, and the first two and last two safe places; no places where there are fewer than four."""
        found = self.kept.get(chunk)
        if found is not None:
            self.reused += 1
            return found
        ids = self.shared.get(chunk)
        if ids is None:
            ids = self.alone(chunk)
            self.fresh += 1
        else:
            ids = array("H", ids)
            self.reused += 1
        first, last = self._safe(ids, range(1, len(ids))), self._safe(ids, range(len(ids) - 1, 0, -1))[::-1]
        found = (ids, first, last) if len(first) == 2 and first[1] < last[0] else (ids, None, None)
        self.held += len(chunk)
        if self.held > self.keep_bytes:
            self.kept, self.held = {}, len(chunk)
        self.kept[chunk] = found
        return found

    def _bytes(self, ids: array) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def _plain(self, text: str) -> array:
        chunks = chunks_of(text)
        if len(chunks) == 1:
            return self._chunk(chunks[0])[0]
        out, open_, witness = array("H"), [], array("H")  # open_: bytes since the last safe place; witness: the ids that they begin with
        for chunk in chunks:
            ids, first, last = self._chunk(chunk)
            if first is None:
                open_.append(chunk)
                continue
            if open_:
                joined = self.alone(b"".join(open_) + self._bytes(ids[: first[1]]))
                ours = ids[first[0] : first[1]]
                if joined[: len(witness)] != witness or joined[len(joined) - len(ours) :] != ours:
                    self.wholes += 1
                    return self.alone(text.encode("utf-8"))
                out += joined
                out += ids[first[1] : last[0]]
            else:
                out += ids[: last[0]]
            open_, witness = [self._bytes(ids[last[0] :])], ids[last[0] : last[1]]
        return out + self.alone(b"".join(open_)) if open_ else out

    def encode(self, text: str) -> array:
        ids = array("H")
        for k, part in enumerate(text.split(SPECIAL)):
            if k:
                ids.append(SPECIAL_ID)
            if part:
                ids += self._plain(part)
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, shared: dict[bytes, bytes] | None = None) -> Encoder:
    """One encoder for each worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].shared = shared or {}
    return _ENCODERS[path]


def shared_chunks(df: DataFrame, text_col: str = "text", ranks_path: str | None = None, most: int = 20_000, most_bytes: int = 16 << 20) -> dict[bytes, bytes]:
    """The ids, two bytes each, of the ``most`` chunks whose reuse saves most bytes, by their bytes.

    All chunks of all documents are counted by a 128-bit hash.  The chunks chosen are encoded
    once each.  ``most`` and ``most_bytes`` bound what is broadcast (a chunk has at most eight times
    ``MEAN_CHUNK`` bytes) and change no result: other chunks are encoded where they stand.
    """
    texts = df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def chunked(b: pa.RecordBatch) -> Iterator[bytes]:
        for t in b.column(0):
            for part in t.as_py().split(SPECIAL):
                if part:
                    yield from chunks_of(part)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[bytes] = Counter()
        size: dict[bytes, int] = {}

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()), pa.array([size[h] for h in n], pa.int64())], names=["h", "n", "size"])

        for b in batches:
            for chunk in chunked(b):
                h = xxhash.xxh3_128_digest(chunk)
                n[h] += 1
                size[h] = len(chunk)
                if len(n) >= 50_000:
                    yield told()
                    n.clear()
                    size.clear()
        if n:
            yield told()

    counted = texts.mapInArrow(count, "h binary, n long, size long").groupBy("h").agg(F.sum("n").alias("n"), F.max("size").alias("size")).where("n > 1")
    best = counted.orderBy(F.desc(F.expr("(n - 1) * size")), "h").limit(most)
    chosen, room = set(), most_bytes
    for r in best.select("h", "size").collect():
        room -= r["size"]
        if room < 0:
            break
        chosen.add(bytes(r["h"]))
    wanted = df.sparkSession.sparkContext.broadcast(chosen)
    if not wanted.value:
        return {}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = set(wanted.value)
        for b in batches:
            found = []
            for chunk in chunked(b):
                h = xxhash.xxh3_128_digest(chunk)
                if h in left:
                    left.remove(h)
                    found.append(chunk)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["chunk"])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks_path or vocabulary())
        for b in batches:
            ids = [tool.alone(c.as_py()).tobytes() for c in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["chunk", "ids"])

    once = texts.mapInArrow(gather, "chunk binary").distinct().mapInArrow(code, "chunk binary, ids binary")
    return {bytes(r["chunk"]): bytes(r["ids"]) for r in once.collect()}


def _lists(rows: list[array]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.frombuffer(b"".join(r.tobytes() for r in rows), np.uint16).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def vocabulary() -> str:
    """The vocabulary's ranks, where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(df: DataFrame, text_col: str = "text", ranks_path: str | None = None, keep: list[str] | None = None, slice_rows: int = 64, most_shared: int = 20_000) -> DataFrame:
    """``keep`` (every column by default) with ``token_ids``: an array of ints for each row.

    A null text is the empty one and has no ids.  ``token_ids`` and ``round_trip`` replace
    columns of these names.
    """
    return encode_and_check(df, text_col, ranks_path, keep, slice_rows, most_shared).drop("round_trip")


def encode_and_check(df: DataFrame, text_col: str = "text", ranks_path: str | None = None, keep: list[str] | None = None, slice_rows: int = 64, most_shared: int = 20_000) -> DataFrame:
    """Like ``encode``, with ``round_trip``: whether decoding the ids gives the text."""
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("token_ids", "round_trip")]
    src = packed(df, keep, text=F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    schema = src.select("row", F.array().cast("array<int>").alias("token_ids"), F.lit(True).alias("round_trip")).schema
    sent = df.sparkSession.sparkContext.broadcast(shared_chunks(df, text_col, ranks_path, most_shared))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks_path or vocabulary(), sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, slice_rows):
                b = whole.slice(at, slice_rows)
                texts = b.column(1).to_pylist()
                ids = [tool.encode(t) for t in texts]
                same = [tool.decode(x) == t for x, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays([b.column(0), _lists(ids), pa.array(same, pa.bool_())], names=["row", "token_ids", "round_trip"])

    return unpacked(src.mapInArrow(work, schema), "token_ids", "round_trip")


def decode(df: DataFrame, ids_col: str = "token_ids", ranks_path: str | None = None, slice_rows: int = 64) -> DataFrame:
    """Every column of ``df`` but the ids, with ``decoded``: the text they stand for.  Null ids are none."""
    keep = [c for c in df.columns if c not in (ids_col, "decoded")]
    out = df.select(*keep, F.lit("").alias("decoded"))
    names = out.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks_path or vocabulary())
        for whole in batches:
            for at in range(0, whole.num_rows, slice_rows):
                b = whole.slice(at, slice_rows)
                text = [tool.decode(x or []) for x in b.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(text, pa.string())], names=names)

    return df.select(F.col(ids_col), *keep).mapInArrow(work, out.schema)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, most_shared: int = 20_000) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row, without moving ids out of the task.

    A null text is the empty one: no ids, and digests of nothing.  A null id stays null.
    """
    sent = df.sparkSession.sparkContext.broadcast(shared_chunks(df, text_col, ranks_path, most_shared))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks_path or vocabulary(), sent.value)
        for b in batches:
            n, of_ids, of_text = [], [], []
            for t in b.column(1):
                ids = tool.encode(t.as_py() or "")
                n.append(len(ids))
                of_ids.append(hashlib.sha256(np.frombuffer(ids, np.uint16).astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(tool.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return src.mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
