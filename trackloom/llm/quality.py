"""Quality by votes of nearest neighbours among labelled documents, in a latent semantic space.

A text's vector holds the square roots of the shares that hashed features have in its tokens:
the words, the marks that stand around them, their shape and length, and how many tokens repeat
the one before or any earlier one.  A truncated singular value decomposition of a bounded sample
of labelled documents gives the latent space.  The sample's latent vectors are broadcast (their
number and width are parameters); every document is multiplied with all of them, in blocks, so
neighbours are exact.  The nearest ones vote with their similarity.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

WORDS, MARKS = 2048, 1024
#: Feature numbers: words, marks, shapes, lengths, a token like the one before, a token that was there before.
SHAPES = "#9Aatx"
_MARK0, _SHAPE0 = WORDS, WORDS + MARKS
_LENGTH0 = _SHAPE0 + len(SHAPES)
_SAME = _LENGTH0 + 8
_AGAIN = _SAME + 1
WIDTH = _AGAIN + 1
NEIGHBOURS = 15
SHARPNESS = 8
_LETTERS = bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
_OTHERS = bytes(x for x in range(256) if x not in _LETTERS)


def features_of(token: bytes) -> tuple[int, int, int, int]:
    """Word, marks, shape and length of a token; a token without letters has the word of its shape."""
    core, marks = token.translate(None, _OTHERS), token.translate(None, _LETTERS)
    if not core:
        shape = "#"
    elif core.isdigit():
        shape = "9"
    elif core.isupper() and len(core) > 1:
        shape = "A"
    else:
        shape = "a" if core.islower() else "t" if core[1:].islower() or len(core) == 1 else "x"
    word = zlib.crc32(core.lower() or b"#") % WORDS
    return word, _MARK0 + zlib.crc32(marks[:4], 1) % MARKS, _SHAPE0 + SHAPES.index(shape), _LENGTH0 + min(7, len(core).bit_length())


class Tokens(dict):
    """Token -> its row in a table of features; starts again when it holds ``most`` tokens."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.rows = np.zeros((most, 4), np.int32)

    def __missing__(self, token: bytes) -> int:
        row = len(self)
        if row == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[row] = features_of(token)
        self[token] = row
        return row

    def vector(self, text: str | None) -> np.ndarray:
        """The features' shares under the square root, of length one; zero for a text without tokens."""
        if len(self) * 2 > len(self.rows):
            self.clear()
        found = (text or "").encode("utf-8", "surrogatepass").split()
        out = np.zeros(WIDTH)
        if not found:
            return out
        counts = Counter(found)
        rows = np.fromiter(map(self.__getitem__, counts), np.int64, len(counts))
        n = np.fromiter(counts.values(), np.float64, len(counts))
        for kind in range(4):
            out += np.bincount(self.rows[rows, kind], weights=n, minlength=WIDTH)
        out[_SAME] = 2 * sum(map(bytes.__eq__, found, found[1:]))
        out[_AGAIN] = len(found) - len(counts)
        out = np.sqrt(out)
        return out / np.linalg.norm(out)


@dataclass
class Model:
    axes: np.ndarray  # (WIDTH, dims)
    vectors: np.ndarray  # latent, of length one, by row of the sample
    labels: np.ndarray
    weight: np.ndarray  # how many labelled rows each row of the sample stands for
    prior: float

    def latent(self, matrix: np.ndarray) -> np.ndarray:
        out = matrix @ self.axes
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def scores(self, matrix: np.ndarray) -> np.ndarray:
        """One block of documents against all vectors of the sample.

        The nearest ``NEIGHBOURS`` and those that tie with the last of them vote; a document
        that nothing is similar to gets the share of label 1.
        """
        if not len(self.vectors):
            return np.full(len(matrix), self.prior)
        sims = np.maximum(self.latent(matrix) @ self.vectors.T, 0)
        k = min(NEIGHBOURS, sims.shape[1])
        last = np.partition(sims, sims.shape[1] - k, axis=1)[:, -k][:, None]
        votes = np.where(sims >= last, sims**SHARPNESS * self.weight, 0.0)
        total = votes.sum(axis=1)
        return np.clip((votes @ self.labels + 1e-6 * self.prior) / (total + 1e-6), 0.0, 1.0)


def train(texts: list[str | None], labels: list[int], weights: list[float], dims: int = 32, seed: int = 11) -> Model:
    """Axes by randomised subspace iteration; without rows every score is one half."""
    y, w = np.array(labels, float), np.array(weights, float)
    if not len(y):
        return Model(np.zeros((WIDTH, 1)), np.zeros((0, 1)), y, w, 0.5)
    tokens = Tokens()
    a = np.stack([tokens.vector(t) for t in texts])
    wide = min(dims + 8, *a.shape)
    q = np.random.default_rng(seed).normal(size=(WIDTH, wide))
    for _ in range(4):
        q = np.linalg.qr(a.T @ (a @ q))[0]
    _, _, turn = np.linalg.svd(a @ q, full_matrices=False)
    axes = (q @ turn.T)[:, :dims]
    m = Model(axes, np.zeros((0, axes.shape[1])), y, w, float((w * y).sum() / w.sum()))
    m.vectors = m.latent(a)
    return m


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train_on(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = 1000, dims: int = 32
) -> Model:
    """A model from at most ``most`` labelled rows of each label, the first by a hash of the id.

    Rows with a null id or label are left out, a repeated label row counts once, and an id that
    several documents share stands for the least of their texts.  Votes weigh as many labelled
    rows as they stand for, so that the shares of the labels stay those of all labels.  Only the
    sample reaches the task that decomposes it, and only its ids are broadcast.
    """
    known = (
        labels.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_id")))
        .distinct()
    )
    n = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    first = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(most) for y in (0, 1)]
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    sample = texts.join(F.broadcast(first[0].union(first[1])), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text")).repartition(1)
    share = {y: max(1.0, k / most) for y, k in n.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["_id"], r["_y"]))
        m = train([r["_text"] for r in rows], [r["_y"] for r in rows], [share[r["_y"]] for r in rows], dims)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(m)], pa.binary())], names=["model"])

    models = sample.select("_id", "_y", "_text").mapInArrow(work, "model binary").collect()
    return pickle.loads(models[0]["model"]) if models else train([], [], [])


def score(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, name: str = "score", block: int = 128) -> DataFrame:
    """``keep`` (every column by default) with the double ``name``, between 0 and 1, for each row.

    Whole texts are read.  Null and empty texts get the share of label 1.  ``name`` replaces a
    column of that name.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c != name]
    src = packed(df, keep, text=F.col(f"`{text_col}`").cast("string"))
    schema = src.select("row", F.lit(0.0).alias(name)).schema
    sent = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, tokens = pickle.loads(sent.value), Tokens()
        for whole in batches:
            found = [np.zeros(0)]
            for at in range(0, whole.num_rows, block):
                texts = whole.column(1).slice(at, block)
                found.append(m.scores(np.stack([tokens.vector(t.as_py()) for t in texts])))
            yield pa.RecordBatch.from_arrays([whole.column(0), pa.array(np.concatenate(found), pa.float64())], names=["row", name])

    return unpacked(src.mapInArrow(work, schema), f"`{name}`")
