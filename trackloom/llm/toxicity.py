"""Toxicity by a convolutional text classifier, trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first four and five
characters.  Filters of widths one to three slide over the words of the whole text; each
filter's largest response over the text (max pooling) goes to a logistic unit.  All labelled
rows train, dealt by a hash of the id to shards of a bounded size: the first shard sets out from
random numbers, then every shard, in a task of its own, goes on from there with its own rows.
What the shards changed is averaged; a row of the embeddings over the shards that changed it.
Scoring runs wherever the documents are.

Scores are calibrated by language: a quarter of the labelled rows, held back from the gradient,
set, for each language that the text itself shows, the response at which a score is one half.
All of them are counted, by steps of the response.  The language is told from frequent words of
the text; the tables' columns are never read for a score.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, discard, materialize, may_hold, packed, unpacked

BUCKETS = 1 << 16
DIM = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
#: Responses are counted by steps of ``1 / STEPS``, changes added in units of ``1 / UNIT``.
STEPS, UNIT = 64, 1 << 32
#: Frequent words that tell the four languages apart.
FREQUENT = {
    "en": "the and of to that with for this was are is it on as by from",
    "de": "der die das und ist nicht mit von ein eine zu den für auf",
    "fr": "le la les des et une dans est pas qui que du sur au",
    "es": "el los las y una es por con para del en no un lo",
}
_TELLS: dict[bytes, list[str]] = {}
for _lang, _words in FREQUENT.items():
    for _w in _words.split():
        _TELLS.setdefault(_w.encode(), []).append(_lang)
_WORD = bytes(x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))


class Buckets(dict):
    """Word -> its three buckets; forgets everything when it holds ``most`` words."""

    most = 100_000

    def __missing__(self, word: bytes) -> tuple[int, int, int]:
        s = word.decode("utf-8", "ignore")
        if len(self) >= self.most:
            self.clear()
        out = tuple(zlib.crc32(x.encode(), k) % BUCKETS for k, x in enumerate((s, s[:4], s[:5])))
        self[word] = out
        return out


_BUCKETS = Buckets()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_WORD).split()


def language_of(words: list[bytes]) -> str:
    """The language with most frequent words; ``other`` without any.  Ties: the first by name."""
    n = dict.fromkeys(sorted(FREQUENT), 0)
    for w in words:
        for lang in _TELLS.get(w, ()):
            n[lang] += 1
    best = max(n, key=n.__getitem__)
    return best if n[best] else "other"


def ids_of(words: list[bytes]) -> np.ndarray:
    """Rows of three buckets, one for each word; a text without words has one row of padding."""
    return np.array([_BUCKETS[w] for w in words] or [(BUCKETS,) * 3], np.int32)


@dataclass
class Model:
    table: np.ndarray  # (BUCKETS + 1, DIM); the last row is padding
    filters: list[np.ndarray]  # (width, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    shift: float
    centre: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0

    @classmethod
    def fresh(cls, seed: int) -> Model:
        r = np.random.default_rng(seed)
        table = r.normal(0, 0.01, (BUCKETS + 1, DIM)).astype(np.float32)
        table[-1] = 0
        n = FILTERS * len(WIDTHS)
        filters = [r.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        return cls(table, filters, np.full(n, 0.1, np.float32), r.normal(0, 0.3, n).astype(np.float32), -1.0)

    def pooled(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest responses (docs x filters), where they are, and the padded buckets."""
        pad = np.full((WIDTHS[-1] - 1, 3), BUCKETS, np.int32)
        ids = np.concatenate([x for d in docs for x in (d, pad)])
        starts = np.cumsum([0] + [len(d) + len(pad) for d in docs[:-1]])
        vec = self.table[ids[:, 0]] + self.table[ids[:, 1]] + self.table[ids[:, 2]]
        best, where = [], []
        for w in self.filters:
            parts = vec @ w[0]
            for j in range(1, len(w)):
                parts[:-j] += vec[j:] @ w[j]
            for lo, hi in zip(starts, [*starts[1:], len(ids)]):
                at = parts[lo : hi - len(pad)].argmax(axis=0)
                where.append(at + lo)
                best.append(parts[at + lo, np.arange(FILTERS)])
        shape = lambda x: np.array(x).reshape(len(WIDTHS), len(docs), FILTERS).transpose(1, 0, 2).reshape(len(docs), -1)
        return shape(best) + self.bias, shape(where), ids

    def logits(self, docs: list[np.ndarray]) -> np.ndarray:
        pad = np.full((WIDTHS[-1] - 1, 3), BUCKETS, np.int32)
        ids = np.concatenate([x for d in docs for x in (d, pad)])
        ends = np.cumsum([len(d) + len(pad) for d in docs])
        vec = self.table[ids[:, 0]] + self.table[ids[:, 1]] + self.table[ids[:, 2]]
        padding = (ends[:, None] - np.arange(1, len(pad) + 1)).ravel()
        best = []
        for w in self.filters:
            parts = vec @ w[0]
            for j in range(1, len(w)):
                parts[:-j] += vec[j:] @ w[j]
            parts[padding] = -np.inf
            best.append(np.maximum.reduceat(parts, np.concatenate([[0], ends[:-1]]), axis=0))
        return np.maximum(np.concatenate(best, axis=1) + self.bias, 0) @ self.out + self.shift

    def score(self, logit: float, lang: str) -> float:
        x = self.slope * (float(logit) - self.centre.get(lang, self.centre.get("", 0.0)))
        return float(1 / (1 + np.exp(-min(max(x, -30.0), 30.0))))


@dataclass
class Gradients:
    rows: np.ndarray  # of the embedding table
    table: np.ndarray  # one row for each of them
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    shift: float


def gradients(m: Model, docs: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> Gradients:
    """Of the mean weighted logistic loss; only the winning windows of the pooling get one."""
    z, where, ids = m.pooled(docs)
    a = np.maximum(z, 0)
    p = 1 / (1 + np.exp(-np.clip(a @ m.out + m.shift, -30, 30)))
    d = ((p - labels) * weight / len(docs)).astype(np.float32)
    back = (d[:, None] * m.out) * (z > 0)
    touched, shares, filters = [], [], []
    for k, w in enumerate(m.filters):
        span = slice(k * FILTERS, (k + 1) * FILTERS)
        at_k, b_k = where[:, span], back[:, span]
        g = np.zeros_like(w)
        for j in range(len(w)):
            b3 = ids[np.minimum(at_k + j, len(ids) - 1)]
            g[j] = np.einsum("nf,nfd->df", b_k, m.table[b3].sum(axis=2))
            share = b_k[:, :, None] * w[j].T[None]
            touched += [b3[:, :, c].ravel() for c in range(3)]
            shares += [share.reshape(-1, DIM)] * 3
        filters.append(g)
    rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
    table = np.zeros((len(rows), DIM), np.float32)
    np.add.at(table, inverse, np.concatenate(shares))
    table[rows == BUCKETS] = 0
    return Gradients(rows, table, filters, back.sum(0), d @ a, float(d.sum()))


@dataclass
class State:
    """A model in training and Adagrad's sums of squares for each of its parts."""

    model: Model
    gain: list[np.ndarray]
    shift_gain: float = 1e-6

    @classmethod
    def fresh(cls, seed: int) -> State:
        m = Model.fresh(seed)
        return cls(m, [np.full_like(x, 1e-6) for x in (m.table, *m.filters, m.bias, m.out)])

    def dense(self) -> np.ndarray:
        """All parameters but the embeddings, padded to rows as wide as theirs."""
        m = self.model
        flat = np.concatenate([*(w.ravel() for w in m.filters), m.bias, m.out, [m.shift]])
        return np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)

    def add(self, rows: np.ndarray, change: np.ndarray) -> None:
        """Add changes to rows of the embeddings and, numbered on from those, of ``dense``."""
        m, own = self.model, rows <= BUCKETS
        m.table[rows[own]] += change[own].astype(np.float32)
        rest = self.dense()
        rest[rows[~own] - BUCKETS - 1] += change[~own]
        at, rest = 0, rest.ravel()
        for x in (*m.filters, m.bias, m.out):
            x[...] = rest[at : at + x.size].reshape(x.shape)
            at += x.size
        m.shift = float(rest[at])


def fit(state: State, docs: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, epochs: int, batch: int = 32, rate: float = 0.05, seed: int = 7) -> State:
    """Go on from ``state`` by Adagrad on the weighted logistic loss."""
    m, gain = state.model, state.gain
    r = np.random.default_rng(seed)

    def step(x: np.ndarray, g: np.ndarray, s: np.ndarray) -> None:
        s += g * g
        x -= rate * g / np.sqrt(s)

    for _ in range(epochs):
        order = r.permutation(len(docs))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            g = gradients(m, [docs[i] for i in rows], labels[rows], weight[rows])
            for k, x in enumerate(g.filters):
                step(m.filters[k], x, gain[1 + k])
            step(m.bias, g.bias, gain[-2])
            step(m.out, g.out, gain[-1])
            state.shift_gain += g.shift**2
            m.shift -= rate * g.shift / state.shift_gain**0.5
            gain[0][g.rows] += g.table * g.table
            m.table[g.rows] -= rate * g.table / np.sqrt(gain[0][g.rows])
    return state


def changes(before: State, after: State) -> tuple[np.ndarray, np.ndarray]:
    """What ``State.add`` takes from one to the other: the changed rows of the embeddings, and all of ``dense``."""
    moved = after.model.table.astype(np.float64) - before.model.table
    rows = np.flatnonzero(moved.any(axis=1))
    rest = after.dense() - before.dense()
    return np.concatenate([rows, BUCKETS + 1 + np.arange(len(rest))]), np.concatenate([moved[rows], rest])


def _cut(steps: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The threshold with the fewest errors, between two of the ascending ``steps``; the middle of the gap it lies in."""
    below = np.concatenate([[0], np.cumsum(toxic)])  # toxic rows that are missed
    above = np.concatenate([np.cumsum(clean[::-1])[::-1], [0]])  # clean rows that are hit
    k = int(np.argmin(below + above))
    low = np.concatenate([[steps[0] / STEPS - 1], (steps + 1) / STEPS])
    high = np.concatenate([steps / STEPS, [(steps[-1] + 1) / STEPS + 1]])
    return float((low[k] + high[k]) / 2)


def calibrate(m: Model, counts: list[tuple[str, int, int, int]]) -> None:
    """Set the centres from the numbers of rows by language, label and step of the response."""
    tally: dict[str, dict[int, list[int]]] = {"": {}}
    for lang, y, at, n in counts:
        for name in ("", lang):
            tally.setdefault(name, {}).setdefault(at, [0, 0])[y] += n
    for name, found in tally.items():
        steps = np.array(sorted(found), np.int64)
        clean, toxic = np.array([found[k] for k in steps], np.int64).reshape(-1, 2).T
        if len(steps) and (not name or min(clean.sum(), toxic.sum()) >= 8):
            m.centre[name] = _cut(steps, toxic, clean)


def constant(toxic: bool, seed: int = 7) -> Model:
    """Without both labels every score is the share of toxic rows; none, if there are no rows."""
    m = Model.fresh(seed)
    m.out[:] = 0
    m.centre[""] = m.shift + (-30 if toxic else 30)
    return m


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``_id, _y, _text`` of all rows that may be learnt, written to the shared folder.

    Rows with a null id or label are left out; a repeated label row counts once, and of documents
    that repeat an id the least text.  Texts without a label, told by a bitmap of fixed size, stay
    where they are.
    """
    known = (
        labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_id")))
        .distinct()
    )
    words = bitmap(known, F.xxhash64("_id"), "labelled-ids")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    found = may_hold(texts, words, F.xxhash64("_id")).hint("merge").join(known, "_id")
    rows = materialize(found.groupBy("_id", "_y").agg(F.min("_text").alias("_text")), "labelled")
    discard(words)
    return rows


def _learnt(rows: list[dict], weights: list[float]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    rows.sort(key=lambda r: (r["_id"], r["_y"]))
    y = np.array([r["_y"] for r in rows])
    return [ids_of(words_of(r["_text"])) for r in rows], y, np.array(weights)[y]


def train_on(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", shard_rows: int = 4000, epochs: int = 2, seed: int = 7
) -> Model:
    """Train on all labelled rows that aren't held out, in shards of about ``shard_rows``.

    The first shard's task starts the model; then all shards go on from it for ``epochs``, each in
    a task of its own, and their changes are averaged on the cluster.  The driver sees the model
    (its size is fixed) and counts.  Both labels weigh the same.  Ids alone decide which rows are
    in a shard and which set the thresholds, and changes are added as integers, so the model
    doesn't depend on how rows lie in partitions.
    """
    spark = docs.sparkSession
    rows = labelled(docs, labels, id_col, text_col, label_col)
    back = F.xxhash64("_id", F.lit(1)) % 4 == 0
    n = {(r["_y"], r["_back"]): r["n"] for r in rows.groupBy("_y", back.alias("_back")).agg(F.count("*").alias("n")).collect()}
    total = {y: n.get((y, False), 0) + n.get((y, True), 0) for y in (0, 1)}
    if not all(total.values()):
        discard(rows)
        return constant(total[1] > 0, seed)
    learn, check = rows.where(~back), rows.where(back)
    if not all(n.get((y, b)) for y in (0, 1) for b in (False, True)):  # too few for a part of their own
        learn = check = rows
    else:
        total = {y: n[y, False] for y in (0, 1)}
    size = sum(total.values())
    weights = [size / (2 * total[y]) for y in (0, 1)]
    shards = -(-size // shard_rows)
    learn = learn.withColumn("_shard", F.pmod(F.xxhash64("_id", F.lit(2)), F.lit(shards)).cast("int"))

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _learnt([r for b in batches for r in b.to_pylist()], weights)
        made = State.fresh(seed)
        if own[0]:
            fit(made, *own, epochs=max(8, min(40, 40_000 // len(own[0]))), seed=seed)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made)], pa.binary())], names=["state"])

    first = learn.where("_shard = 0").select("_id", "_y", "_text").repartition(1)
    found = first.mapInArrow(start, "state binary").collect()
    state = pickle.loads(found[0]["state"]) if found else State.fresh(seed)

    if shards > 1:
        sent = spark.sparkContext.broadcast(pickle.dumps(state))

        def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = _learnt([r for b in batches for r in b.to_pylist()], weights)
            if own[0]:
                key, moved = changes(pickle.loads(sent.value), fit(pickle.loads(sent.value), *own, epochs=epochs, seed=seed))
                whole = np.rint(moved * UNIT).astype(np.int64)
                columns = [pa.array(key, pa.int32()), *(pa.array(np.ascontiguousarray(x)) for x in whole.T)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", *parts])

        parts = [f"v{k}" for k in range(DIM)]
        dealt = learn.repartitionById(shards, F.col("_shard")).select("_id", "_y", "_text")
        moved = dealt.mapInArrow(go_on, "key int, " + ", ".join(f"{p} long" for p in parts))
        mean = moved.groupBy("key").agg(*[(F.sum(p) / (F.count("*") * UNIT)).cast("float").alias(p) for p in parts]).toArrow()
        state.add(mean.column("key").to_numpy(), np.stack([mean.column(p).to_numpy() for p in parts], axis=1))
        sent.destroy()

    model = state.model
    told = responses(check, model).groupBy("lang", "y", "step").agg(F.count("*").alias("n"))
    calibrate(model, [tuple(r) for r in told.collect()])
    discard(rows)
    return model


def responses(rows: DataFrame, model: Model, slice_rows: int = 32) -> DataFrame:
    """``lang, y, step``: the language that each text shows, its label and the step its response lies in."""
    sent = rows.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, slice_rows):
                b = whole.slice(at, slice_rows)
                words = [words_of(t) for t in b.column(1).to_pylist()]
                step = np.floor(np.clip(m.logits([ids_of(w) for w in words]), -64, 64) * STEPS).astype(np.int32)
                lang = pa.array([language_of(w) for w in words])
                yield pa.RecordBatch.from_arrays([lang, b.column(0), pa.array(step)], names=["lang", "y", "step"])

    return rows.select("_y", "_text").mapInArrow(work, "lang string, y int, step int")


def score(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, name: str = "score", slice_rows: int = 32) -> DataFrame:
    """``keep`` (every column by default) with ``score``, between 0 and 1, for each row.

    Null and empty texts are scored like any text without words.  ``name`` is the score's
    column; it replaces one of that name.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c != name]
    src = packed(df, keep, text=F.col(text_col).cast("string"))
    schema = src.select("row", F.lit(0.0).alias(name)).schema
    sent = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(sent.value)
        for whole in batches:
            scores: list[float] = []
            for at in range(0, whole.num_rows, slice_rows):
                words = [words_of(t) for t in whole.column(1).slice(at, slice_rows).to_pylist()]
                scores += [m.score(x, language_of(w)) for x, w in zip(m.logits([ids_of(w) for w in words]), words)]
            yield pa.RecordBatch.from_arrays([whole.column(0), pa.array(scores, pa.float64())], names=["row", name])

    return unpacked(src.mapInArrow(work, schema), f"`{name}`")
