"""Personal data: fixed patterns, and a semi-Markov conditional random field for more.

``base_spans`` finds what the patterns define.  The field then reads the stretches around
digits, at-signs, and spelt-out at-signs of addresses.  It scores whole candidate segments of up to ``MAX_CHARS`` characters by
features of the span as such (its shape, how many digits, check digits, what stands beside
it), and dynamic programming over segment ends picks boundaries and types together.  It is
trained on a bounded sample of stretches, with the patterns' spans as its teacher and with
variants (a phone without its plus, a card grouped by dots, an address with a bracketed or spelt-out at-sign) that the patterns miss.
Spans that it adds never touch a base span.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed patterns.  A run of digits that fails as an address would fail from inside the run too, hence the look-behind.
EMAIL_AFTER = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_BEFORE = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
KINDS = ("email", "ip", "card", "phone")
TYPES = (*KINDS, "secret")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then by kind; code points, end exclusive."""
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and EMAIL_BEFORE.match(text, start - 1):
            start -= 1
        m = EMAIL_AFTER.match(text, at) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(x) <= 3 and int(x or 0) <= 255 for x in (p.lstrip("0") for p in m[0].split("."))):
                out.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m[0])) <= 15:
                out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


MAX_CHARS = 80
_DOT = r" ?(?:\.|[\[(]dot[\])]|(?<= )dot(?= )) ?"
#: ``[at] site [dot] org``, ``(at)site.org``, and `` at site dot org``, where one dot at least is spelt out.
_AT = re.compile(rf" ?[\[(]at[\])] ?[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+| at [A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*? dot [A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*")
_PLAIN = re.compile("[0-9@]+")
_TRIGGER = re.compile(rf"{_PLAIN.pattern}|{_AT.pattern}")
_SECRET = re.compile(r"(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{20,64}(?![A-Za-z0-9])")
#: A long mixed key is one token, whatever its runs.
_TOKEN = re.compile(_SECRET.pattern + r"|[0-9]+|[^\W\d_]+|[^\w\s]|_")


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of whole words around digits, at-signs and spelt-out ones, two words to the left and one to the right."""
    last = None
    spelt = " dot " in text or "at]" in text or "at)" in text  # without these marks no address is spelt out
    for m in (_TRIGGER if spelt else _PLAIN).finditer(text):
        if last is not None and m.start() - last[1] <= 24 and "\n" not in text[last[1] : m.start()]:
            last = (last[0], m.end())
            continue
        if last is not None:
            yield _widen(text, *last)
        last = m.span()
    if last is not None:
        yield _widen(text, *last)


def _widen(text: str, start: int, end: int, most: int = 40) -> tuple[int, int]:
    lo, hi = max(0, start - most), min(len(text), end + most)
    while 0 < lo and start - lo < MAX_CHARS and text[lo - 1].isalnum() and text[lo].isalnum():
        lo -= 1
    while hi < len(text) and hi - end < MAX_CHARS and text[hi - 1].isalnum() and text[hi].isalnum():
        hi += 1
    left = [m.start() for m in re.finditer(r"\S+", text[lo:start])]
    a = lo + left[-3] if len(left) > 2 else lo
    m = re.match(r"\S*(?: \S+)?", text[end:hi])
    return a, end + m.end()


def shape(s: str) -> str:
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", s))[:24]


def features(text: str, start: int, end: int) -> list[str]:
    """What the field sees of one candidate segment."""
    s = text[start:end]
    digits = "".join(DIGIT.findall(s))
    n, a, b = len(digits), text[start - 1 : start], text[end : end + 1]
    side = lambda c: "^" if not c else "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c
    runs = [len(x) for x in re.findall(r"[0-9]+", s)]
    out = [
        "bias", f"shape={shape(s)}", f"digits={min(n, 24)}", f"left={side(a)}", f"right={side(b)}", f"first={side(s[0])}", f"last={side(s[-1])}",
        f"runs={','.join(map(str, runs[:5]))}" if len(runs) < 6 else "runs=many", f"long={min(len(s) // 4, 12)}",
    ]
    if 12 <= n <= 19 and luhn(digits):
        out.append("luhn")
    if _AT.search(s):
        out.append("at-spelt")
    elif "@" in s or "[at]" in s or "(at)" in s:
        out.append("at" if "." in s[s.find("@") :] or "dot" in s else "at-only")
    if s.count(".") == 3 and len(runs) == 4 and all(int(x) <= 255 for x in re.findall(r"[0-9]{1,9}", s)):
        out.append("octets")
    if s.isalnum() and 0 < n < len(s):
        out.append("mixed-long" if len(s) >= 20 else "mixed")
    return out


def tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, start, end)]


class Field:
    """Weights by feature and type; type 0 is a token outside any span."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.w = np.zeros((0, len(TYPES)))
        self.off = 0.0

    def rows(self, names: list[str], grow: bool) -> list[int]:
        if grow:
            return [self.index.setdefault(n, len(self.index)) for n in names]
        return [self.index[n] for n in names if n in self.index]

    def lattice(self, text: str, toks: list[tuple[int, int]], grow: bool = False) -> list[list[tuple[int, list[int]]]]:
        """For each end, the starts and feature rows of the candidate segments that end there."""
        out: list[list[tuple[int, list[int]]]] = []
        for j, (_, end) in enumerate(toks):
            here = []
            for i in range(j, -1, -1):
                start = toks[i][0]
                if end - start > MAX_CHARS or "\n" in text[start:end]:
                    break
                if _TRIGGER.search(text, start, end) and (i == 0 or toks[i - 1][1] < start or not (text[start - 1].isalnum() and text[start].isalnum())):
                    here.append((i, self.rows(features(text, start, end), grow)))
            out.append(here)
        return out

    def score(self, text: str, start: int, end: int) -> tuple[float, int]:
        """The best type's sum of weights for one candidate, and the type."""
        by = self.w[self.rows(features(text, start, end), False)].sum(axis=0)
        t = int(by.argmax())
        return float(by[t]), t

    def decode(self, text: str, start: int, end: int) -> Iterator[Span]:
        """The best segmentation of one stretch: Viterbi over bounded segments.

        A token outside any span counts 0, so only candidates above 0 can be in the best one.
        Those that overlap, directly or through others, are settled together and forgotten.
        """
        group: list[tuple[int, int, int, int, float, int]] = []
        reach = 0
        for i, j, a, e in candidates(text, start, end):
            by, t = self.score(text, a, e)
            if by > 0:
                if group and i > reach:
                    yield from _settle(group)
                    group = []
                reach = max(reach, j) if group else j
                group.append((i, j, a, e, by, t))
        yield from _settle(group)

    def fit(self, examples: list[tuple[str, list[Span]]], epochs: int = 6, rate: float = 0.2, decay: float = 1e-3, seed: int = 3) -> Field:
        """Adagrad on the conditional log-likelihood; expectations by forward and backward sums.

        Examples whose spans no candidate segments can be are left out, and counted in ``unreachable``.
        """
        cases, self.unreachable = [], 0
        for text, gold in examples:
            toks = tokens(text, 0, len(text))
            begins, ends = {s: k for k, (s, _) in enumerate(toks)}, {e: k for k, (_, e) in enumerate(toks)}
            grid = self.lattice(text, toks, grow=True)
            place = {(i, j): k for k, (i, j) in enumerate((i, j) for j, here in enumerate(grid) for i, _ in here)}
            want = [(place.get((begins.get(s), ends.get(e))), TYPES.index(t)) for s, e, t in gold]
            if any(k is None for k, _ in want):
                self.unreachable += 1
            elif place:
                cases.append(Case(grid, want))
        self.w = np.zeros((len(self.index), len(TYPES)))
        if "bias" in self.index:
            self.w[self.index["bias"]] = -2.0  # what was never seen is no span
        gain = np.full_like(self.w, 1e-6)
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for k in order.permutation(len(cases)):
                c = cases[k]
                g = c.gradient(self.w, self.off) + decay * self.w[c.rows]
                gain[c.rows] += g * g
                self.w[c.rows] -= rate * g / np.sqrt(gain[c.rows])
        return self


#: What a span can be: runs and digits of numbers, the length of a key.
MAX_RUNS, LEAST_DIGITS, MOST_DIGITS = 6, 9, 24
_SPELT = re.compile(rf"@|{_AT.pattern}")


def candidates(text: str, start: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """``first token, last token, start, end`` of the segments that can be a span, by their first token.

    They have up to ``MAX_CHARS`` characters of one line, and an at-sign or a spelt-out one, or a
    long mixed key, or four runs of digits with three dots between, or 9 to 24 digits in at most six runs
    that begin like a number and end like one.  That is counted token by token, so a table of
    numbers has a few candidates for each number, whatever its length.
    """
    ahead: deque[tuple[int, int, int, bool]] = deque()  # start, end, digits, whether it is a key
    more = _TOKEN.finditer(text, start, end)
    marks = [m.span() for m in _SPELT.finditer(text, start, end)]
    at, i, before, done = 0, 0, None, False
    while True:
        while not done and (not ahead or ahead[-1][1] - ahead[0][0] <= MAX_CHARS):
            m = next(more, None)
            if m is None:
                done = True
            else:
                s = m[0]
                digits = len(s) if s.isascii() and s.isdigit() else sum(map(s.count, "0123456789")) if len(s) >= 20 else 0
                ahead.append((*m.span(), digits, 0 < digits < len(s)))
        if not ahead:
            return
        a = ahead[0][0]
        while at < len(marks) and marks[at][0] < a:
            at += 1
        spelt = marks[at][1] if at < len(marks) else len(text) + 1
        if before is None or before < a or not (text[a - 1].isalnum() and text[a].isalnum()):
            line = text.find("\n", a, a + MAX_CHARS + 1)
            last = a + MAX_CHARS if line < 0 else min(line, a + MAX_CHARS)
            digits = runs = dots = 0
            opens, joined = text[a].isalnum() or text[a] in "+(", a
            for k, (b, e, n, key) in enumerate(ahead):
                if e > last:
                    break
                if key:
                    digits, runs = digits + n, runs + len(re.findall("[0-9]+", text[b:e]))
                elif n:
                    digits, runs = digits + n, runs + 1
                elif text[b] == ".":
                    dots += 1
                joined = b
                number = opens and text[b].isalnum() and ((LEAST_DIGITS <= digits <= MOST_DIGITS and runs <= MAX_RUNS) or (dots == 3 and runs == 4))
                if number or spelt <= e or (key and joined == a):
                    yield i, i + k, a, e
                elif (digits > MOST_DIGITS or runs > MAX_RUNS) and spelt > last:
                    break
        before = ahead.popleft()[1]
        i += 1


def _settle(group: list[tuple[int, int, int, int, float, int]]) -> list[Span]:
    """The heaviest candidates of a group that don't overlap; of equal ones the shortest, and none before any."""
    if not group:
        return []
    first, last = group[0][0], max(c[1] for c in group)
    by_end: dict[int, list[tuple[int, int, int, int, float, int]]] = {}
    for c in group:
        by_end.setdefault(c[1], []).append(c)
    best, back = [0.0], [None]
    for j in range(first, last + 1):
        score, via = best[-1], None
        for c in sorted(by_end.get(j, ()), key=lambda c: -c[0]):
            if best[c[0] - first] + c[4] > score:
                score, via = best[c[0] - first] + c[4], c
        best.append(score)
        back.append(via)
    out, j = [], last - first + 1
    while j:
        if back[j] is None:
            j -= 1
        else:
            i, _, a, e, _, t = back[j]
            out.append((a, e, TYPES[t]))
            j = i - first
    return out[::-1]


class Case:
    """One training stretch: its candidate segments in order of their ends, and their features as one array."""

    def __init__(self, grid: list[list[tuple[int, list[int]]]], want: list[tuple[int, int]]):
        segments = [(i, j, rows) for j, here in enumerate(grid) for i, rows in here]
        self.n = len(grid)
        self.begin, self.end = (np.array([x[c] for x in segments]) for c in (0, 1))
        self.cuts = np.searchsorted(self.end, np.arange(self.n + 1))
        self.sizes = np.array([len(x[2]) for x in segments])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.rows, self.of = np.unique(np.concatenate([x[2] for x in segments]), return_inverse=True)
        self.want = want

    def gradient(self, w: np.ndarray, off: float) -> np.ndarray:
        """Of the negative log-likelihood, for the weights of ``rows``."""
        scores = np.add.reduceat(w[self.rows][self.of], self.starts, axis=0)
        total = np.logaddexp.reduce(scores, axis=1)
        f, b = np.full(self.n + 1, -np.inf), np.full(self.n + 1, -np.inf)
        f[0] = b[self.n] = 0.0
        for j in range(self.n):
            here = slice(self.cuts[j], self.cuts[j + 1])
            f[j + 1] = np.logaddexp.reduce(np.append(f[self.begin[here]] + total[here], f[j] + off))
        for j in range(self.n - 1, -1, -1):
            here = slice(self.cuts[j], self.cuts[j + 1])
            b[j] = np.logaddexp(b[j], b[j + 1] + off)
            at = self.begin[here]
            b[at] = np.logaddexp(b[at], b[j + 1] + total[here])
        g = np.exp((f[self.begin] + b[self.end + 1] - f[self.n])[:, None] + scores)
        for k, t in self.want:
            g[k, t] -= 1
        out = np.zeros((len(self.rows), w.shape[1]))
        np.add.at(out, self.of, np.repeat(g, self.sizes, axis=0))
        return out


def teach(text: str) -> list[Span]:
    """Training spans of a stretch: the patterns', and long mixed keys; longer spans win overlaps."""
    found = base_spans(text) + [(*m.span(), "secret") for m in _SECRET.finditer(text)]
    out: list[Span] = []
    for s in sorted(found, key=lambda x: (x[0] - x[1], x[0])):
        if all(s[1] <= o[0] or o[1] <= s[0] for o in out):
            out.append(s)
    return sorted(out)


#: Numbers that are nobody's.
PLAIN_NUMBERS = ("3", "12", "47", "250", "1998", "2024", "3.5", "10:30", "1,200", "50%", "$19", "7th", "1-2", "64kb", "2/3", "15000", "v2.1")


def variants(text: str, gold: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """A taught stretch, rewritings of its span that the patterns would miss, and its words around plain numbers."""
    yield text, gold
    if len(gold) == 1:
        s, e, kind = gold[0]
        old = text[s:e]
        new: list[str] = []
        if kind == "phone":
            new = [old.lstrip("+")]
        elif kind == "email":
            name, site = old.split("@", 1)
            new = [old.replace("@", " [at] ").replace(".", " [dot] "), f"{name}(at){site}", f"{name} at {site.replace('.', ' dot ')}"]
        elif kind == "card":
            digits = "".join(DIGIT.findall(old))
            new = [".".join(digits[i : i + 4] for i in range(0, len(digits), 4))]
        for other in new:
            yield text[:s] + other + text[e:], [(s, s + len(other), kind)]
    words, k = re.findall(r"[^\W\d_]+", text) or ["a"], zlib.crc32(text.encode())
    number = lambda n: PLAIN_NUMBERS[(k >> n) % len(PLAIN_NUMBERS)]
    yield f"{words[0]} {number(0)} {words[-1]}, {words[len(words) // 2]} {number(5)} {words[0]} {words[-1]} {number(10)}", []


def train_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 400) -> Field:
    """Train on at most ``most`` stretches of at most 240 characters, the first by a hash of their text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [t[a:e] for t in (x.as_py() or "" for x in b.column(0)) for a, e in stretches(t) if e - a <= 240]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["stretch"])

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(work, "stretch string").distinct()
    sample = sorted(r["stretch"] for r in rows.orderBy(F.xxhash64("stretch"), "stretch").limit(most).collect())
    return Field().fit([v for s in sample for v in variants(s, teach(s))])


def find(text: str, model: Field | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: base ones and those that the field adds, by start and kind."""
    base = base_spans(text)
    if model is None or not len(model.w):
        return base, base
    added, blocked, k = [], sorted((s, e) for s, e, _ in base), 0
    reach = 0
    for a, e in stretches(text):
        for s in model.decode(text, max(a, reach), e):
            while k < len(blocked) and blocked[k][1] <= s[0]:
                k += 1
            if not any(b < s[1] and s[0] < c for b, c in blocked[max(0, k - 4) : k + 8]):
                added.append(s)
        reach = max(reach, e)
    return base, sorted(base + added, key=lambda s: (s[0], TYPES.index(s[2])))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{t}:{s}:{e}" for s, e, t in spans)


def report(df: DataFrame, model: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` for every row; a null text is empty."""
    sent = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(sent.value)
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                base, spans = find(t.as_py() or "", m)
                n = [sum(k == s[2] for s in base) for k in KINDS]
                rows.append((i, *n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), len(spans) - len(base)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    schema = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in zip(names, types))
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(work, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(df: DataFrame, model: Field | None, text_col: str = "text", slice_rows: int = 256) -> DataFrame:
    """``df`` with personal data in ``text_col`` replaced by its kind in angle brackets; null texts stay null."""
    sent = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    at = df.columns.index(text_col)
    src = df.withColumn(text_col, F.col(text_col).cast("string"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(sent.value)
        for whole in batches:
            for k in range(0, whole.num_rows, slice_rows):
                b = whole.slice(k, slice_rows)
                clean = [None if t is None else masked(t, find(t, m)[1]) for t in b.column(at).to_pylist()]
                yield b.set_column(at, text_col, pa.array(clean, pa.string()))

    return src.mapInArrow(work, src.schema)
