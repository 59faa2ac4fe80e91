"""Chat formatting by compiled templates.

A template is text with three kinds of marks: ``{{ value }}`` puts a value out, ``{% if %}``,
``{% elif %}``, ``{% else %}``, ``{% for m in messages %}`` and ``{% generation %}`` steer, and
``{# ... #}`` is a remark.  Expressions have names, fields, strings, ``==``, ``!=``, ``and``,
``or``, ``not``, ``+`` and the filter ``| escape``: nothing can be called or reached beyond the
messages.  A template is parsed into a tree, constants are folded and neighbouring texts are
joined, and the tree becomes Python closures.  Rendering pulls messages one by one and yields
pieces of text with a mark for those inside ``generation``, so a conversation of any length
streams through.

Control strings inside texts are escaped with a backslash, and read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

#: The strings that steer this template's output; no other text contains them unescaped.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[GEN]", "[ROLE]", "[SEP]", "[/ROLE]")
TEMPLATE = (
    "<s>{% for m in messages %}"
    "{% if m.role == 'user' %}[INST]{{ m.text | escape }}[/INST]"
    "{% elif m.role == 'assistant' %}[GEN]{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ m.role | escape }}[SEP]{{ m.text | escape }}[/ROLE]{% endif %}"
    "{% endfor %}"
)
_ESCAPE = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_ESCAPED = re.compile(r"\\(" + "|".join(map(re.escape, ("\\", *CONTROL))) + ")")
_MARK = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:('[^']*'|\"[^\"]*\")|(==|!=|[().|+])|([A-Za-z_]\w*))")

Piece = tuple[str, bool]
Scope = dict[str, object]


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


class TemplateError(ValueError):
    pass


# Expressions: ("const", x) ("name", n) ("field", e, n) ("op", o, a, b) ("not", e) ("escape", e)
class _Expression:
    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append(("str", m[1][1:-1]) if m[1] is not None else ("op", m[2]) if m[2] else ("word", m[3]))
            at = m.end()
        self.at = 0

    def peek(self, *wanted: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in wanted

    def take(self) -> tuple[str, str]:
        if self.at == len(self.tokens):
            raise TemplateError("an expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self) -> tuple:
        out = self.binary(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    LEVELS = (("or",), ("and",), ("==", "!="), ("+",))

    def binary(self, level: int) -> tuple:
        if level == len(self.LEVELS):
            return self.unary()
        out = self.binary(level + 1)
        while self.peek(*self.LEVELS[level]):
            out = ("op", self.take()[1], out, self.binary(level + 1))
        return out

    def unary(self) -> tuple:
        if self.peek("not"):
            self.take()
            return ("not", self.unary())
        kind, x = self.take()
        if kind == "str":
            out: tuple = ("const", x)
        elif kind == "word":
            out = ("const", x == "true") if x in ("true", "false") else ("name", x)
        elif x == "(":
            out = self.binary(0)
            if self.take() != ("op", ")"):
                raise TemplateError("a bracket isn't closed")
        else:
            raise TemplateError(f"unexpected {x!r}")
        while self.peek(".", "|"):
            mark, (kind, name) = self.take()[1], self.take()
            if kind != "word" or name.startswith("_") or mark == "|" and name != "escape":
                raise TemplateError(f"{name!r} isn't known")
            out = ("field", out, name) if mark == "." else ("escape", out)
        return out


_OPS: dict[str, Callable] = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: f"{a}{b}", "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def fold(e: tuple) -> tuple:
    """Compute what has only constants below."""
    if e[0] in ("const", "name"):
        return e
    if e[0] == "field":
        return ("field", fold(e[1]), e[2])
    args = [fold(x) for x in e[2 if e[0] == "op" else 1 :]]
    if all(x[0] == "const" for x in args):
        values = [x[1] for x in args]
        return ("const", _OPS[e[1]](*values) if e[0] == "op" else not values[0] if e[0] == "not" else escape(str(values[0])))
    return (*e[: 2 if e[0] == "op" else 1], *args)


def _value(e: tuple) -> Callable[[Scope], object]:
    if e[0] == "const":
        return lambda s, x=e[1]: x
    if e[0] == "name":
        return lambda s, n=e[1]: s[n]
    if e[0] == "field":
        inner = _value(e[1])
        return lambda s, n=e[2]: inner(s)[n]  # messages are plain dictionaries: fields are keys
    args = [_value(x) for x in e[2 if e[0] == "op" else 1 :]]
    if e[0] == "not":
        return lambda s: not args[0](s)
    if e[0] == "escape":
        return lambda s: escape(str(args[0](s)))
    if e[1] in ("and", "or"):
        return (lambda s: args[0](s) and args[1](s)) if e[1] == "and" else (lambda s: args[0](s) or args[1](s))
    return lambda s, f=_OPS[e[1]]: f(args[0](s), args[1](s))


# Nodes: ("text", x) ("put", e) ("if", [(e, nodes)]) ("for", name, e, nodes) ("generation", nodes)
def parse(source: str) -> list[tuple]:
    marks, at = [], 0
    for m in _MARK.finditer(source):
        marks += [("text", source[at : m.start()])] if m.start() > at else []
        marks += [("put", fold(_Expression(m[1]).whole()))] if m[1] is not None else [("tag", m[2].strip())] if m[2] is not None else []
        at = m.end()
    marks += [("text", source[at:])] if at < len(source) else []
    nodes, rest = _nodes(marks, ())
    if rest:
        raise TemplateError(f"unexpected {rest[0][1]!r}")
    return nodes


def _nodes(marks: list[tuple], until: tuple[str, ...]) -> tuple[list[tuple], list[tuple]]:
    out: list[tuple] = []
    while marks:
        kind, x = marks[0]
        if kind == "put" and x[0] == "const":
            kind, x = "text", str(x[1])
        if kind == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + x)
            marks = marks[1:]
        elif kind != "tag":
            out.append((kind, x))
            marks = marks[1:]
        elif (word := x.split(None, 1)[0] if x else "") in until:
            return out, marks
        elif word == "generation":
            body, marks = _closed(marks[1:], "endgeneration")
            out.append(("generation", body))
        elif word == "for" and (m := re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+(.+)", x, re.S)):
            body, marks = _closed(marks[1:], "endfor")
            out.append(("for", m[1], fold(_Expression(m[2]).whole()), body))
        elif word == "if":
            node, marks = _branches(marks)
            test = node[1][0][0]
            if test[0] == "const":  # folded away
                out += node[1][0][1] if test[1] else [("if", node[1][1:])] if node[1][1:] else []
            else:
                out.append(node)
        else:
            raise TemplateError(f"unexpected {x!r}")
    if until:
        raise TemplateError(f"{until[0]!r} is missing")
    return out, []


def _closed(marks: list[tuple], end: str) -> tuple[list[tuple], list[tuple]]:
    body, marks = _nodes(marks, (end,))
    return body, marks[1:]


def _branches(marks: list[tuple]) -> tuple[tuple, list[tuple]]:
    branches = []
    while True:
        word, _, test = marks[0][1].partition(" ")
        if word == "endif":
            return ("if", branches), marks[1:]
        body, marks = _nodes(marks[1:], ("endif",) if word == "else" else ("elif", "else", "endif"))
        branches.append((("const", True) if word == "else" else fold(_Expression(test).whole()), body))


Render = Callable[[Scope, bool], Iterator[Piece]]


def _sequence(nodes: list[tuple]) -> Render:
    parts = [_render(n) for n in nodes]

    def run(scope: Scope, marked: bool) -> Iterator[Piece]:
        for p in parts:
            yield from p(scope, marked)

    return parts[0] if len(parts) == 1 else run


def _render(node: tuple) -> Render:
    if node[0] == "text":
        return lambda s, marked, x=node[1]: iter(((x, marked),))
    if node[0] == "put":
        value = _value(node[1])
        return lambda s, marked: iter(((str(value(s)), marked),))
    if node[0] == "generation":
        body = _sequence(node[1])
        return lambda s, marked: body(s, True)
    if node[0] == "if":
        branches = [(_value(e), _sequence(b)) for e, b in node[1]]

        def choose(s: Scope, marked: bool) -> Iterator[Piece]:
            for test, body in branches:
                if test(s):
                    yield from body(s, marked)
                    return

        return choose
    name, items, body = node[1], _value(node[2]), _sequence(node[3])

    def loop(s: Scope, marked: bool) -> Iterator[Piece]:
        for x in items(s):
            yield from body({**s, name: x}, marked)

    return loop


@lru_cache(maxsize=16)
def compile_template(source: str) -> Callable[[Iterable[dict[str, str]]], Iterator[Piece]]:
    """A function that renders messages, each with ``role`` and ``text``, as ``(text, is generated)`` pieces."""
    run = _sequence(parse(source))
    return lambda messages: run({"messages": messages}, False)


_MARKS = "|".join(map(re.escape, CONTROL))
_PIECES = re.compile(rf"((?:[^\\<\[]+|\\\\|\\(?:{_MARKS})|(?!{_MARKS})[<\[])*+)({_MARKS})")


def read_turns(formatted: Iterable[str]) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of each turn of this module's template, from its output in parts.

    Parts may end anywhere outside a control string or an escape.
    """
    role, left = "", ""
    for part in formatted:
        left, at = left + part, 0
        while m := _PIECES.match(left, at):
            body, mark, at = m[1], m[2], m.end()
            if mark == "[SEP]":
                role = unescape(body)
            elif mark in ("[/INST]", "</s>", "[/ROLE]"):
                yield {"[/INST]": "user", "</s>": "assistant"}.get(mark, role), unescape(body)
        left = left[at:]
    if left:
        raise ValueError(f"{left[:40]!r} is left after the last turn")


def render(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", template: str = TEMPLATE) -> DataFrame:
    """``conv_id, part, formatted, generated``: the output of each conversation, in parts.

    One row for each piece in order; ``generated`` marks text under the loss mask.  Rows of a
    conversation stay together and in order.  Rows are sorted by conversation, turn, role and
    text (nulls first) on disk where need be, and streamed, so no conversation is held.  Null
    roles and texts are empty; a null conversation is one like any other.
    """
    src = df.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    ordered = src.repartition(partitions(df.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    names = ["conv_id", "part", "formatted", "generated"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.bool_()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for conv, messages in grouped((r["conv_id"], r) for b in batches for r in b.to_pylist()):
            k = 0
            for text, marked in compile_template(template)(messages):
                rows.append((conv, k, text, marked))
                k += 1
                if len(rows) == 2048:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return ordered.mapInArrow(work, "conv_id long, part long, formatted string, generated boolean")


def grouped(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator]]:
    """Runs of equal keys, each as an iterator that pulls its rows as it is read."""
    from itertools import groupby

    for key, group in groupby(rows, key=lambda r: r[0]):
        yield key, (r[1] for r in group)


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from ``render``'s rows, in order."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def one(parts: Iterator[tuple[str, bool]]) -> tuple:
        turns, loss = hashlib.sha256(), hashlib.sha256()
        count = {"turns": 0, "loss": 0, "all": 0}

        def texts() -> Iterator[str]:
            for text, marked in parts:
                count["all"] += len(text)
                if marked:
                    plain = unescape(text)
                    count["loss"] += len(plain)
                    loss.update(plain.encode())
                yield text

        for role, text in read_turns(filter(None, joined(texts()))):
            count["turns"] += 1
            turns.update(f"{role}\n{text}\n".encode())
        return count["turns"], turns.hexdigest(), count["loss"], loss.hexdigest(), count["all"]

    def joined(texts: Iterator[str]) -> Iterator[str]:
        """Parts joined up to one that ends a turn: that is cheaper to match."""
        held: list[str] = []
        for t in texts:
            held.append(t)
            if t.endswith(("[/INST]", "</s>", "[/ROLE]")):
                yield "".join(held)
                held = []
        yield "".join(held)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for conv, parts in grouped((r["conv_id"], (r["formatted"], r["generated"])) for b in batches for r in b.to_pylist()):
            rows.append((conv, *one(parts)))
            if len(rows) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return formatted.mapInArrow(work, ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in zip(names, types)))
