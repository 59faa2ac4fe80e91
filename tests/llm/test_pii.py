from __future__ import annotations

import random
import re

import numpy as np

from trackloom.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text: str) -> list:
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
                if not 12 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


def test_base_spans_against_the_patterns(texts):
    r = random.Random(2)
    made = ["".join(r.choices(["1", "23", "@", ".", "-", " ", "+", "a", "b.c", "(", "4111 1111 1111 1111", "x@y.z", "10.0.0.1", "٣"], k=30)) for _ in range(3000)]
    for t in [*texts.values(), *made]:
        assert pii.base_spans(t) == plain(t)


def test_query_form_and_added_spans(spark, docs, texts):
    model = pii.train_on(docs)
    rows = pii.report(docs, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]])
        listed = pii.listed(base)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in base) for k in pii.KINDS]
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))
    clean = "This sentence has 3 apples, room 12 and the year 1998, with nothing that is personal in it at all."
    assert pii.find(clean, model) == ([], [])


def test_field_finds_variants_that_the_patterns_miss(spark):
    r = random.Random(4)
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    make = [lambda: f"+1 ({digits(3)}) 555-{digits(4)}", lambda: f"u{digits(2)}@mail{digits(1)}.example.com", lambda: digits(3), lambda: ".".join(str(r.randrange(256)) for _ in range(4))]
    rows = [(i, f"word other {r.choice(make)()} more words") for i in range(400)]
    model = pii.train_on(spark.createDataFrame(rows, "doc_id long, text string"))
    held = [f"call them 1 ({digits(3)}) 555-{digits(4)} today please" for _ in range(50)]
    found = [pii.find(t, model) for t in held]
    assert sum(any(s[2] == "phone" for s in allspans) for _, allspans in found) >= 45
    assert all(not base for base, _ in found)
    assert sum(bool(pii.find(f"they ate {digits(2)} apples in {digits(4)} days", model)[1]) for _ in range(50)) <= 2


def test_dynamic_program_is_optimal(spark):
    """Against all segmentations of short stretches."""
    model = pii.Field().fit([("call +1 (504) 555-2652 now", [(5, 22, "phone")]), ("at 10.0.0.1 or 5", [(3, 11, "ip")]), ("no 12 here", [])] * 5)

    def best(text, toks, at):
        if at == len(toks):
            return 0.0
        out = model.off + best(text, toks, at + 1)
        for j in range(at, len(toks)):
            for i, rows in grid[j]:
                if i == at:
                    out = max(out, model.w[rows].sum(axis=0).max() + best(text, toks, j + 1))
        return out

    for text in ("x 1.2 y", "+1 555 2", "10.0.0.1 2"):
        toks = pii.tokens(text, 0, len(text))
        grid = model.lattice(text, toks)
        spans = model.decode(text, 0, len(text))
        index = {s: k for k, (s, _) in enumerate(toks)}
        ends = {e: k for k, (_, e) in enumerate(toks)}
        score = sum(model.w[next(rows for i, rows in grid[ends[e]] if i == index[s])].sum(axis=0)[pii.TYPES.index(t)] for s, e, t in spans)
        assert abs(score - best(text, toks, 0)) < 1e-9


def numeric(n: int) -> dict[str, str]:
    r = random.Random(9)
    return {
        "ones": "1 " * (n // 2), "csv": ",".join(str(r.randrange(10**5)) for _ in range(n // 6)), "two": " ".join(str(r.randrange(10, 100)) for _ in range(n // 3)),
        "hex": " ".join(f"{r.randrange(256):02x}" for _ in range(n // 3)), "floats": " ".join(f"{r.uniform(-99, 99):.4f}" for _ in range(n // 8)),
        "one number": "7" * n, "dates": "\n".join(f"2024-01-{r.randrange(30):02} 10:{r.randrange(60):02}:33.123 GET /a/{r.randrange(10**6)} 200" for _ in range(n // 40)),
    }


def test_numeric_text_has_few_candidates():
    """Less than two for each character, of any length, and each inside the bounds."""
    for name, text in numeric(20_000).items():
        found = list(pii.candidates(text, 0, len(text)))
        assert len(found) < 2 * len(text), name
        assert all(e - a <= pii.MAX_CHARS and "\n" not in text[a:e] for _, _, a, e in found)
    assert not list(pii.candidates("1 " * 1000, 0, 2000))


def test_groups_are_settled_like_the_whole():
    """Viterbi over all candidates of a stretch at once gives the same segments."""
    field = pii.Field().fit([("call +1 (504) 555-2652 now", [(5, 22, "phone")]), ("at 10.0.0.1 or 5", [(3, 11, "ip")]), ("no 12 here", []), ("card 4111 1111 1111 1111", [(5, 24, "card")])] * 5)
    field.w[field.index["bias"]] += 1.5  # so that candidates overlap
    for name, text in numeric(600).items():
        toks = pii.tokens(text, 0, len(text))
        scored: dict[int, list] = {}
        for i, j, a, e in pii.candidates(text, 0, len(text)):
            assert (toks[i][0], toks[j][1]) == (a, e)
            scored.setdefault(j, []).append((i, *field.score(text, a, e)))
        best = [0.0]
        for j in range(len(toks)):
            best.append(max([best[j]] + [best[i] + by for i, by, _ in scored.get(j, ())]))
        spans = list(field.decode(text, 0, len(text)))
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert abs(sum(field.score(text, a, e)[0] for a, e, _ in spans) - best[-1]) < 1e-6, name


def test_a_long_numeric_text_is_reported_whole(spark):
    model = pii.Field().fit([("call +1 (504) 555-2652 now", [(5, 22, "phone")]), ("no 12 here", [])] * 5)
    text = "1 " * 100_000 + "+1 (504) 555-2652 x " + "12,34," * 20_000
    rows = pii.report(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert rows[0]["n_phone"] == 1 and "phone:200000:200017" in rows[0]["spans"]


def test_gradient_against_all_segmentations():
    """The likelihood's slope, by enumerating every segmentation of a short stretch."""
    text, gold = "a +1 555 b", [(2, 8, "phone")]
    field = pii.Field()
    toks = pii.tokens(text, 0, len(text))
    grid = field.lattice(text, toks, grow=True)
    segments = [(i, j, rows) for j, here in enumerate(grid) for i, rows in here]
    want = next(k for k, (i, j, _) in enumerate(segments) if (toks[i][0], toks[j][1]) == gold[0][:2])
    case = pii.Case(grid, [(want, pii.TYPES.index("phone"))])
    w = np.random.default_rng(1).normal(0, 1, (len(field.index), len(pii.TYPES)))

    def all_from(at):
        if at == len(toks):
            yield 0.0, ()
            return
        for score, found in all_from(at + 1):
            yield score, found
        for k, (i, j, rows) in enumerate(segments):
            if i == at:
                for t, x in enumerate(w[rows].sum(axis=0)):
                    for score, found in all_from(j + 1):
                        yield x + score, ((k, t), *found)

    def loss():
        every = list(all_from(0))
        told = next(x for x, found in every if found == ((want, pii.TYPES.index("phone")),))
        return np.logaddexp.reduce([x for x, _ in every]) - told

    g = case.gradient(w, 0.0)
    for r, c in [(0, 0), (1, 3), (len(case.rows) - 1, 2), (3, 3), (5, 1)]:
        old, e = w[case.rows[r], c], 1e-5
        w[case.rows[r], c] = old + e
        up = loss()
        w[case.rows[r], c] = old - e
        assert abs((up - loss()) / (2 * e) - g[r, c]) < 1e-5
        w[case.rows[r], c] = old


def test_redaction_and_odd_rows(odd):
    model = pii.train_on(odd)
    out = pii.redact(odd, model)
    assert out.columns == odd.columns and out.count() == odd.count()
    text = next(r["text"] for r in out.collect() if r["doc_id"] == 10 and len(r["text"]) > 10)
    assert not re.search(r"@|555-2652|10\.20|4111", text) and "<email>" in text
    assert pii.report(odd.limit(0), pii.train_on(odd.limit(0))).count() == 0
    assert pii.base_spans("1" * 50_000) == []
    assert pii.base_spans("0" * 9000 + ".1.2.3") == [(0, 9006, "ip")]


def test_taught_spans_can_be_segments():
    r = random.Random(6)
    keys = ["f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda", "a" * 50 + "1" + "b" * 13, *["".join(r.choices("0123456789abcdef", k=40)) for _ in range(50)]]
    field = pii.Field()
    for key in [*keys, "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1"]:
        text = f"some words before the {key} and some after it"
        (gold,) = pii.teach(text)
        (a, e), = pii.stretches(text)
        toks = pii.tokens(text, a, e)
        grid = field.lattice(text, toks, grow=True)
        assert gold[:2] in {(toks[i][0], toks[j][1]) for j, here in enumerate(grid) for i, _ in here}
    seen = [f"the key {k} is old" for k in keys[2:]]
    model = pii.Field().fit([v for t in seen[:40] for v in pii.variants(t, pii.teach(t))])
    for t in seen[40:]:
        assert [(8, 48, "secret")] == pii.find(t, model)[1]


def test_each_claimed_variant_is_found_in_held_out_text():
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdefghijklmnoprstuvw", k=r.randint(3, 8)))

    def card():
        body = "4" + "".join(r.choices("0123456789", k=14))
        return next(body + d for d in "0123456789" if pii.luhn(body + d))

    email = lambda: f"{word()}@{word()}.{r.choice(['org', 'com', 'net'])}"
    phone = lambda: f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
    make = [email, card, phone, lambda: str(r.randint(1, 999))]
    rows = [f"{word()} {word()} {r.choice(make)()} {word()} {word()}" for _ in range(400)]
    model = pii.Field().fit([v for t in rows for v in pii.variants(t, pii.teach(t))])
    for kind, value in (("email", email), ("card", card), ("phone", phone)):
        old = [f"{word()} {word()} {value()} {word()}" for _ in range(40)]
        made = [[v for v in pii.variants(t, pii.teach(t)) if v[1] and v[0] != t] for t in old]
        assert {len(m) for m in made} == {3 if kind == "email" else 1}
        for of_one_form in zip(*made):
            assert sum(gold[0] in pii.find(t, model)[1] for t, gold in of_one_form) >= 36
            assert all(not pii.base_spans(t) for t, _ in of_one_form)
    plain = [f"{word()} met at {word()} and {word()} dot {word()}" for _ in range(40)]
    assert all(pii.find(t, model)[1] == [] for t in plain)
