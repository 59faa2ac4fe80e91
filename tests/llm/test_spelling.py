from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections import Counter

import pytest

from trackloom.llm import spelling


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(texts) -> dict[str, int]:
    out: Counter = Counter()
    for doc, text in texts:
        low = (text or "").encode().lower().decode()
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def plain_variants(n: dict[str, int]):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def rows(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_scan_of_a_sorted_list():
    r = random.Random(5)
    some = lambda: "".join(r.choices("ab", k=r.randrange(7)))
    for _ in range(400):
        listed = sorted({some() for _ in range(r.randrange(60))})
        query = some()
        assert [listed[k] for k in spelling.near_in_list(query, listed)] == [w for w in listed if one_edit(query, w)]


def test_the_scan_skips_words_that_part_early(monkeypatch):
    read = 0

    class Counted(list):
        def __getitem__(self, k):
            nonlocal read
            read += 1
            return super().__getitem__(k)

    listed = Counted(sorted(f"{a}{b}{i:04}" for a in "abcdefgh" for b in "abcdefgh" for i in range(200)))
    whole = list(listed)
    monkeypatch.setattr(spelling, "bisect_left", lambda _, x, lo: bisect_left(whole, x, lo))
    found = list(spelling.near_in_list("aa0007", listed))
    assert len(found) == sum(one_edit("aa0007", w) for w in whole)
    assert read < len(listed) / 10


@pytest.mark.parametrize("most", [2, 7, 4096])
def test_pairs_equal_brute_force_however_small_the_files(spark, most):
    r = random.Random(most)
    found = {"".join(r.choices("abé", k=r.randrange(1, 8))) for _ in range(220)} | {"same" + "".join(r.choices("abc", k=4)) for _ in range(60)}
    v = spark.createDataFrame([(w, 1) for w in found], "word string, n long")
    pairs = spelling.near_pairs(v, most=most).collect()
    want = {tuple(sorted((a, b), key=lambda w: (len(w), w))) for a in found for b in found if a != b and one_edit(a, b)}
    assert {(p["a"], p["b"]) for p in pairs} == want and len(pairs) == len(want)


def test_forms_and_roots(spark):
    n = {"colours": 1000, "colour": 2, "colors": 100, "coulors": 9, "color": 10, "colos": 1, "centre": 1, "abcdefg": 5, "abcdefh": 5, "abcdef": 50}
    got = rows(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == plain_variants(n)
    assert ("colos", "colors", "colours", 1, 2, 100) in got


def test_whole_report_equals_brute_force(docs, texts):
    n = plain_words(texts.items())
    n_near = plain_variants({w: c for w, c in n.items()})
    assert rows(spelling.report(docs)) == n_near


def test_odd_rows(spark, odd):
    texts = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    n = plain_words(texts)
    assert "consectetur" in n and rows(spelling.report(odd)) == plain_variants(n)
    assert spelling.report(odd.limit(0)).count() == 0
    assert spelling.report(odd.where("text is null")).count() == 0
    accents = spark.createDataFrame([(i, "ÉCOLIERS écoliers Écoliers") for i in range(40)], "doc_id long, text string")
    assert rows(spelling.report(accents)) == plain_variants(plain_words([(i, "ÉCOLIERS écoliers Écoliers") for i in range(40)]))
