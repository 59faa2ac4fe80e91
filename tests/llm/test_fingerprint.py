from __future__ import annotations

import hashlib

from trackloom.llm import fingerprint


def test_report_against_brute_force(docs, texts):
    order = sorted(texts, reverse=True)
    want = {}
    least: dict[bytes, int] = {}
    for d in texts:
        c = fingerprint.canonical(texts[d])
        least[c] = min(d, least.get(c, d))
    for d, nxt in zip(order, order[1:] + order[:1]):
        t, half = texts[d], len(texts[d]) // 2
        edited = t[: len(t) - half] + texts[nxt][:half]
        f = [fingerprint.digest(x) for x in (t, edited, texts[nxt])]
        want[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), f[0], f[1], float(f[0] == f[1]), float(f[0] == f[2]), least[fingerprint.canonical(t)])
    got = fingerprint.report(docs).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want


def test_canonical_form():
    assert fingerprint.digest("Ｆｉｌｅ  Straße") == fingerprint.digest(" file\nSTRASSE ")
    assert fingerprint.canonical(None) == b"" == fingerprint.canonical(" \n")
    assert fingerprint.digest("a b") != fingerprint.digest("ab")


def test_classes_with_colliding_hashes(odd, docs, texts):
    """With a hash of one hex digit, buckets hold many texts and the bytes must tell them apart."""
    by: dict[bytes, int] = {}
    for d, t in texts.items():
        by[fingerprint.canonical(t)] = min(d, by.get(fingerprint.canonical(t), d))
    got = fingerprint.classes(docs, hex_digits=1, bits=64).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {d: by[fingerprint.canonical(t)] for d, t in texts.items()}


def test_odd_rows(odd):
    rows = fingerprint.report(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 10)}
    assert by[2]["class_id"] == by[1]["class_id"] == 1 and by[4]["class_id"] == by[5]["class_id"] == 3 and by[13]["class_id"] == 8
    assert by[3]["n_chars"] == 0 and by[8]["fingerprint"] == by[13]["fingerprint"]
    assert fingerprint.report(odd.limit(0)).count() == 0
    one = fingerprint.report(odd.where("doc_id = 9")).first()
    assert one["near_next"] == 1.0
