from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from trackloom.llm import neardup, simhash
from trackloom.llm.components import connected_components


def plain_fingerprint(text: str) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(links: list[tuple[int, int]], nodes) -> dict[int, int]:
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_against_brute_force(docs, texts):
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    ids = sorted(fps)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if bin(fps[a] ^ fps[b]).count("1") <= 2]
    want = plain_components(links, ids)
    got = simhash.near_classes(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {d: (f"{fps[d]:016x}", want[d]) for d in ids}


def test_masks_cover_every_pair_within_the_radius():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        r = random.Random(radius)
        for _ in range(2000):
            flips = sum(1 << b for b in r.sample(range(64), radius))
            assert any(m & flips == 0 for m in masks)


def test_links_find_planted_pairs(spark):
    r = random.Random(5)
    fps = set()
    for _ in range(60):
        base = r.getrandbits(64)
        fps.add(base)
        for k in (1, 2, 2, 3):
            fps.add(base ^ sum(1 << b for b in r.sample(range(64), k)))
    fps = sorted(fps)
    want = plain_components([(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 2], fps)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    links = [(x["fp"] % 2**64, x["other"] % 2**64) for x in simhash.link(df).collect()]
    assert all(bin(a ^ b).count("1") <= 2 for a, b in links)
    assert plain_components(links, fps) == want


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)], "x long, y long")
    got = {r["node"]: r["root"] for r in connected_components(links, "x", "y").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert connected_components(links.limit(0), "x", "y").count() == 0


def test_odd_rows(odd):
    got = defaultdict(list)
    for r in simhash.near_classes(odd).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == odd.count()
    assert got[1][0]["component_id"] == got[2][0]["component_id"] == 1
    assert {got[d][0]["fingerprint"] for d in (3, 4, 5)} == {"0" * 16} and got[5][0]["component_id"] == 3
    assert got[13][0]["component_id"] == 8
    assert simhash.near_classes(odd.limit(0)).count() == 0


def test_near_duplicates_by_similarity(spark):
    r = random.Random(3)
    words = ["".join(r.choices("abcdefghij", k=6)) for _ in range(3000)]
    base = [r.choices(words, k=200) for _ in range(30)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i, w in enumerate(base):
        for copy, edits in ((1, 2), (2, 60)):
            v = list(w)
            for at in r.sample(range(200), edits):
                v[at] = r.choice(words)
            rows.append((100 * copy + i, " ".join(v)))
    rows.append((900, "  " + rows[0][1].upper()))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as id", "'y' as a")
    kept = neardup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == list(range(30)) + list(range(200, 230))
    sets = [neardup.shingles_of(neardup.words_of(rows[k][1]), 5) for k in (0, 30)]
    assert 0.8 <= neardup.jaccard(*sets) < 1 and neardup.jaccard(np.zeros(0), np.zeros(0)) == 1


def test_near_duplicates_of_odd_rows(odd):
    kept = [r["doc_id"] for r in neardup.drop_near_duplicates(odd).collect()]
    assert kept.count(None) == 1 and 1 in kept and 2 not in kept and 3 in kept and 4 not in kept and 13 not in kept
    assert neardup.drop_near_duplicates(odd.limit(0)).count() == 0


def test_near_duplicates_with_a_passage_added_cut_or_replaced(spark):
    r = random.Random(11)
    words = ["".join(r.choices("abcdefghij", k=6)) for _ in range(5000)]
    more = lambda n: r.choices(words, k=n)
    edits = [lambda w: w + more(40), lambda w: w[:-40], lambda w: w[:90] + more(10) + w[100:], lambda w: more(40) + w]
    rows, n = [], 30
    for k, edit in enumerate(edits):
        for i in range(n):
            w = more(200)
            rows += [(2 * (k * n + i), " ".join(w)), (2 * (k * n + i) + 1, " ".join(edit(w)))]
    sets = [neardup.shingles_of(neardup.words_of(t), 5) for _, t in rows]
    near = [a for a in range(0, len(rows), 2) if neardup.jaccard(sets[a], sets[a + 1]) >= 0.8]
    kept = {x["doc_id"] for x in neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(near) > 3 * n - 10 and kept == set(range(len(rows))) - {a + 1 for a in near}


def test_near_copies_within_a_family_that_shares_a_body(spark):
    """Twins of pages whose other pages, the central one too, are less than 0.8 alike."""
    r = random.Random(12)
    words = ["".join(r.choices("abcdefghij", k=6)) for _ in range(20000)]
    body, rows = r.choices(words, k=260), []
    for i in range(150):
        page = body + r.choices(words, k=50)
        twin = list(page)
        for at in r.sample(range(310), 5):
            twin[at] = r.choice(words)
        rows += [(2 * i, " ".join(page)), (2 * i + 1, " ".join(twin))]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    links = [(a, b) for a in range(300) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = {n for n, root in plain_components(links, range(300)).items() if n == root}
    kept = {x["doc_id"] for x in neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 100 < len(want) < 200 and kept == want
    few = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=16)
    assert {x["doc_id"] for x in few.collect()} == want


@pytest.mark.parametrize("copies, length, edits", [(150, 200, 3), (400, 200, 3), (150, 120, 2), (30, 200, 3), (150, 300, 4)])
def test_crowded_groups_near_the_limit(spark, copies, length, edits):
    """Copies of one text with a few words edited: many pairs are just below 0.8, some just above."""
    r = random.Random(copies + length)
    words = ["".join(r.choices("abcdefghij", k=6)) for _ in range(20000)]
    base, rows = r.choices(words, k=length), []
    for i in range(copies):
        w = list(base)
        for at in r.sample(range(length), edits * 3 if i % 2 else edits * 4):
            w[at] = r.choice(words)
        rows.append((i, " ".join(w)))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    links = [(a, b) for a in range(copies) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = {n for n, root in plain_components(links, range(copies)).items() if n == root}
    kept = {x["doc_id"] for x in neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=64).collect()}
    assert kept == want


def test_repeated_ids_are_documents_of_their_own(spark):
    text = "a unique text of its own with enough words to have several shingles in it"
    rows = [(1, "one " * 3 + text), (2, "one " * 3 + text), (2, "two other words that nobody else says in this way at all"), (2, "one " * 3 + text), (None, "null id " + text), (None, "null id " + text)]
    kept = sorted(map(tuple, neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert kept == sorted([rows[0], rows[2], rows[4]], key=repr)


def test_components_are_searched_again_by_their_roots_only(spark, monkeypatch):
    """What the first search has joined isn't sent through the driver's rounds again."""
    seen, search = [], neardup.connected_components
    monkeypatch.setattr(neardup, "connected_components", lambda links, *names: seen.append(links.count()) or search(links, *names))
    words = [f"w{k}" for k in range(100)]
    rows = [(i, " ".join([*words[: 60 + i], "x", *words[61 + i :]])) for i in range(6)] + [(9, "some other text of no matter")]
    kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 9]
    assert seen[0] >= 5 and seen[1:] == [0]
