from __future__ import annotations

import hashlib
import random
import struct
from array import array

import public_tokenizers
from tokenizers import Tokenizer

from trackloom.llm import bpe

PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text: str) -> list[int]:
    return PLAIN.encode(text, add_special_tokens=False).ids


def test_digests_against_the_library(docs, texts):
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.digests(docs).collect()}
    for d, t in texts.items():
        ids = ids_of(t)
        back = PLAIN.decode(ids, skip_special_tokens=False)
        assert got[d] == (len(ids), hashlib.sha256(b"".join(struct.pack("<I", i) for i in ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_random_texts_and_every_join():
    """Small chunks make joins everywhere, also in white space, specials and scripts without spaces."""
    tool = bpe.Encoder(bpe.vocabulary())
    r = random.Random(8)
    bits = ["a", "the", " ", "  ", "\n", "\t", "'s", "'", "12", "!", "é", "中文", "🙂", "<|endoftext|>", "<|endo", " ", " ", "́", "x y", "don't", " word", "...", "\x1c", "\x85"]
    mean, bpe.MEAN_CHUNK = bpe.MEAN_CHUNK, 6
    original = bpe.cuts.__defaults__
    bpe.cuts.__defaults__ = (6,)
    try:
        for _ in range(3000):
            t = "".join(r.choices(bits, k=r.randrange(60)))
            assert tool.encode(t).tolist() == ids_of(t), repr(t)
            assert tool.decode(tool.encode(t)) == t
    finally:
        bpe.MEAN_CHUNK, bpe.cuts.__defaults__ = mean, original
    assert tool.reused > tool.fresh


def test_every_character_between_letters():
    """The two libraries split alike around each character."""
    tool = bpe.Encoder(bpe.vocabulary())
    for start in range(0, 0x30000, 0x400):
        t = "".join(f"a{chr(c)}b {chr(c)} " for c in range(start, start + 0x400) if not 0xD800 <= c < 0xE000)
        assert tool.encode(t).tolist() == ids_of(t), hex(start)


def test_chunks_are_shared_between_texts():
    tool = bpe.Encoder(bpe.vocabulary())
    r = random.Random(1)
    words = ["".join(r.choices("abcdefgh", k=6)) for _ in range(500)]
    body = " ".join(r.choices(words, k=4000))
    tool.encode(body)
    fresh = tool.fresh
    tool.encode("a few other words in front, " + body + " and behind")
    assert tool.fresh - fresh < 0.15 * fresh


def test_shared_chunks_are_encoded_once(spark, docs, texts):
    """With room for all of them, every distinct chunk is encoded once, on the cluster if it comes back and else where it is."""
    parts = [c for t in texts.values() for part in t.split(bpe.SPECIAL) if part for c in bpe.chunks_of(part)]
    again = {c for c in parts if parts.count(c) > 1}
    shared = bpe.shared_chunks(docs)
    assert set(shared) == again and len(again) > 20
    tool = bpe.Encoder(bpe.vocabulary(), keep_bytes=1 << 30)
    tool.shared = shared
    assert all(tool.encode(t).tolist() == ids_of(t) for t in texts.values())
    assert tool.fresh + len(shared) == len(set(parts)) and tool.wholes == 0
    few = bpe.shared_chunks(docs, most=5)
    saved = lambda c: (parts.count(c) - 1) * len(c)
    assert len(few) == 5 and min(map(saved, few)) >= max(saved(c) for c in again - set(few))


def test_a_join_that_does_not_agree_is_encoded_whole():
    tool = bpe.Encoder(bpe.vocabulary())
    t = " ".join(f"some words number {i}" for i in range(400))
    chunk = bpe.chunks_of(t)[1]
    ids = tool.alone(chunk)
    at = next(iter(tool._safe(ids, range(1, len(ids)))))
    word = tool.token[ids[at]]
    wrong = [*ids[:at], *(tool.token.index(x) for x in (word[:2], word[2:])), *ids[at + 1 :]]
    tool.shared = {chunk: array("H", wrong).tobytes()}
    assert tool.encode(t).tolist() == ids_of(t) and tool.wholes == 1


BODIES = {
    "cyrillic": ("абвгдежзиклмнопрст", " "), "greek": ("αβγδεζηθικλμνξο", " "), "han": ("的一是不了人我在有他这中大来上国个到说们", "，"), "tabs": ("abcdefgh", "\t"),
    "lines": ("abcdefgh", "\n"), "accents": ("éèàüößñ", " "), "numbers": ("0123456789", ", "), "kana": ("あいうえおかきくけこ", "。"), "arabic": ("ابتثجحخد", " "),
}


def test_every_script_shares_its_chunks():
    for name, (letters, between) in BODIES.items():
        r = random.Random(3)
        words = ["".join(r.choices(letters, k=r.randrange(2, 8))) for _ in range(400)]
        body = between.join(r.choices(words, k=6000))
        tool = bpe.Encoder(bpe.vocabulary())
        assert tool.encode(body).tolist() == ids_of(body), name
        fresh, reused = tool.fresh, tool.reused
        again = f"in front {body} behind"
        assert tool.encode(again).tolist() == ids_of(again), name
        assert (tool.reused - reused) / (tool.reused - reused + tool.fresh - fresh) > 0.8 and tool.wholes == 0, name


def test_kinds_of_characters_split_as_the_library_does():
    """Wherever the kinds say so, the library begins a token, whatever stands on either side."""
    r = random.Random(4)
    some = ["a", "é", "я", "中", "1", "٣", "½", " ", "\n", "\t", "\u3000", "\xa0", "'", "’", "!", "，", "🙂", "\u0301", "\x1c", "\x85", "s", "t", "ll"]
    tool = bpe.Encoder(bpe.vocabulary())
    for _ in range(4000):
        left, right = "".join(r.choices(some, k=r.randrange(1, 6))), "".join(r.choices(some, k=r.randrange(1, 6)))
        if bpe.splits(bpe.kind_of(left[-1]), bpe.kind_of(right[0])):
            assert ids_of(left + right) == ids_of(left) + ids_of(right) == tool.encode(left + right).tolist(), (left, right)


def test_no_chunk_is_long(spark):
    for run in ("=", " ", "ab", "<br>", "é", "中", "🙂"):
        text = "words before. " + run * (200_000 // len(run)) + " and after"
        chunks = bpe.chunks_of(text)
        assert b"".join(chunks).decode() == text and max(map(len, chunks)) <= 8 * bpe.MEAN_CHUNK
        assert all(c.decode() for c in chunks)  # none is cut inside a character
    five = "=" * 5_000_000
    shared = bpe.shared_chunks(spark.createDataFrame([(1, "one " + five), (2, "two " + five)], "doc_id long, text string"))
    assert 0 < sum(len(k) + len(v) for k, v in shared.items()) < 64 << 10
    texts = [" ".join(f"w{i}" for i in range(20_000))] * 2
    few = bpe.shared_chunks(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), most_bytes=10_000)
    assert 5_000 < sum(map(len, few)) <= 10_000


def test_digests_of_odd_rows(odd):
    texts = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in odd.select("doc_id", "text").collect())
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["decoded_sha256"]) for r in bpe.digests(odd).collect())
    assert got == sorted((a, b, len(ids_of(t)), hashlib.sha256(t.encode()).hexdigest()) for a, b, t in texts)


def test_columns_and_odd_rows(odd):
    out = bpe.encode(odd)
    assert out.columns == [*(c for c in odd.columns if c not in ("token_ids", "round_trip")), "token_ids"]
    rows = out.collect()
    assert all(r["token_ids"] == ids_of(r["text"] or "") for r in rows)
    back = bpe.decode(out.select("doc_id", "text", "token_ids")).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    assert bpe.digests(odd.limit(0)).count() == 0
