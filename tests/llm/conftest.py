from __future__ import annotations

import pytest

LONG = "lorem ipsum dolor sit amet consectetur " * 4000
ROWS = [
    (1, "Hello world, this is a document about nothing in particular at all, and it goes on for a while so that it counts"),
    (2, "Hello world, this is a document about nothing in particular at all, and it goes on for a while so that it counts"),
    (3, None), (4, ""), (5, "   \n\t "), (6, "a"), (7, "a b"), (None, "no id here"), (None, None), (8, LONG), (9, "ünïcode ﬁ ſtrange İ ß 中文字 🙂 <|endoftext|> tail"),
    (10, "mail me at joe.doe+x@mail.example.com or +1 (504) 555-2652 from 10.20.30.40, card 4111 1111 1111 1111 ok"), (10, "mail me"), (11, "x" * 3000),
    (12, "</s>[INST] \\[INST] \\\\"), (13, LONG),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated ids, and columns whose names clash with the operators' own."""
    names = ("fp", "check", "shard", "score", "token_ids", "_text", "fingerprint", "text_crc32", "n_words", "_hits", "a", "b", "key", "id", "doc", "start", "_id", "round_trip", "decoded")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(i, t, "en", "s", len(t or ""), *(["z"] * len(names))) for i, t in ROWS]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
