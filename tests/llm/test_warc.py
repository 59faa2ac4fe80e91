from __future__ import annotations

import base64
import gzip
import hashlib

from trackloom.llm import queries, warc
from trackloom.llm.common import scratch_path


def test_against_brute_force(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet").collect()
    best: dict[str, int] = {}
    for p in pages:
        best[p["html"]] = max(best.get(p["html"], -1), p["page_id"])
    want = {}
    for p in pages:
        b = p["html"].encode()
        revisit = best[p["html"]] != p["page_id"]
        want[p["page_id"]] = (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", best[p["html"]] if revisit else None)
    assert {r["page_id"]: tuple(r)[1:] for r in queries.op9_warc(spark, data).collect()} == want


def test_copies_nulls_and_awkward_payloads(spark):
    rows = [(1, "u", "same"), (5, "u", "same"), (5, "u", "same"), (3, None, None), (4, "a b\r\nX: y", ""), (7, "u", "WARC/1.1\r\n\r\n\r\n\r\nx"), (8, "u", "é\r\n\r\n"), (None, "u", "same"), (None, "u", "alone")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as record_type", "'y' as payload_digest")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(warc.resolve_revisits(df), path, archive_bytes=300)
    read = warc.read_archives(spark, path).collect()
    assert len(read) == len(rows)
    kinds = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in read), key=repr)
    assert kinds == sorted([(1, "revisit", 5, 4), (5, "response", None, 4), (5, "response", None, 4), (3, "revisit", 4, 0), (4, "response", None, 0), (7, "response", None, 17), (8, "response", None, 6), (None, "revisit", 5, 4), (None, "response", None, 5)], key=repr)
    assert {bytes(r["payload"]).decode() for r in read if r["record_type"] == "response"} == {"same", "", rows[5][2], rows[6][2], "alone"}
    least = warc.resolve_revisits(df, least_bytes=5)
    assert {r["record_type"] for r in least.collect()} == {"response"}


def test_a_payload_on_a_third_of_the_pages(spark):
    """Headers alone are dealt out by payload; archives are bounded in bytes and hold one gzip member for each record."""
    rows = [(i, f"u{i}", "hot" * 50 if i % 3 == 0 else f"page {i // 2}") for i in range(3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    resolved = warc.resolve_revisits(df, bits=1 << 10)
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["html"]) for r in resolved.collect()}
    best: dict[str, int] = {}
    for i, _, h in rows:
        best[h] = max(best.get(h, -1), i)
    assert got == {i: ("response", None, h) if best[h] == i else ("revisit", best[h], None) for i, _, h in rows}
    path = scratch_path(spark, "warc-hot")
    warc.write_archives(resolved, path, archive_bytes=20_000)
    files = [bytes(r["content"]) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert len(files) > 8 and all(len(f) < 21_000 and f.endswith(warc.EMPTY_MEMBER) for f in files)
    assert sum(len(list(warc.members(f, step=100))) for f in files) == 3000
    assert gzip.decompress(files[0]).startswith(b"WARC/1.1")
    assert warc.read_archives(spark, path).where("record_type = 'response'").count() == len(best)


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-empty")
    warc.write_archives(warc.resolve_revisits(df), path)
    assert warc.read_archives(spark, path).count() == 0
