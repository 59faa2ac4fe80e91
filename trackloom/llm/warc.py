"""WARC archives with payload deduplication by revisit records.

Records are resolved by their headers alone: the payload digest and the record's id.  Of the
records with equal payloads the one with the largest id stays a response; the others become
revisit records that refer to it and carry no payload.  Archives are bounded in bytes, so that
each is read in one piece, and written by Spark's text sink, so that writing commits like any
other Spark output on any file system and a lost task is simply run again.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

END = "\r\n\r\n"
#: Fixed value: a gzip member without content.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def base32_sha1(data: Column) -> Column:
    """SHA-1 in base 32: five hex digits are four base-32 digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve_revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url", least_bytes: int = 0, bits: int = 1 << 22, salts: int = 16) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, record_type, refers_to``; a revisit's ``html`` is null.

    A null payload is the empty one.  Payloads under ``least_bytes`` are all responses.  Rows
    that repeat the largest id of their payload are responses too; a payload whose rows all
    have null ids has only responses.

    Headers are written once and resolved among themselves.  A bitmap of at most ``bits / 64``
    words, which is all that is broadcast, tells which payloads may occur more than once; the
    others are responses where they stand, and their html isn't shuffled.  Of the rest, each
    task sends one html for a payload, however many rows have it; the rows themselves move as
    headers, those of one payload over ``salts`` tasks.  More repeated payloads than bits let
    more html through and change no result.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "_mark": F.xxhash64("html")})
    digest = base32_sha1(F.encode("html", "UTF-8")).alias("payload_digest")
    large = F.col("payload_bytes") >= least_bytes
    place = F.pmod("_mark", F.lit(bits))
    word, bit = F.shiftright(place, 6), F.expr(f"shiftleft(1L, cast(pmod(_mark, {bits}) & 63 as int))")
    repeated = rows.where(large).groupBy("_mark").agg(F.count("*").alias("n")).where("n > 1")
    words = repeated.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = rows.join(F.broadcast(materialize(words, "revisit-bitmap")), word == F.col("_word"), "left")
    met = large & (F.coalesce("_bits", F.lit(0).cast("long")).bitwiseAND(bit) != 0)
    none = F.lit(None).cast("long")
    once = marked.where(~met).select("page_id", "url", "html", "payload_bytes", digest, F.lit("response").alias("record_type"), none.alias("refers_to"))
    headers = materialize(marked.where(met).select("page_id", "url", "payload_bytes", digest, F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).alias("salt")), "headers")
    first = headers.groupBy("payload_digest").agg(F.max("page_id").alias("original"))
    salted = first.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    decided = headers.join(salted, ["payload_digest", "salt"])
    again = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    payloads = marked.where(met).groupBy(digest).agg(F.first("html").alias("html"))
    names = ("page_id", "url", "html", "payload_bytes", "payload_digest")
    revisits = decided.where(again).withColumn("html", F.lit(None).cast("string")).select(*names, F.lit("revisit").alias("record_type"), F.col("original").alias("refers_to"))
    kept = decided.where(~again).join(payloads, "payload_digest").select(*names, F.lit("response").alias("record_type"), none.alias("refers_to"))
    return once.unionByName(revisits).unionByName(kept)


def record_text() -> Column:
    """A WARC record."""
    uri = F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\x00-\x20\x7F]", "_")
    name = lambda c: F.concat(F.lit("<urn:trackloom:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Target-URI", uri),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", name(F.col("refers_to"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
        F.lit(END),
    )


def write_archives(records: DataFrame, path: str, archive_bytes: int = 32_000_000, level: int = 6) -> None:
    """Write resolved records as archives under ``path``; files are ``part-*.txt``, with one gzip member for each record.

    An archive ends with the record that takes it to ``archive_bytes`` compressed bytes, and
    with an empty member, which is what the sink's separator is.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for b in batches:
            for text in b.column(0):
                held.append(gzip.compress(text.as_py().encode("utf-8"), level, mtime=0))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])

    archives = records.select(record_text().alias("value")).mapInArrow(pack, "value binary")
    (
        archives.select(F.col("value").cast("string").alias("value"))
        .write.mode("append").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("compression", "none")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def members(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The contents of the gzip members of an archive, one at a time; empty ones are passed over."""
    at = 0
    while at < len(data):
        one, content = zlib.decompressobj(31), []
        while not one.eof:
            piece = data[at : at + step]
            if not piece:
                raise ValueError("an archive ends inside a gzip member")
            content.append(one.decompress(piece))
            at += len(piece) - len(one.unused_data)
        if any(content):
            yield b"".join(content)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive: header fields by lower-case name, and the block."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        begin = head + 4
        end = begin + int(fields["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} isn't ended")
        yield fields, data[begin:end]
        at = end + 4


def _id(name: str | None) -> int | None:
    last = (name or "").strip("<>").rpartition(":")[2]
    return int(last) if last not in ("", "null") else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload``.

    ``payload`` is null for revisits; ``payload_bytes`` is that of the full payload, and a
    response's digest is computed from the bytes that were read.
    """
    schema = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]

    def records(data: bytes) -> Iterator[tuple]:
        for part in members(data) if data[:2] == b"\x1f\x8b" else [data]:
            for h, block in parse_archive(part):
                http, _, payload = block.partition(b"\r\n\r\n")
                kind, response = h["warc-type"], h["warc-type"] == "response"
                size, digest = int(http.decode().rpartition("Content-Length: ")[2]), h["warc-payload-digest"].removeprefix("sha1:")
                if response:
                    size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                yield _id(h["warc-record-id"]), h["warc-target-uri"], kind, _id(h.get("warc-refers-to")), digest, size, payload if response else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for b in batches:
            for content in b.column(0):
                for row in records(content.as_py()):
                    rows.append(row)
                    held += len(row[-1] or b"")
                    if len(rows) == 1024 or held > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(work, schema)
