"""Tracker logs: the public framed log format, decoded in tasks.

A log is ``SSL_LOG_FILE``, a version, and messages of a time, a kind, a size and a protobuf
body, big-endian.  Only the fields that the pipelines need are read from a body; a body that
can't be decoded is skipped, like messages of other kinds.
"""

from __future__ import annotations

import io
import json
import struct
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..shipping import ship

MAGIC = b"SSL_LOG_FILE"
REFEREE_KIND, TRACKER_KIND = 3, 5
_SEEN = "struct<raw_id:bigint,team:int,x:double,y:double,theta:double,vx:double,vy:double,omega:double,visibility:double>"
_BALL = "struct<x:double,y:double,z:double,vx:double,vy:double,visibility:double>"
MESSAGES = (
    "path string, msg_pos bigint, kind string, source_name string, timestamp_s double, frame_number bigint, "
    f"robots array<{_SEEN}>, balls array<{_BALL}>, stage int, command int, blue_team_on_positive_half boolean, match_type int, "
    "yellow_name string, blue_name string, yellow_score bigint, blue_score bigint, error string"
)


def walk(f: BinaryIO, at: int, end: int | None, size: int | None, wanted: Callable[[int], bool] = lambda kind: True) -> Iterator[tuple[int, int, bytes | None]]:
    """``place, kind, body`` of the messages that begin in front of ``end``; bodies that aren't wanted are passed over.

    ``f`` stands at ``at``, and ``size`` is the file's if that is known, so that a wrong length is
    told before anything is read.
    """
    while end is None or at < end:
        head = f.read(16)
        if len(head) < 16:
            return
        _, kind, n = struct.unpack(">qii", head)
        at += 16
        if n < 0 or (size is not None and at + n > size):
            raise ValueError("the log ends inside a message")
        body = f.read(n) if wanted(kind) else None
        if body is None:
            left = n
            if f.seekable():
                f.seek(at + n)
                left = 0
            while left:
                got = len(f.read(min(left, 1 << 20)))
                if not got:
                    raise ValueError("the log ends inside a message")
                left -= got
        elif len(body) < n:
            raise ValueError("the log ends inside a message")
        yield at - 16, kind, body
        at += n


def begin(f: BinaryIO) -> None:
    """Pass over the mark and the version, or tell that this is no log."""
    if f.read(16)[:12] != MAGIC:
        raise ValueError("not a log file")


def wire(data: bytes) -> dict[int, list]:
    """A protobuf body as lists by field: ints, or bytes for fixed and length-delimited fields."""
    out: dict[int, list] = {}
    at = 0

    def varint() -> int:
        nonlocal at
        x = shift = 0
        while True:
            b = data[at]
            at += 1
            x |= (b & 127) << shift
            if b < 128:
                return x
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: object = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or (varint() if kind == 2 else -1)
            if size < 0 or at + size > len(data):
                raise ValueError("a field is cut off")
            value = data[at : at + size]
            at += size
        out.setdefault(tag >> 3, []).append(value)
    return out


def _real(fields: dict[int, list], n: int) -> float | None:
    raw = fields.get(n, [None])[-1]
    return None if raw is None else struct.unpack("<f" if len(raw) == 4 else "<d", raw)[0]


def _point(fields: dict[int, list], n: int) -> dict[int, list]:
    return wire(fields[n][-1]) if n in fields else {}


def tracker(body: bytes) -> dict | None:
    packet = wire(body)
    if 3 not in packet:
        return {"source_name": packet[2][-1].decode() if 2 in packet else None}
    frame = wire(packet[3][-1])
    robots, balls = [], []
    for raw in frame.get(4, []):
        r = wire(raw)
        who, pos, vel = _point(r, 1), _point(r, 2), _point(r, 4)
        robots.append({
            "raw_id": who.get(1, [None])[-1], "team": who.get(2, [0])[-1], "x": _real(pos, 1), "y": _real(pos, 2), "theta": _real(r, 3),
            "vx": _real(vel, 1), "vy": _real(vel, 2), "omega": _real(r, 5), "visibility": _real(r, 6),
        })
    for raw in frame.get(3, []):
        b = wire(raw)
        pos, vel = _point(b, 1), _point(b, 2)
        balls.append({"x": _real(pos, 1), "y": _real(pos, 2), "z": _real(pos, 3), "vx": _real(vel, 1), "vy": _real(vel, 2), "visibility": _real(b, 3)})
    return {
        "source_name": packet[2][-1].decode() if 2 in packet else None, "timestamp_s": _real(frame, 2), "frame_number": frame.get(1, [0])[-1],
        "robots": robots, "balls": balls,
    }


def referee(body: bytes) -> dict:
    r = wire(body)
    yellow, blue = _point(r, 7), _point(r, 8)
    name = lambda t: t[1][-1].decode() if 1 in t else None
    one = lambda n: r.get(n, [None])[-1]
    side = one(10)
    return {
        "stage": one(2), "command": one(4), "blue_team_on_positive_half": None if side is None else bool(side), "match_type": one(19),
        "yellow_name": name(yellow), "blue_name": name(blue), "yellow_score": yellow.get(2, [None])[-1], "blue_score": blue.get(2, [None])[-1],
    }


def decoded(path: str, pos: int, kind: int, body: bytes | None) -> dict:
    """A message as a row; a body that can't be decoded makes it ``undecodable``, one that wasn't read stays empty."""
    row = {"path": path, "msg_pos": pos, "kind": {REFEREE_KIND: "referee", TRACKER_KIND: "tracker"}.get(kind, "other")}
    try:
        row |= {} if body is None else referee(body) if kind == REFEREE_KIND else tracker(body) if kind == TRACKER_KIND else {}
    except (ValueError, IndexError, struct.error):
        row["kind"] = "undecodable"
    return row


def read_logs(
    spark: SparkSession, *paths: str, mode: str = "failfast", columns: Sequence[str] | None = None, kinds: Sequence[str] | None = None, split_bytes: int = 128 << 20
) -> DataFrame:
    """All messages of logs under files, folders or globs (``*.log``, ``*.log.gz``), one row each.

    ``failfast`` raises on a log that can't be read; ``permissive`` gives it one row with
    ``error``.  A log without messages has one row of kind ``empty``.  ``columns`` and ``kinds``
    prune: bodies that nothing asks for are neither read nor decoded.

    Spark lists the files, and logs over ``split_bytes`` are cut at messages by a job that reads
    their headers only; ranges are what the ``tracker_log`` data source reads, each in constant
    memory.  Compressed logs aren't cut, but streamed.  A file system that pyarrow doesn't know
    is read through Spark's ``binaryFile``, whole logs at a time.
    """
    from .logsource import TrackerLogs, known_system, plan

    if mode not in ("failfast", "permissive"):
        raise ValueError(mode)
    schema = spark.createDataFrame([], MESSAGES).schema
    if columns is not None:
        schema = StructType([schema[c] for c in columns])
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    files = listed.where(F.col("path").rlike(r"\.log(\.gz)?$"))
    found = [(r["path"], r["length"]) for r in files.select("path", "length").collect()]  # as short as Spark's own listing
    if not all(known_system(p) for p, _ in found[:1]):
        return _whole_logs(files, schema, mode, kinds)
    ship(spark)
    spark.dataSource.register(TrackerLogs)
    options = {"ranges": json.dumps(plan(spark, found, split_bytes)), "mode": mode, "splitBytes": str(split_bytes)}
    return spark.read.format("tracker_log").schema(schema).options(**options | ({"kinds": ",".join(kinds)} if kinds else {})).load()


def _whole_logs(files: DataFrame, schema: StructType, mode: str, kinds: Sequence[str] | None) -> DataFrame:
    from .logsource import rows_of

    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                yield from rows_of(path, lambda c=content: io.BytesIO(c.as_py()), None, arrow, mode, set(kinds or ()))

    return files.select("path", "content").mapInArrow(work, schema)


def list_games(spark: SparkSession, folder: str) -> DataFrame:
    """``path, game_id, length`` of a folder's own logs, by path; contents are not read."""
    from ..operators.ingest import game_id_from_path

    files = spark.read.format("binaryFile").load(folder).where(F.col("path").rlike(r"\.log(\.gz)?$"))
    return files.select("path", game_id_from_path(F.col("path")).alias("game_id"), "length").orderBy("path")


def packets(log: DataFrame) -> DataFrame:
    """Tracker packets as ``ingest.frames_from_tracker`` takes them."""
    from ..operators.ingest import game_id_from_path

    return log.where("kind = 'tracker'").withColumn("game_id", game_id_from_path(F.col("path")))


def referee_messages(log: DataFrame) -> DataFrame:
    from ..operators.ingest import game_id_from_path

    cols = ["stage", "command", "blue_team_on_positive_half", "match_type", "yellow_name", "blue_name", "yellow_score", "blue_score"]
    return log.where("kind = 'referee'").select(game_id_from_path(F.col("path")).alias("game_id"), "msg_pos", *cols)


def check_unique_games(log: DataFrame) -> None:
    """Logs with the same file name in different folders would be one game: an error."""
    from ..operators.ingest import game_id_from_path

    twice = log.select("path").distinct().groupBy(game_id_from_path(F.col("path")).alias("game_id")).count().where("count > 1")
    if found := twice.take(3):
        raise ValueError(f"several logs for {[r['game_id'] for r in found]}")
