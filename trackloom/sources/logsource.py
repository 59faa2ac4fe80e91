"""``tracker_log``: tracker logs as a Spark data source.

A partition is one or several ranges of logs.  A range begins and ends at a message and knows the
place of its first one, so a long log is read by many tasks, each holding one message at a time.
Columns that the reader isn't asked for (by ``schema``) and kinds that aren't wanted (option
``kinds``) cost no decoding, and their bodies are passed over where the file can seek.
"""

from __future__ import annotations

import gzip
import io
import json
import zlib
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import logs

ROWS = 512
OPEN_COST = 4 << 20
#: Columns that a message has without its body.
HEADER = {"path", "msg_pos", "error"}
_OF_KIND = {
    logs.REFEREE_KIND: {"stage", "command", "blue_team_on_positive_half", "match_type", "yellow_name", "blue_name", "yellow_score", "blue_score"},
    logs.TRACKER_KIND: {"source_name", "timestamp_s", "frame_number", "robots", "balls"},
}
_NAMES = {logs.REFEREE_KIND: "referee", logs.TRACKER_KIND: "tracker"}


def _system(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def known_system(path: str) -> bool:
    try:
        _system(path)
    except (pa.ArrowException, OSError, ValueError, NotImplementedError):
        return False
    return True


def open_log(path: str) -> BinaryIO:
    system, inner = _system(path)
    return io.BufferedReader(system.open_input_file(inner), 1 << 18)


def unpacked(f: BinaryIO) -> BinaryIO:
    """The log's bytes: a compressed one is told by its first two."""
    packed = f.read(2) == b"\x1f\x8b"
    f.seek(0)
    return gzip.GzipFile(fileobj=f) if packed else f


def ranges_of(path: str, size: int, split_bytes: int) -> list[tuple[int, int, int]]:
    """``start, end, first place`` of pieces of about ``split_bytes``, by the headers alone.

    A compressed log, a short one and one that can't be read are one piece; what follows the last
    header that can be read belongs to the last piece, whose reader tells what is wrong.
    """
    if size <= split_bytes:
        return [(0, size, 0)]
    with open_log(path) as raw:
        if (f := unpacked(raw)) is not raw:
            return [(0, size, 0)]
        cuts = [(0, 0)]
        try:
            logs.begin(f)
            for pos, (at, _, _) in enumerate(logs.walk(f, 16, None, size, lambda kind: False)):
                if pos and at - cuts[-1][0] >= split_bytes:
                    cuts.append((at, pos))
        except ValueError:
            pass
    ends = [at for at, _ in cuts[1:]] + [size]
    return [(at, end, pos) for (at, pos), end in zip(cuts, ends)]


def plan(spark: SparkSession, files: list[tuple[str, int]], split_bytes: int) -> list[list]:
    """Ranges ``path, size, start, end, first place`` of all files; the headers of long ones are read by tasks."""
    short = [[p, n, 0, n, 0] for p, n in files if n <= split_bytes]
    long = [(p, n) for p, n in files if n > split_bytes]
    if not long:
        return short

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                rows = [{"path": r["path"], "size": r["size"], "a": a, "z": z, "pos": pos} for a, z, pos in ranges_of(r["path"], r["size"], split_bytes)]
                yield pa.RecordBatch.from_pylist(rows)

    cut = spark.createDataFrame(long, "path string, size long").repartition(min(len(long), 1000))
    return short + [list(r) for r in cut.mapInArrow(work, "path string, size long, a long, z long, pos long").collect()]


def rows_of(
    path: str, opened: Callable[[], BinaryIO], size: int | None, arrow: pa.Schema, mode: str, kinds: set[str], start: int = 0, end: int | None = None, first: int = 0
) -> Iterator[pa.RecordBatch]:
    """A range's messages as batches of the schema's columns."""
    asked = set(arrow.names)

    def wanted(kind: int) -> bool:
        if kinds and _NAMES.get(kind, "other") not in kinds:
            return False
        return "kind" in asked or bool(asked & _OF_KIND.get(kind, set()))

    rows: list[dict] = []
    pos, error = first - 1, None
    try:
        with opened() as raw:
            f = unpacked(raw)
            if f is not raw:
                size = None
            if start:
                f.seek(start)
            else:
                logs.begin(f)
            # A compressed log's range ends with the file: its length is another once it is unpacked.
            for pos, (_, kind, body) in enumerate(logs.walk(f, start or 16, end if f is raw else None, size, wanted), first):
                row = logs.decoded(path, pos, kind, body)
                if not kinds or row["kind"] in kinds:
                    rows.append(row)
                if len(rows) == ROWS:
                    yield pa.RecordBatch.from_pylist(rows, arrow)
                    rows = []
    except (ValueError, EOFError, OSError, zlib.error) as e:
        if mode == "failfast":
            raise ValueError(f"{path}: {e}") from e
        error = str(e)
    if error is not None and (not kinds or "error" in kinds):
        rows.append({"path": path, "kind": "error", "error": error})
    if error is None and pos < 0 and (not kinds or "empty" in kinds):
        rows.append({"path": path, "kind": "empty"})
    if rows:
        yield pa.RecordBatch.from_pylist(rows, arrow)


@dataclass
class Ranges(InputPartition):
    pieces: list[list]


class LogReader(DataSourceReader):
    def __init__(self, schema: StructType, options: Mapping[str, str]):
        self.schema, self.options = schema, options

    def partitions(self) -> list[Ranges]:
        """Ranges packed until they weigh ``splitBytes``, a file at least ``OPEN_COST``."""
        most = int(self.options.get("splitBytes", 128 << 20))
        if "ranges" in self.options:
            pieces = json.loads(self.options["ranges"])
        else:
            pieces = [[p, n, a, z, pos] for p, n in _listed(self.options.get("path", "")) for a, z, pos in ranges_of(p, n, most)]
        out: list[Ranges] = []
        weight = most
        for piece in sorted(pieces, key=lambda x: (x[2] - x[3], x[0], x[2])):
            own = piece[3] - piece[2] + OPEN_COST
            if weight + own > most:
                out.append(Ranges([]))
                weight = 0
            out[-1].pieces.append(piece)
            weight += own
        return out or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        kinds = set(filter(None, self.options.get("kinds", "").split(",")))
        for path, size, start, end, first in partition.pieces:
            yield from rows_of(path, lambda p=path: open_log(p), size, arrow, self.options.get("mode", "failfast"), kinds, start, end, first)


class LogFollower(DataSourceStreamReader):
    """Logs of a folder as they grow: each batch has the messages that are whole by then.

    An offset has the bytes and messages that are read of each log, so a batch can be read again
    after a failure.  Only headers of new bytes are read to plan one.  A compressed log is taken once, as it is
    when it is first seen; a log that can't be read is one row, or stops a fail-fast stream.
    """

    def __init__(self, schema: StructType, options: Mapping[str, str]):
        self.inner = LogReader(schema, options)
        self.path = options.get("path", "")
        self.seen: dict[str, list[int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        for path, size in _listed(self.path):
            at, pos = self.seen.get(path, (0, 0))
            if at < size and (found := _whole_until(path, at, pos, size)) is not None:
                self.seen[path] = found
        return dict(self.seen)

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        for path, (at, pos) in end.items():  # what a restarted stream has read already
            if self.seen.get(path, (0, 0))[0] < at:
                self.seen[path] = [at, pos]
        pieces = []
        for path, (z, _) in sorted(end.items()):
            a, pos = start.get(path, (0, 0))
            if a < z:
                pieces.append([path, z, a, z, pos])
        return [Ranges([p]) for p in pieces] or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        return self.inner.read(partition)


#: Instead of a number of messages: a log that is read once, compressed or not one at all.
_ONCE = -1


def _whole_until(path: str, at: int, pos: int, size: int) -> list[int] | None:
    """Bytes and messages of a log up to its last whole message, from where it is read to; None if none is new."""
    if pos == _ONCE or size < 16:
        return None
    with open_log(path) as raw:
        if at == 0:
            if unpacked(raw) is not raw:
                return [size, _ONCE]
            try:
                logs.begin(raw)
            except ValueError:
                return [size, _ONCE]
            at = 16
        raw.seek(at)
        last, n = at, pos
        try:
            for last, _, _ in logs.walk(raw, at, None, size, lambda kind: False):
                n += 1
        except ValueError:  # the next message is still being written
            pass
        if n == pos:
            return None
        raw.seek(last)
        return [last + 16 + int.from_bytes(raw.read(16)[12:16], "big"), n]


def _listed(path: str) -> list[tuple[str, int]]:
    """Logs under a file or folder, by path."""
    from pyarrow import fs

    system, inner = _system(path)
    info = system.get_file_info(inner)
    found = system.get_file_info(fs.FileSelector(inner, recursive=True)) if info.type == fs.FileType.Directory else [info]
    base = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    return sorted((base + i.path, i.size) for i in found if i.is_file and i.path.endswith((".log", ".log.gz")))


class TrackerLogs(DataSource):
    """``spark.read.format("tracker_log").load(folder)``, or ``readStream``, once it is registered; ``logs.read_logs`` does so.

    Options: ``mode`` (``failfast``, ``permissive``), ``kinds``, ``splitBytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "tracker_log"

    def schema(self) -> str:
        return logs.MESSAGES

    def reader(self, schema: StructType) -> LogReader:
        return LogReader(schema, self.options)

    def streamReader(self, schema: StructType) -> LogFollower:
        return LogFollower(schema, self.options)
