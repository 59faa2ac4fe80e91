"""Tracking a stream of frames against the batch operator, across restarts, disorder and games that end."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from trackloom.config import Config
from trackloom.operators import ingest, tracking
from trackloom.schemas import BALL, ROBOT
from trackloom.streaming import tracking as online

SCHEMA = f"game_id string, msg_pos bigint, source_name string, timestamp_s double, frame_number bigint, ball {BALL}, yellow array<{ROBOT}>, blue array<{ROBOT}>"
CFG = replace(Config(), team_size=3)


@pytest.fixture
def store(spark):
    key, value = online.STORE
    spark.conf.set(key, value)
    yield
    spark.conf.unset(key)


def frames(n: int, start: float = 0.0, name: str = "g", seed: int = 5):
    r = random.Random(seed)
    out = []
    for k in range(n):
        robot = lambda i: (i + 10 * (r.random() < 0.05), None, "Unknown", i + r.uniform(-0.4, 0.4), r.uniform(-0.3, 0.3), r.uniform(-1, 1), 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)
        sees = lambda: [robot(i) for i in range(4) if r.random() < 0.85] or None
        ball = None if k % 7 == 0 else (0.1 * k, 0.2, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)
        out.append((name, k, None, start + k * 0.25, k, ball, sees(), sees()))
    return out


def run(spark, tmp_path, cfg=CFG, name="tracked", **more):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = (
        online.track_stream(stream, cfg, **more).writeStream.format("parquet").outputMode("append")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).start()
    )
    q.processAllAvailable()
    q.stop()


def put(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def told(df, cols):
    return sorted(map(str, df.select(*cols).collect()))


def test_a_stream_is_tracked_like_a_batch_and_restarts(spark, store, tmp_path):
    rows = frames(60) + frames(60, name="h", seed=6)
    r = random.Random(1)
    late = sorted(rows, key=lambda x: x[3] + r.uniform(0, 1.5))  # out of order by less than the delay
    for a in range(0, 60, 30):
        put(spark, tmp_path, late[a : a + 30])
    run(spark, tmp_path)
    first = spark.read.parquet(str(tmp_path / "out")).count()
    assert 0 < first < 60
    for a in range(60, 120, 30):
        put(spark, tmp_path, late[a : a + 30])
    put(spark, tmp_path, frames(1, start=1000.0, name="end"))
    put(spark, tmp_path, frames(1, start=1001.0, name="end"))
    run(spark, tmp_path)  # goes on from the checkpoint
    got = spark.read.parquet(str(tmp_path / "out")).where("game_id != 'end'")
    want = tracking.track(ingest.order_frames(spark.createDataFrame(rows, SCHEMA)), CFG)
    cols = ["game_id", "frame_pos", "msg_pos", "timestamp_s", "ball", "yellow", "blue", "yellow_swap", "blue_swap"]
    assert told(got, cols) == told(want, cols) and got.count() == 120
    assert {r["yellow_swap"] for r in got.collect()} == {True, False}


def test_a_silent_game_ends(spark, store, tmp_path):
    put(spark, tmp_path, frames(8))
    put(spark, tmp_path, frames(1, start=500.0, name="other"))
    put(spark, tmp_path, frames(1, start=501.0, name="other"))
    put(spark, tmp_path, frames(8, start=600.0))  # the name plays again
    put(spark, tmp_path, frames(1, start=2000.0, name="other"))
    put(spark, tmp_path, frames(1, start=2001.0, name="other"))
    run(spark, tmp_path, ends_after_s=60.0)
    got = spark.read.parquet(str(tmp_path / "out")).where("game_id = 'g'")
    batch = tracking.track(ingest.order_frames(spark.createDataFrame(frames(8), SCHEMA)), CFG)
    cols = ["frame_pos", "msg_pos", "yellow", "blue"]
    one = told(batch, cols)
    assert told(got.where("timestamp_s < 100"), cols) == told(got.where("timestamp_s > 100"), cols) == one


def test_the_state_survives_its_text():
    seen = [{"raw_id": 1, "x": 0.1, "y": 0.2, "theta": 0.30000000000000004}, {"raw_id": None, "x": 1.0, "y": 0.0, "theta": 0.0}]
    trackers = {s: tracking.Tracker() for s in online.SIDES}
    for _ in range(3):
        tracking.advance(trackers["yellow"], seen, 2, CFG.identity)
    again, pos = online.recall(online.remember(trackers, 7))
    assert pos == 7 and again == trackers and online.recall(None) == ({s: tracking.Tracker() for s in online.SIDES}, 0)


def test_growing_logs_are_followed(spark, tmp_path):
    """Batches have whole messages only, and a restarted stream goes on where it was."""
    import gzip
    import struct

    from tests.test_sources import field, log, packet
    from trackloom.sources import logs
    from trackloom.sources.logsource import TrackerLogs

    spark.dataSource.register(TrackerLogs)
    folder = tmp_path / "logs"
    folder.mkdir()
    message = lambda k: struct.pack(">qii", 0, 5, len(packet(k))) + packet(k)
    whole = {name: log([]) + b"".join(message(k) for k in range(40)) for name in ("a.log", "b.log")}
    sink = str(tmp_path / "out")

    def follow():
        stream = spark.readStream.format("tracker_log").option("mode", "permissive").load(str(folder))
        q = stream.select("path", "msg_pos", "kind", "frame_number").writeStream.format("parquet").option("path", sink).option("checkpointLocation", str(tmp_path / "state")).start()
        q.processAllAvailable()
        q.stop()

    def grow(name, share):
        data = whole[name]
        (folder / name).write_bytes(data[: int(len(data) * share)])

    grow("a.log", 0.31)  # ends inside a message
    (folder / "b.log").write_bytes(whole["b.log"][:9])
    follow()
    first = spark.read.parquet(sink).count()
    assert 0 < first < 40
    grow("a.log", 0.77)
    grow("b.log", 0.5)
    (folder / "c.log.gz").write_bytes(gzip.compress(log([(5, packet(1)), (3, field(1, 5))])))
    (folder / "bad.log").write_bytes(b"this is not a log at all")
    follow()
    for name in whole:
        grow(name, 1.0)
    follow()
    follow()
    cols = ["path", "msg_pos", "kind", "frame_number"]
    name = F.element_at(F.split("path", "/"), -1).alias("path")
    got = spark.read.parquet(sink).select(name, *cols[1:])
    want = logs.read_logs(spark, str(folder), mode="permissive").select(name, *cols[1:])
    assert told(got, cols) == told(want, cols) and got.count() == 83
