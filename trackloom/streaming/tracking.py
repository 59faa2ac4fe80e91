"""Identity tracking of a stream: the batch operator's state machine over frames as they come.

A game's state is its tracks and the frames that still wait.  A frame waits until the watermark has
passed it, so frames that arrive out of order within the delay are tracked in the order of time,
as in a batch; later ones are dropped by Spark.  A timer ends a game that has been silent.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..config import Config, IdentityConfig
from ..operators.tracking import Track, Tracker, advance
from ..schemas import ROBOT

SIDES = ("yellow", "blue")
ORDER = ("timestamp_s", "frame_number", "msg_pos")
#: What the state store has to be for this operator.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def remember(trackers: dict[str, Tracker], frame_pos: int) -> str:
    sides = {s: [t.next_id, [[k.stable_id, k.role, k.missing, k.state] for k in t.tracks]] for s, t in trackers.items()}
    return json.dumps([frame_pos, sides])


def recall(text: str | None) -> tuple[dict[str, Tracker], int]:
    if text is None:
        return {s: Tracker() for s in SIDES}, 0
    frame_pos, sides = json.loads(text)
    tracks = lambda rows: [Track(i, state, role, missing) for i, role, missing, state in rows]
    return {s: Tracker(next_id, tracks(rows)) for s, (next_id, rows) in sides.items()}, frame_pos


class FrameTracker(StatefulProcessor):
    def __init__(self, size: int, identity: IdentityConfig, out: list[str], ends_after_ms: int):
        self.cfg = (size, identity)
        self.out, self.ends_after_ms = out, ends_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tracks = handle.getValueState("tracks", "value string")
        #: Time in milliseconds and the frame.
        self.waiting = handle.getListState("waiting", "at bigint, frame string")
        self.ends = handle.getValueState("ends", "at bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        last = None
        for r in rows:
            at = r["_at"]
            self.waiting.appendValue((at, json.dumps({k: v for k, v in r.asDict(True).items() if k not in ("event_time", "_at")})))
            last = at if last is None else max(last, at)
        if last is not None:
            self.handle.registerTimer(last)
            known = self.ends.get()[0] if self.ends.exists() else None
            if known is None or known < last + self.ends_after_ms:
                if known is not None:
                    self.handle.deleteTimer(known)
                self.ends.update((last + self.ends_after_ms,))
                self.handle.registerTimer(last + self.ends_after_ms)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        ready, rest = [], []
        for at, frame in self.waiting.get():
            (ready if at <= passed else rest).append((at, frame))
        if ready:
            yield from self._advance([json.loads(f) for _, f in ready])
            if rest:
                self.waiting.put(rest)
            else:
                self.waiting.clear()
        if self.ends.exists() and self.ends.get()[0] <= passed and not rest:
            for state in (self.tracks, self.waiting, self.ends):
                state.clear()

    def _advance(self, frames: list[dict]) -> Iterator[Row]:
        trackers, frame_pos = recall(self.tracks.get()[0] if self.tracks.exists() else None)
        for f in sorted(frames, key=lambda f: tuple(f[c] for c in ORDER)):
            f |= {"frame_pos": frame_pos}
            for s in SIDES:
                f[s], f[f"{s}_swap"] = advance(trackers[s], [r for r in f[s] or [] if r], *self.cfg)
            yield Row(**{c: f[c] for c in self.out})
            frame_pos += 1
        self.tracks.update((remember(trackers, frame_pos),))

    def close(self) -> None:
        pass


def track_stream(raw: DataFrame, cfg: Config, watermark: str = "2 seconds", ends_after_s: float = 600.0) -> DataFrame:
    """Raw frames of a stream as ``ingest.order_frames`` and ``tracking.track`` give them for a batch.

    ``raw`` may have ``event_time`` beside the columns of raw frames; without it, it is made of
    ``timestamp_s``, a day later, since a watermark begins at zero and frames at it are late.  The session's state store has to be what ``STORE`` names.  Rows without a game, a
    time or a number can't be put in order and are left out.  A game that no frame comes of for
    ``ends_after_s`` seconds is over; frames of its name that come then are a new game.
    """
    keep = [c for c in raw.columns if c not in ("event_time", "frame_pos", *SIDES, *(f"{s}_swap" for s in SIDES))]
    typed = raw.select(
        *keep, *[F.col(s).cast(f"array<{ROBOT}>").alias(s) for s in SIDES],
        (F.col("event_time") if "event_time" in raw.columns else F.timestamp_seconds(F.col("timestamp_s") + 86400)).alias("event_time"),
    ).dropna(subset=["game_id", *ORDER])
    timed = typed.withColumn("_at", F.unix_millis("event_time"))
    shape = typed.select(*keep, F.lit(0).cast("bigint").alias("frame_pos"), *SIDES, *[F.lit(False).alias(f"{s}_swap") for s in SIDES]).schema
    out = StructType([f for f in shape])
    for f in out:
        f.nullable = True
    processor = FrameTracker(cfg.team_size, cfg.identity, out.names, int(ends_after_s * 1000))
    return timed.withWatermark("event_time", watermark).groupBy("game_id").transformWithState(processor, out, "append", "eventTime")
