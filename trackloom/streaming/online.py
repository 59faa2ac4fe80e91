"""Sequences online: gap and possession breaks over a stream of frames, with a watermark.

Windows over rows don't exist on streams, so this is a keyed state machine.  A game's state is
its open segment: counts, ends and the last frame's ball.  Frames that come late by more than
the watermark are dropped by Spark before they get here; within a batch they are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import Config

OUT = "game_id string, start_time_s double, end_time_s double, start_frame bigint, end_frame bigint, frame_count bigint"
STATE = "t0 double, t1 double, f0 bigint, f1 bigint, n bigint, x double, y double, carried boolean, live boolean"


def online_sequences(frames: DataFrame, cfg: Config, watermark: str = "1 hour") -> DataFrame:
    """Closed segments of an allowed length from a stream with ``game_id, event_time, timestamp_s, frame_number, x, y, carried, live``.

    ``x`` and ``y`` are the ball's, null if there is none.  A segment closes when the next one
    begins, or when the watermark passes its last frame by the largest gap.
    """

    def accepted(game: str, s: tuple) -> list[tuple]:
        t0, t1, f0, f1, n = s[:5]
        return [(game, t0, t1, f0, f1, n)] if cfg.min_sequence_frames <= n <= cfg.max_sequence_frames else []

    def breaks(s: tuple, r) -> bool:
        x, y = s[5], s[6]
        lost = any(pd.isna(v) for v in (x, y, r.x, r.y))
        return (
            r.timestamp_s - s[1] > cfg.max_gap_s or lost or math.hypot(r.x - x, r.y - y) > 3 * cfg.possession_radius_m
            or bool(s[7]) != bool(r.carried) or bool(s[8]) != bool(r.live)
        )

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        s = state.get if state.exists else None
        if state.hasTimedOut:
            out += accepted(key[0], s) if s else []
            state.remove()
        else:
            rows = pd.concat(list(batches)).sort_values(["timestamp_s", "frame_number"])
            for r in rows.itertuples(index=False):
                if s is None or breaks(s, r):
                    out += accepted(key[0], s) if s else []
                    s = (r.timestamp_s, r.timestamp_s, r.frame_number, r.frame_number, 0)
                s = (s[0], r.timestamp_s, s[2], r.frame_number, s[4] + 1, r.x, r.y, bool(r.carried), bool(r.live))
            state.update(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in s))
            state.setTimeoutTimestamp(max(int((s[1] + cfg.max_gap_s) * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    keyed = frames.withWatermark("event_time", watermark).groupBy("game_id")
    return keyed.applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def event_rates(frames: DataFrame, window: str = "5 minutes", slide: str | None = None, watermark: str = "10 minutes") -> DataFrame:
    """Frames and games in event-time windows; late frames are dropped after the watermark."""
    span = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    return frames.withWatermark("event_time", watermark).groupBy(span).agg(F.count("*").alias("frames"), F.approx_count_distinct("game_id").alias("games"))
