"""Resampling to a uniform clock."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scans
from .frames import game


def resample(frames: DataFrame) -> DataFrame:
    """Each tick of a uniform clock takes the last frame strictly before it (the first frame if none).

    The step is the mean of the positive steps, and ticks are summed up one by one from the
    first time, so that rounding matches a running clock.  Games of under three frames, without
    a positive step, or whose steps differ by at most a quarter of their mean stay as they are.
    Frames keep their times; ``frame_pos`` is the tick.  Frames are read once and shuffled by game.
    """
    upto, whole = game().rowsBetween(Window.unboundedPreceding, 0), game().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up = F.when(F.col("_d") > 0, F.col("_d"))
    step = frames.withColumn("_d", F.col("timestamp_s") - F.lag("timestamp_s").over(game())).withColumn("_up", up)
    facts = step.withColumn("_run", F.sum("_up").over(upto)).withColumns(
        {
            "_n": F.count("*").over(whole), "_mean": F.last("_run").over(whole) / F.count("_up").over(whole), "_spread": F.max("_up").over(whole) - F.min("_up").over(whole),
            "_t0": F.first("timestamp_s").over(whole), "_t1": F.last("timestamp_s").over(whole), "_first": F.first("frame_pos").over(whole),
        }
    )
    uneven = F.coalesce((F.col("_n") >= 3) & (F.col("_mean") > 0) & (F.col("_spread") > 0.25 * F.col("_mean")), F.lit(False))
    # Frame rows have tick -1; a game's first row also brings the ticks of its clock.
    most = F.when(uneven & (F.col("frame_pos") == F.col("_first")), F.ceil((F.col("_t1") - F.col("_t0")) / F.col("_mean")).cast("int") + 2).otherwise(-1)
    # Of the ticks, only the first can have no frame before it: the others leave the frame that brought them behind.
    body = F.when(F.col("_k") <= 0, F.struct(*frames.columns))
    rows = facts.withColumns({"_uneven": uneven, "_k": F.explode(F.sequence(F.lit(-1), most))}).select("game_id", "_mean", "_t0", "_t1", "_uneven", "_k", body.alias("_f"))
    tick = F.col("_k") >= 0
    clock = F.sum(F.when(F.col("_k") == 0, F.col("_t0")).otherwise(F.col("_mean"))).over(
        Window.partitionBy("game_id", tick).orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    )
    timed = rows.withColumn("_t", F.when(tick, clock).otherwise(F.col("_f.timestamp_s"))).where(~tick | (F.col("_t") <= F.col("_t1")))
    order = Window.partitionBy("game_id").orderBy("_t", F.when(tick, 0).otherwise(1), "_f.frame_pos", "_k").rowsBetween(Window.unboundedPreceding, 0)
    held = F.coalesce(F.last(F.when(~tick, F.col("_f")), ignorenulls=True).over(order), F.col("_f"))
    picked = timed.withColumn("_f", F.when(tick, held).otherwise(F.col("_f"))).where(tick | ~F.col("_uneven"))
    return picked.select(*[F.when(tick, F.col("_k").cast("bigint")).otherwise(F.col("_f.frame_pos")).alias(c) if c == "frame_pos" else F.col(f"_f.{c}").alias(c) for c in frames.columns])


def _clocks(frames: DataFrame) -> DataFrame:
    """``game_id, mean, t0, t1, p0, uneven``: the step as a running sum, like the clock's; three numbers of a frame are read."""
    upto = game().rowsBetween(Window.unboundedPreceding, 0)
    narrow = frames.select("game_id", "frame_pos", "timestamp_s").withColumn("_d", F.col("timestamp_s") - F.lag("timestamp_s").over(game()))
    steps = narrow.withColumn("_up", F.when(F.col("_d") > 0, F.col("_d"))).withColumn("_run", F.sum("_up").over(upto))
    facts = steps.groupBy("game_id").agg(
        F.count("*").alias("_n"), (F.max_by("_run", "frame_pos") / F.count("_up")).alias("mean"), (F.max("_up") - F.min("_up")).alias("_spread"),
        F.min_by("timestamp_s", "frame_pos").alias("t0"), F.max_by("timestamp_s", "frame_pos").alias("t1"), F.min("frame_pos").alias("p0"),
    )
    uneven = F.coalesce((F.col("_n") >= 3) & (F.col("mean") > 0) & (F.col("_spread") > 0.25 * F.col("mean")), F.lit(False))
    return facts.withColumn("uneven", uneven).drop("_n", "_spread")


def _ticks(clocks: DataFrame, rows: int = 8192) -> DataFrame:
    """``game_id, k, t``: each clock summed up tick by tick, a batch at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                k, t = 0, r["t0"]
                while t <= r["t1"]:
                    times = np.cumsum(np.concatenate([[t], np.full(rows - 1, r["mean"])]))
                    inside = times[: int(np.searchsorted(times, r["t1"], "right"))]
                    names = pa.array([r["game_id"]] * len(inside), pa.string())
                    yield pa.RecordBatch.from_arrays([names, pa.array(np.arange(k, k + len(inside))), pa.array(inside)], names=["game_id", "k", "t"])
                    k, t = k + rows, float(times[-1] + r["mean"])

    return clocks.where("uneven").select("game_id", "t0", "t1", "mean").mapInArrow(work, "game_id string, k long, t double")


def resample_split(frames: DataFrame, piece_s: float) -> DataFrame:
    """``resample`` for long games: frames and ticks are shared out by time, in pieces of ``piece_s`` seconds.

    A tick takes the last frame before it from its own piece, or what the pieces before end with.
    """
    clocks = _clocks(frames)
    known = scans.given(frames, clocks.select("game_id", "p0", F.col("uneven").alias("_uneven")), scans.of_time(piece_s))
    body = F.struct(*frames.columns)
    # A game's first frame stands before the tick at its time, every other frame after.
    place = F.when(F.col("frame_pos") == F.col("p0"), 0).otherwise(2)
    held = known.where("_uneven").select("game_id", F.col("timestamp_s").alias("_t"), place.alias("_place"), F.col("frame_pos").alias("_n"), body.alias("_f"))
    ticks = _ticks(clocks).select("game_id", F.col("t").alias("_t"), F.lit(1).alias("_place"), F.col("k").alias("_n"), F.lit(None).cast(held.schema["_f"].dataType).alias("_f"))
    order = ["_t", "_place", "_n"]
    timed = scans.last_before(held.union(ticks), F.col("_f"), order, scans.of_time(piece_s, "_t"), "_last", F.struct(*order), strict=False)
    picked = timed.where("_place = 1").select(*[(F.col("_n") if c == "frame_pos" else F.col(f"_last.{c}")).alias(c) for c in frames.columns])
    return known.where("not _uneven").select(*frames.columns).union(picked)
