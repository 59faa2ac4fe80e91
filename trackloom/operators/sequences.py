"""Play sequences: where they break, what they are and how good they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.geometry import distance
from . import scans
from .frames import game


def possession_break(cfg: Config, prev: Callable[[str], Column]) -> Column:
    """Against the row before: a missing ball, a jump of the ball, or a change of carrying or live play."""
    ball, last = F.col("ball"), prev("ball")
    return (
        ball.isNull()
        | last.isNull()
        | F.coalesce(distance(ball, last) > 3 * cfg.possession_radius_m, F.lit(False))
        | (F.col("flags.carried_ball") != prev("flags")["carried_ball"])
        | (F.col("live") != prev("live"))
    )


def segment(frames: DataFrame, cfg: Config, piece_rows: int | None = None) -> DataFrame:
    """Add ``segment``: it grows by one wherever a gap in time or a possession break is.

    With ``piece_rows``, a game's frames are shared out by ``frame_pos`` in pieces of at most so many.
    """
    prev = (lambda c: F.lag(c).over(game())) if piece_rows is None else (lambda c: F.col("_before")[c])
    gap = F.col("timestamp_s") - prev("timestamp_s") > cfg.max_gap_s
    starts = (prev("frame_pos").isNull() | gap | possession_break(cfg, prev)).cast("int")
    if piece_rows is None:
        return frames.withColumn("_s", starts).withColumn("segment", F.sum("_s").over(game().rowsBetween(Window.unboundedPreceding, 0))).drop("_s")
    order, piece = ["frame_pos"], scans.of_position(piece_rows)
    body = F.struct("timestamp_s", "frame_pos", "ball", "flags", "live")
    known = scans.last_before(frames, body, order, piece, "_before", F.col("frame_pos"))
    return scans.running_sum(known.withColumn("_s", starts).drop("_before"), F.col("_s"), order, piece, "segment").drop("_s")


def summarise(segmented: DataFrame, cfg: Config) -> DataFrame:
    """One row for each segment of an allowed length, with its kind, score and warnings.

    ``sequence_index`` numbers a game's segments from 0.  Too long segments are left out, not cut.
    """
    share = lambda c: F.avg(c.cast("double"))
    f = F.col("flags")
    stats = segmented.groupBy("game_id", "segment").agg(
        F.count("*").alias("frame_count"),
        F.min("frame_pos").alias("first_pos"),
        F.max("frame_pos").alias("last_pos"),
        F.min_by("frame_number", "frame_pos").alias("start_frame"),
        F.max_by("frame_number", "frame_pos").alias("end_frame"),
        F.min_by("timestamp_s", "frame_pos").alias("start_time_s"),
        F.max_by("timestamp_s", "frame_pos").alias("end_time_s"),
        F.count_if(f["carried_ball"]).alias("carried"),
        F.count_if(f["likely_identity_swap"]).alias("swaps"),
        share(F.col("ball").isNull()).alias("no_ball"),
        share(f["duplicate_timestamp"]).alias("duplicates"),
        F.avg(f["missing_target_robot_slots"] / F.size("target_team")).alias("no_robots"),
        share(F.col("live")).alias("live_share"),
    )
    fit = stats.where(F.col("frame_count").between(cfg.min_sequence_frames, cfg.max_sequence_frames))
    kind = F.when(F.col("swaps") > 0, "Transition").when(F.col("carried") > F.floor(F.col("frame_count") / 3), "OpenPlay").otherwise("Unknown")
    swap_share = F.col("swaps") / F.col("frame_count")
    score = (
        F.lit(0.45) + (1 - F.col("no_ball")) * 0.20 + (1 - F.col("duplicates")) * 0.10 + (1 - F.col("no_robots")) * 0.15
        + (1 - swap_share) * 0.20 + F.col("live_share") * 0.10 + F.when(F.col("sequence_kind") == "OpenPlay", 0.05).otherwise(0.0)
    )
    warn = lambda c, text: F.when(c, text)
    warnings = F.array_compact(
        F.array(
            warn(F.col("no_ball") > 0.1, "ball-missing"),
            warn(F.col("duplicates") > 0.03, "duplicate-timestamps"),
            warn(F.col("no_robots") > 0.10, "missing-robots"),
            warn(swap_share > 0, "identity-instability"),
            warn(F.col("live_share") < 0.8, "mixed-live-state"),
        )
    )
    index = F.row_number().over(Window.partitionBy("game_id").orderBy("first_pos")).cast("bigint") - 1
    return (
        fit.withColumn("sequence_kind", kind)
        .withColumns({"quality_score": F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), "warnings": warnings, "sequence_index": index})
        .drop("swaps", "no_ball", "duplicates", "no_robots", "live_share")
    )


def quality_gate(sequences: DataFrame, least: float) -> DataFrame:
    """Sequences that score at least ``least``, numbered again."""
    kept = sequences.where(F.col("quality_score") >= least)
    index = F.row_number().over(Window.partitionBy("game_id").orderBy("first_pos")).cast("bigint") - 1
    return kept.withColumn("sequence_index", index)


def apply_reviews(sequences: DataFrame, reviews: DataFrame, cascade: bool = True) -> DataFrame:
    """Drop and mark sequences by verdict.

    An index is not used up by a dropped sequence, so its verdict also meets every later
    sequence of the game: with ``cascade`` only those before the first ``Drop`` stay.  Without,
    just the named ones go, and indexes stay as they were reviewed.
    """
    verdicts = reviews.select("game_id", "sequence_index", "verdict")
    joined = sequences.join(verdicts, ["game_id", "sequence_index"], "left").withColumn("verdict", F.coalesce("verdict", F.lit("Unreviewed")))
    marked = joined.withColumn(
        "warnings", F.when(F.col("verdict") == "NeedsAttention", F.array_append("warnings", F.lit("manual-needs-attention"))).otherwise(F.col("warnings"))
    )
    if not cascade:
        return marked.where("verdict != 'Drop'")
    first = F.min(F.when(F.col("verdict") == "Drop", F.col("sequence_index"))).over(Window.partitionBy("game_id"))
    return marked.withColumn("_first", first).where("_first is null or sequence_index < _first").drop("_first")


def frames_of(segmented: DataFrame, sequences: DataFrame) -> DataFrame:
    """The frames of accepted sequences, with ``sequence_index``, kind, score, warnings and ``seq_pos`` from 0."""
    facts = sequences.select("game_id", "segment", "sequence_index", F.col("sequence_kind").alias("_kind"), "quality_score", "warnings", "first_pos", "frame_count")
    order = Window.partitionBy("game_id", "sequence_index").orderBy("frame_pos")
    joined = segmented.join(facts, ["game_id", "segment"])
    return joined.withColumns({"sequence_kind": F.col("_kind"), "seq_pos": F.row_number().over(order).cast("bigint") - 1}).drop("_kind")


def phase_counts(games: DataFrame) -> DataFrame:
    return games.groupBy(F.lower("phase").alias("phase")).agg(F.count("*").alias("games")).orderBy("phase")
