"""Per-game audits and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dynamics import sample_rate
from .ingest import drop_consecutive_duplicates


def message_audit(raw: DataFrame) -> DataFrame:
    """``game_id, tracker_frames_seen, duplicate_frames, distinct_tracker_sources, tracker_source`` from messages.

    The usual source is the most frequent one; on a tie the last by name.
    """
    flagged = drop_consecutive_duplicates(raw, keep_flag=True).withColumn("source", F.coalesce("source_name", F.lit("unknown")))
    by_source = flagged.groupBy("game_id", "source").agg(
        F.count("*").alias("seen"), F.count_if("is_repeat").alias("repeats"), F.count_if(~F.col("is_repeat")).alias("used")
    )
    return by_source.groupBy("game_id").agg(
        F.sum("seen").alias("tracker_frames_seen"), F.sum("repeats").alias("duplicate_frames"),
        F.array_sort(F.collect_set("source")).alias("distinct_tracker_sources"), F.max_by("source", F.struct("used", "source")).alias("tracker_source"),
    )


def frame_audit(frames: DataFrame) -> DataFrame:
    f = F.col("flags")
    counts = frames.groupBy("game_id").agg(
        F.count("*").alias("tracker_frames_used"), F.sum(f["out_of_bounds_objects"]).alias("out_of_bounds_objects"),
        F.count_if(F.col("ball").isNull()).alias("missing_ball_frames"), F.count_if(f["likely_identity_swap"]).alias("suspicious_identity_swaps"),
        (F.max("timestamp_s") - F.min("timestamp_s")).alias("duration_s"),
    )
    return counts.join(sample_rate(frames), "game_id")


def with_notes(audits: DataFrame) -> DataFrame:
    """Add ``notes``: what was dropped, missing or doubtful."""
    note = lambda c, *parts: F.when(F.col(c) > 0, F.concat(*parts))
    count = lambda c: F.col(c).cast("string")
    return audits.withColumn(
        "notes",
        F.array_compact(
            F.array(
                note("duplicate_frames", F.lit("dropped "), count("duplicate_frames"), F.lit(" duplicate tracker frames")),
                note("missing_ball_frames", count("missing_ball_frames"), F.lit(" frames missing a primary ball")),
                note("suspicious_identity_swaps", F.lit("flagged "), count("suspicious_identity_swaps"), F.lit(" likely identity swaps")),
            )
        ),
    )


def metadata(games: DataFrame) -> DataFrame:
    """Names and scores of the target and opponent team; a blank name gives way to the colour."""
    yellow = F.col("target_color") == "Yellow"
    r = F.col("referee")
    name = lambda n, color: F.coalesce(F.nullif(n, F.lit("")), F.lit(color))
    y, b = name(r["yellow_name"], "Yellow"), name(r["blue_name"], "Blue")
    return games.withColumns(
        {
            "target_team": F.when(yellow, y).otherwise(b), "opponent_team": F.when(yellow, b).otherwise(y),
            "target_score": F.coalesce(F.when(yellow, r["yellow_score"]).otherwise(r["blue_score"]), F.lit(0)),
            "opponent_score": F.coalesce(F.when(yellow, r["blue_score"]).otherwise(r["yellow_score"]), F.lit(0)),
        }
    )
