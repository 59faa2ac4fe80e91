"""The standard and the automatic pipeline, from frames to samples."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import audit, augment, clean, frames as fr, resample, samples, sequences, splits
from ..operators.dynamics import estimate_dynamics
from ..operators.ingest import drop_consecutive_duplicates, frames_from_tracker, game_id_from_path, last_referee, order_frames, resolve_target_color, source_filter, year_from_name
from ..operators.scans import in_pieces, step_in_pieces
from ..operators.tracking import track
from ..scratch import written
from ..sources import logs


@dataclass
class Output:
    frames: DataFrame
    sequences: DataFrame
    samples: DataFrame
    splits: DataFrame
    stats: DataFrame
    games: DataFrame


#: What a sample says about its game.
GAME_FACTS = ("source_log", "target_team", "opponent_team", "target_color", "target_score", "opponent_score")


def games_from_logs(packets: DataFrame, referee_messages: DataFrame, cfg: Config) -> DataFrame:
    """One row for each game with tracker packets: log, last referee state, phase, target colour.

    A log without referee messages has no referee state.  The colour is null where no team has the name.
    """
    seen = packets.groupBy("game_id").agg(F.min("path").alias("source_log"))
    games = seen.join(last_referee(referee_messages), "game_id", "left").withColumn("phase", F.coalesce("phase", F.lit("Unknown")))
    return resolve_target_color(games, cfg.target_name, cfg.target_color)


def problems(log: DataFrame, cfg: Config) -> DataFrame:
    """``path, error`` of the logs that give no game: unreadable ones, those without tracker frames, and those without the target team."""
    frame = F.col("kind").eqNullSafe("tracker") & (F.col("robots").isNotNull() | F.col("balls").isNotNull())
    by_log = log.groupBy("path").agg(F.min("error").alias("broken"), F.count_if(frame).alias("n"))
    games = games_from_logs(logs.packets(log), logs.referee_messages(log), cfg).select(F.col("source_log").alias("path"), "target_color", "referee")
    teams = F.concat(F.lit("no team has the name "), F.lit(str(cfg.target_name)), F.lit(" (yellow "), F.coalesce("referee.yellow_name", F.lit("unknown")), F.lit(", blue "), F.coalesce("referee.blue_name", F.lit("unknown")), F.lit(")"))
    why = F.when(F.col("broken").isNotNull(), F.col("broken")).when(F.col("n") == 0, "no tracker frames").when(F.col("target_color").isNull(), teams)
    return by_log.join(games, "path", "left").select("path", why.alias("error")).where("error is not null")


def moving_frames(tracked: DataFrame, games: DataFrame, cfg: Config, piece_rows: int | None = None) -> DataFrame:
    """Clean frames with dynamics of tracked ones; with ``piece_rows``, tasks share a game in pieces of so many frames."""
    teams = fr.with_targets(tracked, games)
    if piece_rows is None:
        return estimate_dynamics(fr.flagged(teams, cfg), cfg)
    return in_pieces(teams, piece_rows, max(2, fr.reach(cfg)), 1, lambda piece: estimate_dynamics(fr.flagged(piece, cfg), cfg))


def frames_from_logs(packets: DataFrame, referee_messages: DataFrame, cfg: Config, piece_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean frames with dynamics, and one row for each game; games without the target team have none (see ``problems``)."""
    raw = drop_consecutive_duplicates(source_filter(frames_from_tracker(packets), cfg.tracker_source))
    games = games_from_logs(packets, referee_messages, cfg).where("target_color is not null")
    tracked = track(order_frames(raw), cfg)
    return moving_frames(tracked, games, cfg, piece_rows), games


def standard_frames(frames: DataFrame, cfg: Config, piece_s: float | None = None) -> DataFrame:
    """Resampled frames in live play, towards positive x; with ``piece_s``, tasks share a game's time in pieces of so many seconds."""
    even = resample.resample(frames) if piece_s is None else resample.resample_split(frames, piece_s)
    return fr.canonicalise(fr.live_only(even, cfg))


def automatic_frames(frames: DataFrame, cfg: Config, piece_s: float | None = None, piece_rows: int | None = None) -> DataFrame:
    """The standard frames, cleaned; with ``piece_s`` and ``piece_rows``, tasks share a game in every step."""

    def step(f: DataFrame, before: int, after: int, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return operator(f) if piece_rows is None else step_in_pieces(f, piece_rows, before, after, operator)

    out = standard_frames(frames, cfg, piece_s)
    if cfg.clean.drop_duplicate_timestamps:
        out = step(out, 1, 0, clean.drop_duplicate_timestamps)
    out = clean.complete_teams(clean.null_low_visibility(out, cfg), cfg)
    out = step(out, 1, 0, lambda f: clean.drop_teleports(f, cfg))
    out = step(out, 1, 1, lambda f: clean.drop_spikes(f, cfg))
    if cfg.clean.smooth:
        half = cfg.clean.smoothing_window // 2
        out = step(out, half, half, lambda f: clean.smooth_positions(f, cfg))
    return clean.null_low_ball_visibility(fr.canonicalise(out), cfg)


def build(
    frames: DataFrame, games: DataFrame, cfg: Config, reviews: DataFrame | None = None, automatic: bool = False, piece_s: float | None = None, piece_rows: int | None = None
) -> Output:
    """Sequences, samples, splits and train statistics of prepared frames.

    The automatic pipeline has a quality gate and no reviews.  With ``piece_s`` and ``piece_rows``,
    tasks share a game in pieces of so many seconds and frames; the result is the same.
    """
    ready = automatic_frames(frames, cfg, piece_s, piece_rows) if automatic else standard_frames(frames, cfg, piece_s)
    # Read twice below, and again for grids: segments come from a table of their own.
    segmented = written(sequences.segment(ready, cfg, piece_rows), "segments")
    found = sequences.summarise(segmented, cfg)
    if automatic:
        found = sequences.quality_gate(found, cfg.clean.min_quality)
    elif reviews is not None:
        found = sequences.apply_reviews(found, reviews, cfg.drop_cascades)
    split = splits.assign_splits(games, cfg)
    played = sequences.frames_of(segmented, found).join(split.select("game_id", "phase"), "game_id")
    stretched = samples.stretch(played, cfg)
    made = samples.windows(stretched, cfg)
    if cfg.augment.occupancy_grid:
        made = made.join(samples.occupancy(stretched, cfg), ["game_id", "sequence_index", "stretch_index", "window_index"], "left")
    named = audit.metadata(games if "source_log" in games.columns else games.withColumn("source_log", F.col("game_id")))
    made = splits.with_split(made, split, cfg).join(named.select("game_id", *GAME_FACTS), "game_id")
    made = augment.augment(made, cfg)
    stats = splits.pooled_stats(made.where("split = 'train'"), splits.magnitudes_of_inputs(F.col("input")), cfg.pooled_stats)
    return Output(ready, found, made, split, stats, named)


def game_table(log: DataFrame, cfg: Config, built: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row of metadata for each game of decoded logs; ``built`` has their frames and games if they are there already."""
    packets = logs.packets(log)
    frames, games = built or frames_from_logs(packets, logs.referee_messages(log), cfg)
    raw = source_filter(frames_from_tracker(packets), cfg.tracker_source)
    rows = audit.metadata(games).withColumn("year", year_from_name(F.element_at(F.split("source_log", "/"), -1)))
    rows = rows.join(audit.frame_audit(frames), "game_id").join(audit.message_audit(raw), "game_id")
    return rows.select("game_id", "source_log", "year", "phase", *GAME_FACTS[1:], "sample_rate_hz", "duration_s", "tracker_source")


def live_samples(spark: SparkSession, paths: list[str], cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Samples straight from logs, all for training, in the archive's schema; and the logs that give no game, with why."""
    log = logs.read_logs(spark, *paths, mode="permissive")
    frames, games = frames_from_logs(logs.packets(log), logs.referee_messages(log), cfg)
    samples_of = build(frames, games, cfg).samples.withColumn("split", F.lit("train"))
    return samples_of, problems(log, cfg)


def audits(log: DataFrame, cfg: Config) -> DataFrame:
    """One audit row with notes for each game of decoded logs."""
    packets = logs.packets(log)
    frames, games = frames_from_logs(packets, logs.referee_messages(log), cfg)
    raw = source_filter(frames_from_tracker(packets), cfg.tracker_source)
    named = audit.metadata(games).select("game_id", F.col("target_team").alias("target_team_resolved"))
    messages = log.groupBy(game_id_from_path(F.col("path")).alias("game_id")).agg(F.count("*").alias("total_messages"))
    return audit.with_notes(audit.message_audit(raw).join(audit.frame_audit(frames), "game_id").join(messages, "game_id").join(named, "game_id"))
