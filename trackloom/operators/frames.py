"""Clean frames: teams by target, bounds, possession, live play and direction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import Config
from ..functions.geometry import distance, in_bounds, wrap_angle

EPSILON = 2.220446049250313e-16


def game() -> WindowSpec:
    """The frames of a game in order."""
    return Window.partitionBy("game_id").orderBy("frame_pos")


def null_out_of_bounds(team: Column, cfg: Config) -> Column:
    return F.transform(team, lambda r: F.when(r.isNotNull() & in_bounds(r, cfg.half_length_m, cfg.half_width_m, cfg.margin_m), r))


def count_present(team: Column) -> Column:
    return F.size(F.filter(team, lambda r: r.isNotNull())).cast("bigint")


def apply_bounds(frames: DataFrame, cfg: Config) -> DataFrame:
    """Null robots and balls outside the field and its margin; add ``out_of_bounds_objects``."""
    inside = frames.withColumns(
        {
            "_t": null_out_of_bounds(F.col("target_team"), cfg),
            "_o": null_out_of_bounds(F.col("opponent_team"), cfg),
            "_b": F.when(in_bounds(F.col("ball"), cfg.half_length_m, cfg.half_width_m, cfg.margin_m), F.col("ball")),
        }
    )
    lost = lambda old, new: count_present(F.col(old)) - count_present(F.col(new))
    ball_lost = (F.col("ball").isNotNull() & F.col("_b").isNull()).cast("bigint")
    out = inside.withColumn("out_of_bounds_objects", lost("target_team", "_t") + lost("opponent_team", "_o") + ball_lost)
    return out.withColumns({"target_team": F.col("_t"), "opponent_team": F.col("_o"), "ball": F.col("_b")}).drop("_t", "_o", "_b")


def near_ball(cfg: Config) -> Column:
    """Whether some robot of either team is within the possession radius of the ball."""
    dist = F.array_min(F.transform(F.concat("target_team", "opponent_team"), lambda r: distance(r, F.col("ball"))))
    return F.coalesce(dist <= cfg.possession_radius_m, F.lit(False))


def run_length(frames: DataFrame, condition: Column, name: str) -> DataFrame:
    """How many frames in a row, up to each frame, the condition has held."""
    marked = frames.withColumn("_c", F.coalesce(condition, F.lit(False)))
    islands = marked.withColumn("_i", F.sum((~F.col("_c")).cast("int")).over(game()))
    run = F.sum(F.col("_c").cast("bigint")).over(Window.partitionBy("game_id", "_i").orderBy("frame_pos"))
    return islands.withColumn(name, run).drop("_c", "_i")


def duplicate_timestamp() -> Column:
    return F.coalesce(F.abs(F.col("timestamp_s") - F.lag("timestamp_s").over(game())) <= EPSILON, F.lit(False))


def referee_live(cfg: Config) -> Column:
    return F.coalesce(F.col("referee.command").isin(*cfg.live.commands), F.lit(False))


def motion_live(cfg: Config) -> Column:
    speed = lambda e: F.sqrt(e["vx"] * e["vx"] + e["vy"] * e["vy"])
    ball = F.coalesce(speed(F.col("ball")) >= cfg.live.ball_speed_m_s, F.lit(False))
    robots = F.exists(F.concat("target_team", "opponent_team"), lambda r: F.coalesce(speed(r) >= cfg.live.robot_speed_m_s, F.lit(False)))
    return ball | robots


def attacks_positive(color: Column) -> Column:
    side = F.col("referee.blue_team_on_positive_half")
    return F.coalesce(F.when(color == "Blue", ~side).when(color == "Yellow", side), F.lit(False))


def with_targets(tracked: DataFrame, games: DataFrame) -> DataFrame:
    """Teams by target and opponent, with the game's last referee state, which holds for all of its frames."""
    target = F.col("target_color")
    joined = tracked.join(games.select("game_id", "referee", "target_color"), "game_id")
    mine = lambda a, b: F.when(target == "Yellow", F.col(a)).otherwise(F.col(b))
    return joined.withColumns({"target_team": mine("yellow", "blue"), "opponent_team": mine("blue", "yellow")})


def clean_frames(tracked: DataFrame, games: DataFrame, cfg: Config) -> DataFrame:
    """Frames from tracked raw frames and one row of ``game_id, referee, target_color`` for each game."""
    return flagged(with_targets(tracked, games), cfg)


def reach(cfg: Config) -> int:
    """How many frames back the flags look."""
    return max(1, cfg.carried_ball_frames - 1)


def flagged(teams: DataFrame, cfg: Config) -> DataFrame:
    """Frames with bounds, flags, live play and direction, from teams by target."""
    bounded = apply_bounds(teams, cfg)
    carried = run_length(bounded, near_ball(cfg), "_run")
    flags = F.struct(
        duplicate_timestamp().alias("duplicate_timestamp"),
        (F.col("_run") >= cfg.carried_ball_frames).alias("carried_ball"),
        F.col("out_of_bounds_objects"),
        (F.size("target_team") - count_present(F.col("target_team"))).alias("missing_target_robot_slots"),
        (F.col("yellow_swap") | F.col("blue_swap")).alias("likely_identity_swap"),
        referee_live(cfg).alias("referee_live"),
        motion_live(cfg).alias("heuristic_live"),
    )
    return carried.withColumn("flags", flags).select(
        "game_id", "frame_pos", "timestamp_s", "frame_number", "ball", "target_team", "opponent_team", "referee",
        (F.col("flags.referee_live") | F.col("flags.heuristic_live")).alias("live"),
        attacks_positive(F.col("target_color")).alias("target_attacks_positive_x"), F.lit("Unknown").alias("sequence_kind"), "flags",
    )


def live_only(frames: DataFrame, cfg: Config) -> DataFrame:
    """Frames in live play, all inside the field, with some target robot."""
    f = F.col("flags")
    return frames.where(
        (f["out_of_bounds_objects"] == 0) & (f["missing_target_robot_slots"] < cfg.team_size) & (f["referee_live"] | f["heuristic_live"])
    )


def _flip_robot(r: Column) -> Column:
    turned = r.withField("x", -r["x"]).withField("vx", -r["vx"]).withField("ax", -r["ax"])
    return F.when(r.isNotNull(), turned.withField("theta", wrap_angle(F.lit(3.141592653589793) - r["theta"])).withField("omega", -r["omega"]))


def _flips() -> dict[str, Column]:
    b = F.col("ball")
    return {
        "ball": F.when(b.isNotNull(), b.withField("x", -b["x"]).withField("vx", -b["vx"]).withField("ax", -b["ax"])),
        "target_team": F.transform("target_team", _flip_robot),
        "opponent_team": F.transform("opponent_team", _flip_robot),
    }


def flip_x(frames: DataFrame) -> DataFrame:
    """Mirror positions, velocities and accelerations along x, and headings; slots and roles stay."""
    return frames.withColumns(_flips())


def canonicalise(frames: DataFrame) -> DataFrame:
    """Let the target team attack towards positive x in every frame."""
    keep = F.col("target_attacks_positive_x")
    out = frames.withColumns({c: F.when(keep, F.col(c)).otherwise(e) for c, e in _flips().items()})
    return out.withColumn("target_attacks_positive_x", F.lit(True))
