"""Automatic cleaning.  Every pass is one window over the game, so a chain of them shares one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from .frames import EPSILON, game, count_present

TEAMS = ("target_team", "opponent_team")


def drop_duplicate_timestamps(frames: DataFrame) -> DataFrame:
    step = F.abs(F.col("timestamp_s") - F.lag("timestamp_s").over(game()))
    return frames.withColumn("_d", step).where("_d is null or _d > %r" % EPSILON).drop("_d")


def null_low_visibility(frames: DataFrame, cfg: Config) -> DataFrame:
    """Null robots under the least visibility; flags stay as they were counted."""
    seen = lambda r: F.when(r["visibility"] >= cfg.clean.min_visibility, r)
    return frames.withColumns({c: F.transform(c, seen) for c in TEAMS})


def null_low_ball_visibility(frames: DataFrame, cfg: Config) -> DataFrame:
    return frames.withColumn("ball", F.when(F.col("ball.visibility") >= cfg.clean.min_ball_visibility, F.col("ball")))


def complete_teams(frames: DataFrame, cfg: Config) -> DataFrame:
    """Frames with enough robots on both sides."""
    return frames.where(
        (count_present(F.col("target_team")) >= cfg.clean.min_target_robots) & (count_present(F.col("opponent_team")) >= cfg.clean.min_opponent_robots)
    )


def _square(a: Column, b: Column) -> Column:
    dx, dy = a["x"] - b["x"], a["y"] - b["y"]
    return dx * dx + dy * dy


def teleported(cfg: Config) -> Column:
    """Whether a robot with the same identity, or the ball, is too far from where the last row had it."""
    dt = F.col("timestamp_s") - F.lag("timestamp_s").over(game())
    reach = cfg.clean.teleport_m * F.greatest(dt / 0.033, F.lit(1.0))

    def jumped(c: str) -> Column:
        both = F.zip_with(F.lag(c).over(game()), F.col(c), lambda p, r: (p["stable_id"] == r["stable_id"]) & (F.sqrt(_square(r, p)) > reach))
        return F.exists(both, lambda x: F.coalesce(x, F.lit(False)))

    ball = F.sqrt(_square(F.col("ball"), F.lag("ball").over(game()))) > 2 * reach
    return F.coalesce(dt > 0, F.lit(False)) & (F.coalesce(jumped("target_team"), F.lit(False)) | F.coalesce(jumped("opponent_team"), F.lit(False)) | F.coalesce(ball, F.lit(False)))


def drop_teleports(frames: DataFrame, cfg: Config) -> DataFrame:
    """Rows are compared with their neighbour in the input, also if that one is dropped."""
    return frames.withColumn("_jump", teleported(cfg)).where(~F.col("_jump")).drop("_jump")


def spiked(cfg: Config) -> Column:
    """Whether a robot is off the line between its places one row before and after."""
    before, after = F.lag("timestamp_s").over(game()), F.lead("timestamp_s").over(game())
    d1, d2 = F.col("timestamp_s") - before, after - F.col("timestamp_s")
    share, most = d1 / (d1 + d2), cfg.clean.spike_m**2

    def off(c: str) -> Column:
        prev, nxt = F.lag(c).over(game()), F.lead(c).over(game())

        def one(r: Column, i: Column) -> Column:
            p, n = F.get(prev, i), F.get(nxt, i)
            dx, dy = r["x"] - (p["x"] + share * (n["x"] - p["x"])), r["y"] - (p["y"] + share * (n["y"] - p["y"]))
            return (p["stable_id"] == r["stable_id"]) & (r["stable_id"] == n["stable_id"]) & (dx * dx + dy * dy > most)

        return F.exists(F.transform(F.col(c), one), lambda x: F.coalesce(x, F.lit(False)))

    inside = F.coalesce((d1 > 0) & (d2 > 0), F.lit(False))
    return inside & (F.coalesce(off("target_team"), F.lit(False)) | F.coalesce(off("opponent_team"), F.lit(False)))


def drop_spikes(frames: DataFrame, cfg: Config) -> DataFrame:
    return frames.withColumn("_spike", spiked(cfg)).where(~F.col("_spike")).drop("_spike")


def smooth_positions(frames: DataFrame, cfg: Config) -> DataFrame:
    """Median of x and y over the rows around, per slot and for the ball; edges and sparse slots stay."""
    half = cfg.clean.smoothing_window // 2
    steps = [k for k in range(-half, half + 1) if k]
    beside = {f"_{c}_{k}": F.lag(c, -k).over(game()) for c in (*TEAMS, "ball") for k in steps}
    middle = F.lag(F.lit(True), half).over(game()).isNotNull() & F.lead(F.lit(True), half).over(game()).isNotNull() if half else F.lit(True)

    def smooth(around: list[Column], e: Column) -> Column:
        def median(f: str) -> Column:
            known = F.array_sort(F.array_compact(F.array(*[r[f] for r in around])))
            n = F.size(known)
            return (F.get(known, F.floor((n - 1) / 2).cast("int")) + F.get(known, F.floor(n / 2).cast("int"))) / 2

        seen = F.size(F.array_compact(F.array(*[r["x"] for r in around])))
        return F.when(F.col("_middle") & e.isNotNull() & (seen >= 3), e.withField("x", median("x")).withField("y", median("y"))).otherwise(e)

    held = frames.withColumns(beside | {"_middle": middle})
    near = lambda c: [F.col(c), *[F.col(f"_{c}_{k}") for k in steps]]
    slots = F.sequence(F.lit(0), F.lit(cfg.team_size - 1))
    team = lambda c: F.transform(slots, lambda i: smooth([F.get(t, i) for t in near(c)], F.get(c, i)))
    teams = {c: team(c) for c in TEAMS}
    return held.withColumns(teams | {"ball": smooth(near("ball"), F.col("ball"))}).select(*frames.columns)
