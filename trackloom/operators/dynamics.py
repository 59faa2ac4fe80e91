"""Velocities and accelerations from positions, and the rate of frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.geometry import clamp
from .frames import game


def _velocity(cur: Column, prev: Column, nxt: Column, dt: Column, cfg: Config, robot: bool) -> Column:
    known = (dt > 0) & cur.isNotNull() & prev.isNotNull() & nxt.isNotNull()
    speed = lambda f: clamp((nxt[f] - prev[f]) / dt, -cfg.max_speed, cfg.max_speed)
    out = cur.withField("vx", speed("x")).withField("vy", speed("y"))
    if robot:
        turn = cfg.max_angular_speed
        out = out.withField("omega", clamp((nxt["theta"] - prev["theta"]) / dt, -turn, turn))
    return F.when(known, out).otherwise(cur)


def _acceleration(cur: Column, prev: Column, nxt: Column, dt: Column, cfg: Config) -> Column:
    known = (dt > 0) & cur.isNotNull() & prev.isNotNull() & nxt.isNotNull()
    a = lambda f: clamp((cur[f] - prev[f]) / (dt / 2), -cfg.max_acceleration, cfg.max_acceleration)
    return F.when(known, cur.withField("ax", a("vx")).withField("ay", a("vy"))).otherwise(cur)


def estimate_dynamics(frames: DataFrame, cfg: Config) -> DataFrame:
    """Central differences at interior frames, per slot.

    Acceleration compares a frame's new velocity with the new velocity of the frame before it.
    The first and last frame, frames without both neighbours and times that don't advance keep
    what the tracker said.  Two passes over one window; one shuffle.
    """
    teams = ("target_team", "opponent_team")
    around = {"_dt": F.lead("timestamp_s").over(game()) - F.lag("timestamp_s").over(game())}
    for c in ("ball", *teams):
        around |= {f"_p_{c}": F.lag(c).over(game()), f"_n_{c}": F.lead(c).over(game())}
    wide = frames.withColumns(around)
    dt = F.col("_dt")

    def per_slot(c: str, f) -> Column:
        return F.transform(F.col(c), lambda r, i: f(r, F.get(f"_p_{c}", i), F.get(f"_n_{c}", i)))

    first = {"ball": _velocity(F.col("ball"), F.col("_p_ball"), F.col("_n_ball"), dt, cfg, False)}
    first |= {c: per_slot(c, lambda r, p, n: _velocity(r, p, n, dt, cfg, True)) for c in teams}
    moved = wide.withColumns(first)
    moved = moved.withColumns({f"_p_{c}": F.lag(c).over(game()) for c in ("ball", *teams)})
    second = {"ball": _acceleration(F.col("ball"), F.col("_p_ball"), F.col("_n_ball"), dt, cfg)}
    second |= {c: per_slot(c, lambda r, p, n: _acceleration(r, p, n, dt, cfg)) for c in teams}
    return moved.withColumns(second).select(*frames.columns)


def sample_rate(frames: DataFrame) -> DataFrame:
    """``game_id, sample_rate_hz``: one over the mean of positive steps in time; 0 without any."""
    step = F.col("timestamp_s") - F.lag("timestamp_s").over(game())
    steps = frames.select("game_id", step.alias("d"))
    return steps.groupBy("game_id").agg(F.coalesce(1 / F.avg(F.when(F.col("d") > 0, F.col("d"))), F.lit(0.0)).alias("sample_rate_hz"))
