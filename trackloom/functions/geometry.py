"""Geometry and small numeric functions on columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PI = math.pi


def wrap_angle(a: Column) -> Column:
    """Into [-pi, pi] by whole turns; both ends stay as they are; null for NaN and infinities."""
    turn = 2 * PI
    finite = ~F.isnan(a) & (F.abs(a) != float("inf"))
    wrapped = F.when(a > PI, a - turn * F.ceil((a - PI) / turn)).when(a < -PI, a + turn * F.ceil((-PI - a) / turn)).otherwise(a)
    return F.when(finite, wrapped)


def clamp(x: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), x))


def distance(a: Column, b: Column) -> Column:
    dx, dy = a["x"] - b["x"], a["y"] - b["y"]
    return F.sqrt(dx * dx + dy * dy)


def in_bounds(e: Column, half_length: float, half_width: float, margin: float) -> Column:
    return (F.abs(e["x"]) <= half_length + margin) & (F.abs(e["y"]) <= half_width + margin)


def as_number(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False)).cast("double")


def one_hot_phase(phase: Column) -> Column:
    from ..schemas import PHASES

    return F.array(*[(phase == p).cast("double") for p in PHASES])


def role_code(role: Column) -> Column:
    """Goalkeeper 0, Defender 0.25, Midfielder 0.5, Forward 0.75, else 1."""
    return (
        F.when(role == "Goalkeeper", 0.0).when(role == "Defender", 0.25).when(role == "Midfielder", 0.5).when(role == "Forward", 0.75).otherwise(1.0)
    )
