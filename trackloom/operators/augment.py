"""Augmentation of samples by sign masks, index permutations and hashed noise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config

#: Fixed layout of a step: where the blocks begin, and which of their entries change sign.
POSE_AT, BALL_AT, ROBOTS_AT, ROBOT_WIDTH = 0, 8, 29, 14
FLIPS = {
    "x": {"pose": (0, 2, 4, 7), "ball": (0, 2, 4, 7), "robot": (0, 2, 4, 7, 9)},
    "y": {"pose": (1, 3, 5, 6), "ball": (1, 3, 5, 7), "robot": (1, 3, 5, 6, 9)},
}


def flipped_entries(axis: str, team_size: int) -> list[int]:
    """Entries of one step that a mirror negates."""
    f = FLIPS[axis]
    out = [POSE_AT + k for k in f["pose"]] + [BALL_AT + k for k in f["ball"]]
    for r in range(2 * team_size - 1):
        out += [ROBOTS_AT + r * ROBOT_WIDTH + k for k in f["robot"]]
    return out


def mirror_input(values: Column, axis: str, team_size: int) -> Column:
    """Negate a window's mirrored entries; zeros stay positive."""
    step = ROBOTS_AT + (2 * team_size - 1) * ROBOT_WIDTH
    mask = F.array(*[F.lit(-1.0 if k in set(flipped_entries(axis, team_size)) else 1.0).cast("float") for k in range(step)])
    return F.transform(values, lambda v, i: v * F.get(mask, i % step) + F.lit(0.0).cast("float"))


def mirror_target(target: Column, axis: str) -> Column:
    signs = F.array(*[F.lit(s).cast("float") for s in ((-1.0, 1.0, -1.0) if axis == "x" else (1.0, -1.0, -1.0))])
    return F.transform(target, lambda v, i: v * F.get(signs, i) + F.lit(0.0).cast("float"))


def mirror_grid(grid: Column, width: int, height: int, x: bool = False, y: bool = False) -> Column:
    """Reverse columns (``x``) and rows (``y``) of each plane."""

    def source(i: Column) -> Column:
        plane, rest = F.floor(i / (width * height)), i % (width * height)
        row, col = F.floor(rest / width), rest % width
        row = height - 1 - row if y else row
        col = width - 1 - col if x else col
        return (plane * width * height + row * width + col).cast("int")

    return F.transform(grid, lambda _, i: F.get(grid, source(i)))


def gaussian(seed: int, *key: Column) -> Column:
    """A standard normal variate hashed from a key."""
    u = lambda k: (F.shiftrightunsigned(F.xxhash64(*key, F.lit(seed), F.lit(k)), 12).cast("double") + 0.5) / float(1 << 52)
    return F.sqrt(-2 * F.ln(u(0))) * F.cos(u(1) * 6.283185307179586)


def augment(samples: DataFrame, cfg: Config) -> DataFrame:
    """Add ``variant``: the base row, mirrors and a noisy copy, as the configuration asks."""
    a, n = cfg.augment, cfg.team_size
    keys = [F.col(c) for c in ("game_id", "sequence_index", "stretch_index", "window_index", "ego_slot")]
    out = [samples.withColumn("variant", F.lit("base"))]
    for axis, wanted in (("y", a.mirror_y), ("x", a.mirror_x)):
        if wanted:
            made = {"input": mirror_input(F.col("input"), axis, n), "target": mirror_target(F.col("target"), axis), "variant": F.lit(f"mirror_{axis}")}
            if "grid" in samples.columns:
                made["grid"] = mirror_grid(F.col("grid"), cfg.grid_width, cfg.grid_height, x=axis == "x", y=axis == "y")
            out.append(samples.withColumns(made))
    if a.noise_m > 0:
        sigma = a.noise_m / cfg.half_length_m
        noisy = F.transform("input", lambda v, i: (v + sigma * gaussian(a.seed, *keys, i)).cast("float"))
        out.append(samples.withColumns({"input": noisy, "variant": F.lit("noise")}))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole if a.noise_m <= 0 or cfg.augment_all_splits or "split" not in samples.columns else whole.where("variant = 'base' or split = 'train'")
