"""Splits of games, and normalisation statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from .scans import ranked


def assign_splits(games: DataFrame, cfg: Config) -> DataFrame:
    """``game_id, split, phase, sample_count`` by rank of the game id: the first share trains, the next validates.

    Ranges of ids are ranked by tasks.  ``sample_count`` is 0 until samples are counted.
    """
    s = cfg.split
    known, total = ranked(games.select("game_id", "phase"), ["game_id"], "_r")
    cut = F.round(F.lit(total) * s.train).cast("bigint")
    second = cut + F.round(F.lit(total) * s.validation).cast("bigint")
    split = F.when(F.col("_r") < cut, "train").when(F.col("_r") < second, "validation").otherwise("test")
    return known.select("game_id", split.alias("split"), "phase", F.lit(0).cast("bigint").alias("sample_count"))


def with_split(samples: DataFrame, splits: DataFrame, cfg: Config) -> DataFrame:
    """Give samples their game's split, and the weight of its phase."""
    known = splits.select("game_id", F.col("split").alias("split"), F.col("phase").alias("_phase"))
    weight = F.when(F.col("_phase") == "Elimination", cfg.split.elimination_weight).otherwise(1.0)
    return samples.drop("split").join(known, "game_id").withColumn("sample_weight", weight).drop("_phase")


def magnitudes_of_inputs(values: Column) -> Column:
    """Of each whole group of eight entries: the lengths of entries 2-3 and 4-5."""
    groups = F.sequence(F.lit(0), F.floor(F.size(values) / 8).cast("int") - 1)
    some = F.when(F.size(values) >= 8, groups).otherwise(F.array().cast("array<int>"))
    at = lambda k, j: F.get(values, (k * 8 + j).cast("int")).cast("double")
    length = lambda k, j: F.sqrt(at(k, j) * at(k, j) + at(k, j + 1) * at(k, j + 1))
    return F.flatten(F.transform(some, lambda k: F.array(length(k, 2), length(k, 4))))


def magnitudes_of_teams() -> Column:
    """Speeds and accelerations of all robots of a frame."""
    present = F.filter(F.concat("target_team", "opponent_team"), lambda r: r.isNotNull())
    size = lambda a, b: F.sqrt(a * a + b * b)
    return F.flatten(F.transform(present, lambda r: F.array(size(r["vx"], r["vy"]), size(r["ax"], r["ay"]))))


def _stats(n: Column, mean: Column, deviation: Column, name: str) -> list[Column]:
    return [F.when(n > 0, mean).otherwise(0.0).alias(f"{name}_mean"), F.when(n > 0, F.greatest(deviation, F.lit(1e-6))).otherwise(1.0).alias(f"{name}_std")]


def pooled_stats(rows: DataFrame, values: Column, pooled: bool = True) -> DataFrame:
    """One row: mean and deviation of speeds and of accelerations, and the number of values.

    ``values`` has them in turn, speeds first.  ``pooled`` gives those of all values for both.
    """
    flat = rows.select(F.posexplode(values).alias("i", "v"))
    part = {"velocity": F.lit(True), "acceleration": F.lit(True)} if pooled else {"velocity": F.col("i") % 2 == 0, "acceleration": F.col("i") % 2 == 1}
    out = []
    for name, own in part.items():
        v = F.when(own, F.col("v"))
        out += _stats(F.count(v), F.avg(v), F.stddev_pop(v), name)
    return flat.agg(*out, F.count("v").alias("sample_count"))


KINDS = ("velocity", "acceleration")


def moments(rows: DataFrame, values: Column, by: list[str]) -> DataFrame:
    """``by, kind, n, mean, m2``: of each group's speeds and accelerations their number, mean and squared deviations.

    These add up (``merged_stats``), so that statistics of more games need the new games only.
    """
    flat = rows.select(*by, F.posexplode(values).alias("i", "v")).where("v is not null")
    kind = F.when(F.col("i") % 2 == 0, KINDS[0]).otherwise(KINDS[1])
    return flat.groupBy(*by, kind.alias("kind")).agg(F.count("v").alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("v")).alias("m2"))


def merged_stats(parts: DataFrame, pooled: bool = True) -> DataFrame:
    """The row of ``pooled_stats`` from moments: squared deviations plus those of the groups' means from the whole mean.

    The whole means are known before anything is subtracted from them, so nothing cancels out.
    """
    whole = parts.groupBy("kind").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("mean")).alias("s")).collect()  # two rows
    counts = {k: sum(r["n"] for r in whole if pooled or r["kind"] == k) for k in KINDS}
    means = {k: sum(r["s"] for r in whole if pooled or r["kind"] == k) / counts[k] if counts[k] else 0.0 for k in KINDS}
    out = []
    for k in KINDS:
        off = F.col("mean") - means[k]
        square = F.when(F.lit(pooled) | (F.col("kind") == k), F.col("m2") + F.col("n") * off * off)
        out += _stats(F.lit(counts[k]), F.lit(means[k]), F.sqrt(F.sum(square) / max(counts[k], 1)), k)
    return parts.agg(*out, F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("sample_count"))
