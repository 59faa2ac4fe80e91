"""Sample archives, reviews and configurations at rest."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import Config
from ..operators.splits import magnitudes_of_inputs, merged_stats, moments

SPLITS = ("train", "validation", "test")


@dataclass(frozen=True)
class Written:
    """What a write saw, told by the writing jobs themselves."""

    samples: dict[str, int]  # by split
    sequences: int | None = None
    games: int | None = None

    @property
    def total(self) -> int:
        return sum(self.samples.values())


def _put_samples(samples: DataFrame, path: str, mode: str, rows_per_file: int, tasks_per_game: int) -> dict[str, int]:
    seen = Observation("samples")
    counts = [F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    salt = F.pmod(F.xxhash64("sequence_index", "window_index", "ego_slot"), F.lit(tasks_per_game))
    spread = samples.repartition("split", "game_id", salt).observe(seen, F.count("*").alias("all"), *counts)
    spread.write.partitionBy("split", "game_id").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).mode(mode).parquet(f"{path}/samples")
    told = seen.get
    if told["all"] != sum(told[s] for s in SPLITS):
        raise ValueError("a sample has no known split")
    return {s: told[s] for s in SPLITS if told[s]}


def _put(df: DataFrame, path: str, name: str, mode: str) -> int:
    seen = Observation(name)
    df.observe(seen, F.count("*").alias("n")).write.mode(mode).parquet(f"{path}/{name}")
    return seen.get["n"]


def write_dataset(
    samples: DataFrame, splits: DataFrame, stats: DataFrame | None, path: str, rows_per_file: int = 100_000, games: DataFrame | None = None, tasks_per_game: int = 1,
    sequences: DataFrame | None = None, pooled: bool = True,
) -> Written:
    """Samples by split and game, splits, statistics, moments, games' metadata, sequences and a manifest of counts.

    Nothing but Spark's writers touches the file system.  A game's samples are brought together
    first, in ``tasks_per_game`` tasks, so that each folder gets that many files or as many as
    ``rows_per_file`` makes of it.  Each table is one job, and counts are observed while it
    writes.  Moments by game come from the files that were written, and so do statistics unless
    they are given.  The manifest counts rows by the files' footers; it has to tell as many as were seen.
    """
    seen = _put_samples(samples, path, "overwrite", rows_per_file, tasks_per_game)
    samples.sparkSession.createDataFrame([(samples.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/schema")
    splits.write.mode("overwrite").parquet(f"{path}/splits")
    n_sequences = None if sequences is None else _put(sequences, path, "sequences", "overwrite")
    n_games = None if games is None else _put(games, path, "games", "overwrite")
    told = Written(seen, n_sequences, n_games)
    written = read_dataset(samples.sparkSession, path)
    _moments(written).write.mode("overwrite").parquet(f"{path}/moments")
    (stats if stats is not None else stored_stats(samples.sparkSession, path, pooled)).write.mode("overwrite").parquet(f"{path}/stats")
    _put_manifest(written, path, told.total, "overwrite")
    return told


def _moments(samples: DataFrame) -> DataFrame:
    return moments(samples, magnitudes_of_inputs(F.col("input")), ["split", "game_id"])


def _put_manifest(written: DataFrame, path: str, expected: int, mode: str) -> None:
    manifest = written.groupBy("split", "game_id").agg(F.count("*").alias("samples")).withColumn("version", F.lit(2))
    seen = Observation("manifest")
    manifest.coalesce(1).observe(seen, F.coalesce(F.sum("samples"), F.lit(0)).alias("n")).write.mode(mode).json(f"{path}/manifest")
    if seen.get["n"] != expected:
        raise ValueError(f"{expected} samples were written and {seen.get['n']} are there")


def stored_stats(spark: SparkSession, path: str, pooled: bool = True) -> DataFrame:
    """Statistics of the train samples, merged from the games' moments."""
    rows = spark.read.schema("split string, game_id string, kind string, n bigint, mean double, m2 double").parquet(f"{path}/moments")
    return merged_stats(rows.where("split = 'train'"), pooled)


def add_games(samples: DataFrame, splits: DataFrame, path: str, rows_per_file: int = 100_000, tasks_per_game: int = 1, pooled: bool = True) -> Written:
    """More games for a dataset: their samples, splits and moments are added, statistics are merged anew.

    Samples that are there are not read.  A game that is there already is an error.
    """
    spark = samples.sparkSession
    there = spark.read.schema(splits.schema).parquet(f"{path}/splits")
    if twice := there.join(splits.select("game_id").distinct(), "game_id", "left_semi").take(3):
        raise ValueError(f"the dataset has {[r['game_id'] for r in twice]} already")
    seen = _put_samples(samples.select(*StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()["value"])).names), path, "append", rows_per_file, tasks_per_game)
    splits.write.mode("append").parquet(f"{path}/splits")
    # The names of the new games, one for each log, prune the folders that are scanned.
    added = read_dataset(spark, path).where(F.col("game_id").isin([r["game_id"] for r in splits.select("game_id").collect()]))
    _moments(added).write.mode("append").parquet(f"{path}/moments")
    _put_manifest(added, path, sum(seen.values()), "append")
    stored_stats(spark, path, pooled).write.mode("overwrite").parquet(f"{path}/stats")
    return Written(seen)


def read_dataset(spark: SparkSession, path: str, split: str | None = None, skip_corrupt: bool = False) -> DataFrame:
    """Samples of a dataset, which may be empty; a split prunes folders."""
    schema = StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()["value"]))
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", str(skip_corrupt).lower()).parquet(f"{path}/samples")
    return rows if split is None else rows.where(F.col("split") == split)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("split string, game_id string, samples bigint, version int").json(f"{path}/manifest")


def sample_files(spark: SparkSession, path: str, limit: int = 3) -> tuple[int, list[str]]:
    """How many samples there are, and the first files."""
    n = read_manifest(spark, path).agg(F.coalesce(F.sum("samples"), F.lit(0)).alias("n")).first()["n"]
    return n, sorted(read_dataset(spark, path).inputFiles())[:limit]


def reviews_from_json(spark: SparkSession, path: str) -> DataFrame:
    """``game_id, sequence_index, verdict, note`` from ``{"entries": {game: {index: {verdict, note}}}}``."""
    schema = "entries map<string, map<string, struct<verdict:string,note:string>>>"
    games = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path).select(F.explode("entries").alias("game_id", "_s"))
    rows = games.select("game_id", F.explode("_s").alias("_i", "_e"))
    return rows.select("game_id", F.col("_i").cast("bigint").alias("sequence_index"), "_e.verdict", "_e.note")


def reviews_to_json(reviews: DataFrame) -> DataFrame:
    """One ``value`` with all reviews as JSON, for a text sink; reviews are made by hand and few."""
    entry = F.struct(F.col("sequence_index").cast("string"), F.struct("verdict", "note"))
    games = reviews.groupBy("game_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("s"))
    return games.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("game_id", "s"))).alias("entries"))).alias("value"))


def config_with_source(text: str, tracker_source: str | None, name: str | None, color: str | None) -> Config:
    """A configuration from JSON under command-line choices: the source always replaces, a name wins over a colour."""
    from dataclasses import replace

    if not name and not color:
        raise ValueError("a team name or colour is needed")
    cfg = Config.from_json(text) if text else Config()
    return replace(cfg, tracker_source=tracker_source, target_name=name or None, target_color=color or cfg.target_color)


def report(
    written: Written | DataFrame, games: DataFrame, splits: DataFrame, seconds: dict[str, float] | None = None, logs_found: int | None = None, failed: int | None = None,
    path: str | None = None,
) -> str:
    """Counts by split and phase, and what is given of seconds by step, logs found and failed, as JSON.

    Of a ``Written``, samples and sequences are what its jobs saw; with ``path``, the manifest tells the samples of each game.
    """
    if isinstance(written, Written):
        by_split, more = written.samples, {} if written.sequences is None else {"sequences": written.sequences}
    else:
        by_split, more = {r["split"]: r["n"] for r in written.groupBy("split").agg(F.count("*").alias("n")).collect()}, {}
    by_phase = {r["phase"]: r["n"] for r in games.groupBy("phase").agg(F.count("*").alias("n")).collect()}
    if seconds:
        more["seconds"] = {k: round(v, 3) for k, v in seconds.items()}
    if logs_found is not None:
        more |= {"logs": logs_found, "failed": failed}
    if path is not None:
        rows = splits.select("game_id", "split").join(read_manifest(splits.sparkSession, path).select("game_id", "samples"), "game_id", "left")
        more["by_game"] = {r["game_id"]: [r["split"], r["samples"] or 0] for r in rows.collect()}  # one short entry for each log
    return json.dumps({"games": splits.count(), "samples": by_split, "phases": by_phase} | more, sort_keys=True)
