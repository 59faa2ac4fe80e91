"""Counts observed while writing, statistics that merge, and tensor files, against plain versions."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import splits, tensors
from trackloom.sources import datasets


def made(spark, games, seed=1, per_game=9, width=32):
    r = random.Random(seed)
    rows = []
    for g, split in games:
        for k in range(per_game):
            values = [r.uniform(-1, 1) * (1e6 if g == "big" else 1) for _ in range(width)]
            rows.append((g, k // 3, k % 3, k % 2, split, values, [r.random()] * 3, r.choice([1.0, 1.5])))
    schema = "game_id string, sequence_index long, window_index long, ego_slot int, split string, input array<float>, target array<float>, sample_weight double"
    return spark.createDataFrame(rows, schema)


def split_table(spark, games):
    return spark.createDataFrame([(g, s, "Group", 0) for g, s in games], "game_id string, split string, phase string, sample_count bigint")


GAMES = [("a", "train"), ("b", "train"), ("big", "train"), ("c", "validation"), ("d", "test")]


def stats_row(df):
    return {c: v for c, v in df.first().asDict().items()}


def close(a, b):
    return a.keys() == b.keys() and all(abs(a[k] - b[k]) <= 1e-9 * max(1, abs(b[k])) for k in a)


@pytest.mark.parametrize("pooled", [True, False])
def test_merged_moments_equal_recomputed_statistics(spark, pooled):
    samples = made(spark, GAMES)
    values = splits.magnitudes_of_inputs(F.col("input"))
    parts = splits.moments(samples, values, ["game_id"])
    assert close(stats_row(splits.merged_stats(parts, pooled)), stats_row(splits.pooled_stats(samples, values, pooled)))
    none = samples.limit(0)
    assert stats_row(splits.merged_stats(splits.moments(none, values, ["game_id"]), pooled)) == stats_row(splits.pooled_stats(none, values, pooled))
    far = samples.withColumn("input", F.transform("input", lambda x: (x + 1e7).cast("double")))
    assert close(stats_row(splits.merged_stats(splits.moments(far, values, ["game_id"]), pooled)), stats_row(splits.pooled_stats(far, values, pooled)))


def test_a_write_tells_what_it_wrote(spark, tmp_path):
    samples, path = made(spark, GAMES), str(tmp_path / "set")
    sequences = samples.select("game_id", "sequence_index").distinct()
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    told = datasets.write_dataset(samples, split_table(spark, GAMES), None, path, sequences=sequences, games=sequences.select("game_id").distinct())
    assert told == datasets.Written({"train": 27, "validation": 9, "test": 9}, 15, 5) and told.total == samples.count()
    assert len(jobs.getJobIdsForGroup(None)) >= before
    by_game = {(r["game_id"], r["split"]): r["samples"] for r in datasets.read_manifest(spark, path).collect()}
    assert by_game == {g: 9 for g in GAMES}
    train = samples.where("split = 'train'")
    assert close(stats_row(spark.read.parquet(f"{path}/stats")), stats_row(splits.pooled_stats(train, splits.magnitudes_of_inputs(F.col("input")))))
    said = json.loads(datasets.report(told, split_table(spark, GAMES), split_table(spark, GAMES), logs_found=7, failed=2, path=path))
    assert said["samples"] == {"train": 27, "validation": 9, "test": 9} and said["sequences"] == 15 and (said["logs"], said["failed"]) == (7, 2)
    assert said["by_game"]["c"] == ["validation", 9]
    with pytest.raises(ValueError, match="no known split"):
        datasets.write_dataset(samples.withColumn("split", F.lit("other")), split_table(spark, GAMES), None, str(tmp_path / "x"))


def test_the_manifest_reads_no_column(spark, tmp_path):
    path = str(tmp_path / "set")
    datasets.write_dataset(made(spark, GAMES), split_table(spark, GAMES), None, path)
    plan = datasets.read_dataset(spark, path).groupBy("split", "game_id").agg(F.count("*"))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<>" in plan


def test_games_are_added_without_reading_the_old_ones(spark, tmp_path):
    path = str(tmp_path / "set")
    old, new = made(spark, GAMES), [("e", "train"), ("f", "test")]
    datasets.write_dataset(old, split_table(spark, GAMES), None, path)
    for f in (tmp_path / "set/samples").rglob("*.parquet"):
        f.write_bytes(b"what is in here is gone")  # reading it would fail
    for f in (tmp_path / "set/samples").rglob(".*.crc"):
        f.unlink()
    added = made(spark, new, seed=2)
    assert datasets.add_games(added, split_table(spark, new), path) == datasets.Written({"train": 9, "test": 9})
    train = old.union(added).where("split = 'train'")
    assert close(stats_row(spark.read.parquet(f"{path}/stats")), stats_row(splits.pooled_stats(train, splits.magnitudes_of_inputs(F.col("input")))))
    assert {r["game_id"]: r["samples"] for r in datasets.read_manifest(spark, path).collect()} == dict.fromkeys("abcdef", 9) | {"big": 9} and spark.read.parquet(f"{path}/splits").count() == 7
    with pytest.raises(ValueError, match="already"):
        datasets.add_games(added, split_table(spark, new), path)


def rows_of(batch):
    grids = batch.grids if batch.grids is not None else [None] * len(batch.inputs)
    return [(i.tolist(), t.tolist(), w.tolist(), None if g is None else g.tolist()) for i, t, w, g in zip(batch.inputs, batch.targets, batch.weights, grids)]


@pytest.mark.parametrize("grid", [None, (2, 2)])
@pytest.mark.parametrize("rows", [4, 7, 1000])
def test_tensor_files_equal_batches(spark, tmp_path, grid, rows):
    samples = made(spark, GAMES).repartition(3)
    if grid:
        samples = samples.withColumn("grid", F.transform(F.sequence(F.lit(1), F.lit(12)), lambda k: (k * F.col("ego_slot")).cast("float")))
    path = str(tmp_path / "t")
    index = tensors.write_tensors(samples, path, steps=4, rows=rows, grid_shape=grid)
    files = tensors.TensorFiles(path)
    assert files.rows == index.agg(F.sum("rows")).first()[0] == 45 and len(files) == index.count()
    want = sorted(rows_of(tensors.to_batch(samples.collect(), 4, grid)), key=str)
    for seed in (None, 3):
        got = [x for b in files.batches(seed) for x in rows_of(b)]
        assert sorted(got, key=str) == want
    first = files.batch(0)
    assert first.inputs.shape[1:] == (4, 8) and first.inputs.dtype == np.float32 and first.mask.shape == first.inputs.shape[:2] and first.mask.min() == 1
    orders = {tuple(b.inputs[0, 0, 0] for b in files.batches(s)) for s in range(6)}
    assert len(orders) > 1 or len(files) < 3


def test_tensor_files_refuse_what_batches_refuse(spark, tmp_path):
    a, b = made(spark, [("a", "train")], width=32), made(spark, [("b", "train")], width=40)
    for bad in (a.union(b).coalesce(1), a.coalesce(1).union(b.coalesce(1))):
        with pytest.raises(Exception, match="inputs have different lengths"):
            tensors.write_tensors(bad, str(tmp_path / "x"), steps=4)
    with pytest.raises(Exception, match="steps don't divide"):
        tensors.write_tensors(a, str(tmp_path / "x"), steps=5)
    some = a.withColumn("grid", F.when(F.col("ego_slot") == 0, F.array_repeat(F.lit(1.0).cast("float"), 12)))
    with pytest.raises(Exception, match="some samples have a grid"):
        tensors.write_tensors(some.coalesce(1), str(tmp_path / "x"), steps=4, grid_shape=(2, 2))
    with pytest.raises(Exception, match="some samples have a grid"):
        tensors.write_tensors(some.repartition(2, "ego_slot").where("ego_slot = 0").union(some.where("ego_slot = 1")), str(tmp_path / "x"), steps=4, grid_shape=(2, 2))
    assert tensors.write_tensors(a.limit(0), str(tmp_path / "none"), steps=4).count() == 0
    assert len(tensors.TensorFiles(str(tmp_path / "none"))) == 0
