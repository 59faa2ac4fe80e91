"""Long games in pieces, ranks, matchings, intervals and the search index, each against a plain version."""

from __future__ import annotations

import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trackloom.config import Config
from trackloom.operators import dynamics, frames as fr, ingest, matching, resample, review, scans, sequences
from trackloom.plans import pipelines
from trackloom.schemas import BALL, REFEREE, ROBOT
from trackloom.scratch import written
from trackloom.sources.adapters import in_slots


def all_matchings(costs, penalty):
    """Depth first, unmatched before the columns in order; the first of the cheapest."""
    best: list = [None, float("inf")]

    def go(k, used, chosen, cost):
        if k == len(costs):
            if cost < best[1]:
                best[:] = [list(chosen), cost]
            return
        go(k + 1, used, [*chosen, None], cost + penalty)
        for c in sorted(costs[k]):
            if c not in used:
                go(k + 1, used | {c}, [*chosen, c], cost + costs[k][c])

    go(0, frozenset(), [], 0)
    return best[0]


def test_the_first_cheapest_matching_is_found():
    r = random.Random(4)
    for _ in range(4000):
        n, m, high = r.randrange(6), r.randrange(6), r.choice([1, 2, 3, 50])
        costs = [{c: r.randrange(high + 1) for c in range(m) if r.random() < 0.8} for _ in range(n)]
        penalty = r.randrange(high + 2)
        assert matching.cheapest(costs, penalty) == all_matchings(costs, penalty)


def test_thirty_against_thirty_takes_milliseconds():
    r = random.Random(1)
    for penalty, costs in [(9, [{c: 7 for c in range(30)}] * 30), (7, [{c: 7 for c in range(30)}] * 30), (3, [{c: r.randrange(4) for c in range(30)} for _ in range(30)])]:
        began = time.perf_counter()
        found = matching.cheapest(costs, penalty)
        assert time.perf_counter() - began < 0.5
        assert len({c for c in found if c is not None}) == sum(c is not None for c in found)
    assert matching.cheapest([{c: 7 for c in range(30)}] * 30, 9) == list(range(30))
    assert matching.cheapest([{c: 7 for c in range(30)}] * 30, 7) == [None] * 30


@pytest.fixture(scope="module")
def long_game(spark):
    """One game of 2,000 raw frames and a short one, with gaps, equal times, missing balls and robots."""
    r = random.Random(8)
    rows, t = [], 0.0
    for k in range(2000):
        t += r.choice([0.0, 0.02, 0.03, 0.03, 0.05, 0.9])
        robot = lambda i: (i, None, "Unknown", r.uniform(-5, 5), r.uniform(-3, 3), r.uniform(-3, 3), 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)
        ball = None if r.random() < 0.1 else (r.uniform(-1, 1), r.uniform(-1, 1), 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)
        rows.append(("long" if k > 9 else "short", k, "s", t, r.randrange(5), ball, [robot(1)] if r.random() < 0.9 else [], [robot(2)]))
    schema = f"game_id string, msg_pos bigint, source_name string, timestamp_s double, frame_number bigint, ball {BALL}, yellow array<{ROBOT}>, blue array<{ROBOT}>"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


@pytest.fixture(scope="module")
def games(spark):
    referee = (0, 2, True, 1, "y", "b", 1, 2)
    return spark.createDataFrame([("long", referee, "Blue"), ("short", referee, "Yellow")], f"game_id string, referee {REFEREE}, target_color string")


CFG = replace(Config(), possession_radius_m=4.0, team_size=2)


def told(df):
    return sorted(map(str, df.collect()))


def test_frames_are_numbered_in_pieces(long_game):
    assert told(ingest.order_frames(long_game, piece_s=7.0).select(*long_game.columns, "frame_pos")) == told(ingest.order_frames(long_game))
    odd = long_game.withColumn("timestamp_s", F.when(F.col("msg_pos") % 50 == 0, None).when(F.col("msg_pos") % 50 == 1, float("nan")).when(F.col("msg_pos") % 50 == 2, 1e300).otherwise(F.col("timestamp_s")))
    assert told(ingest.order_frames(odd, piece_s=7.0).select(*odd.columns, "frame_pos")) == told(ingest.order_frames(odd))


@pytest.mark.parametrize("rows", [2, 7, 250])
def test_flags_and_dynamics_in_pieces(spark, long_game, games, rows):
    tracked = in_slots(ingest.order_frames(long_game), 2)
    whole = pipelines.moving_frames(tracked, games, CFG)
    parts = pipelines.moving_frames(tracked, games, CFG, piece_rows=rows)
    assert parts.columns == whole.columns and told(parts) == told(whole)


def test_no_task_holds_a_whole_game(spark, long_game, games):
    tracked = in_slots(ingest.order_frames(long_game), 2)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frames = pipelines.moving_frames(tracked, games, CFG, piece_rows=125)
        for out, made in ((frames, "ball"), (sequences.segment(fr.clean_frames(tracked, games, CFG), CFG, piece_rows=125), "segment")):
            parts = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max(F.xxhash64(made))).collect()
            assert len(parts) > 2 and max(r["n"] for r in parts) < 1300
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_a_piece_is_no_shorter_than_the_reach(long_game):
    with pytest.raises(ValueError):
        scans.in_pieces(long_game, 2, 3, 0, lambda f: f)


@pytest.mark.parametrize("rows", [1, 13, 250])
def test_segments_in_pieces(long_game, games, rows):
    frames = fr.live_only(fr.clean_frames(in_slots(ingest.order_frames(long_game), 2), games, CFG), CFG)
    whole = sequences.segment(frames, CFG)
    assert told(sequences.segment(frames, CFG, piece_rows=rows).select(*whole.columns)) == told(whole)


@pytest.mark.parametrize("seconds", [0.05, 3.0, 1e6])
def test_resampling_in_pieces(spark, long_game, games, seconds):
    frames = fr.clean_frames(in_slots(ingest.order_frames(long_game), 2), games, CFG)
    even = frames.where("game_id = 'short'").withColumns({"game_id": F.lit("even"), "timestamp_s": F.col("frame_pos") * 0.5})
    still = frames.where("game_id = 'short'").withColumns({"game_id": F.lit("still"), "timestamp_s": F.lit(1.0)})
    every = frames.union(even.select(*frames.columns)).union(still.select(*frames.columns)).union(frames.where("game_id = 'long' and frame_pos < 2").withColumn("game_id", F.lit("two")))
    whole = resample.resample(every)
    assert told(resample.resample_split(every, seconds).select(*whole.columns)) == told(whole)
    assert resample.resample_split(every.limit(0), seconds).count() == 0


def test_cleaning_in_pieces(long_game, games):
    rows = 60
    cfg = replace(CFG, clean=replace(CFG.clean, teleport_m=4.0, spike_m=4.0, min_target_robots=1, min_opponent_robots=1))
    frames = written(pipelines.moving_frames(in_slots(ingest.order_frames(long_game), 2), games, cfg), "frames")
    whole = pipelines.automatic_frames(frames, cfg)
    parts = pipelines.automatic_frames(frames, cfg, piece_s=5.0, piece_rows=rows)
    assert parts.columns == whole.columns and told(parts) == told(whole)
    assert 100 < whole.count() < fr.live_only(resample.resample(frames), cfg).count()


def test_sums_and_last_values_over_pieces(spark):
    r = random.Random(3)
    rows = [(r.choice("ab"), k, r.randrange(5) or None, r.choice([None, "x", "y", "z"])) for k in range(500)]
    df = spark.createDataFrame(rows, "game_id string, frame_pos long, v long, w string")
    order = Window.partitionBy("game_id").orderBy("frame_pos")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    for size in (1, 9, 1000):
        piece = scans.of_position(size)
        got = scans.running_sum(df, F.col("v"), ["frame_pos"], piece, "s")
        assert told(got.select(*df.columns, "s")) == told(df.withColumn("s", F.coalesce(F.sum("v").over(upto), F.lit(0))))
        for strict in (True, False):
            span = order.rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
            got = scans.last_before(df, F.col("w"), ["frame_pos"], piece, "l", F.col("frame_pos"), strict)
            assert told(got.select(*df.columns, "l")) == told(df.withColumn("l", F.last("w", ignorenulls=True).over(span)))


def test_ranks_without_one_task(spark):
    r = random.Random(2)
    names = [f"g{r.randrange(10**6)}" for _ in range(997)] + [None]
    df = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "name string, k long").repartition(6)
    known, total = scans.ranked(df, ["name", "k"], "rank", parts=7)
    got = [(x["name"], x["k"]) for x in sorted(known.collect(), key=lambda x: x["rank"])]
    assert got == sorted(((n, k) for k, n in enumerate(names)), key=lambda x: (x[0] is not None, x[0] or "", x[1])) and total == 998
    assert sorted(x["rank"] for x in known.collect()) == list(range(998))
    assert "Window" not in known._jdf.queryExecution().toString() and known.select("rank").rdd.getNumPartitions() > 1
    empty, none = scans.ranked(df.limit(0), ["name"], "rank")
    assert empty.count() == none == 0


def test_intervals_meet_points_in_bins(spark):
    r = random.Random(6)
    ranges = [(r.choice("ab"), k, a, a + r.choice([0, 1, 7, 8, 9, 63, 64, 65, 700, 100_000, -1])) for k, a in enumerate(r.randrange(-5000, 5000) for _ in range(300))]
    ranges += [("a", 900, None, 5), ("a", 901, 5, None), (None, 902, 0, 9), ("a", 903, -(2**40), 2**40)]
    points = [(r.choice("ab"), r.randrange(-6000, 6000)) for _ in range(300)] + [("a", None), (None, 3)]
    p = spark.createDataFrame(points, "g string, at long")
    s = spark.createDataFrame(ranges, "g string, k long, a long, z long")
    got = sorted((x["g"], x["at"], x["k"]) for x in review.in_bins(p, s, ["g"], "at", "a", "z").collect())
    ok = lambda *x: all(v is not None for v in x)
    assert got == sorted((g, at, k) for g, at in points for h, k, a, z in ranges if ok(g, h, at, a, z) and g == h and a <= at <= z)
    assert review.in_bins(p, s.limit(0), ["g"], "at", "a", "z").count() == 0


def test_rows_through_the_interval_join_are_linear(spark):
    """One game of 20,000 frames in ranges of 5 to 60: pairs that meet are a few for each frame."""
    r = random.Random(1)
    ranges, at = [], 0
    while at < 20_000:
        n = r.choice([5, 20, 60])
        ranges.append(("g", len(ranges), at, at + n - 1))
        at += n
    p = spark.range(20_000).select(F.lit("g").alias("g"), F.col("id").alias("at"))
    s = spark.createDataFrame(ranges, "g string, k long, a long, z long")
    met = review.meetings(p, s, ["g"], "at", "a", "z").count()
    assert met < 20_000 * 12 and len(ranges) > 500
    assert review.in_bins(p, s, ["g"], "at", "a", "z").count() == 20_000


def test_search_by_trigrams(spark, tmp_path):
    r = random.Random(5)
    words = ["Keep", "look at THIS", "ünïcode", "ball missing", "a", "", "xyz", "doc 12", "doc 123"]
    rows = [(f"g{k % 7}", k, r.choice(["OpenPlay", "Unknown"]), r.sample(["ball-missing", "mixed-live-state"], r.randrange(3)), r.choice(["Keep", "Drop"]), " ".join(r.choices(words, k=3))) for k in range(200)]
    rows.append(("g0", 900, "Unknown", None, "Keep", None))
    s = spark.createDataFrame(rows, "game_id string, sequence_index long, sequence_kind string, warnings array<string>, verdict string, note string")
    path = str(tmp_path / "index")
    review.write_index(s, path)
    for term in ("this", "THIS", "ÜNÏ", "doc 123", "12", "a", "", "  ", "zzz", "missing mixed", "openplay ball", "knownball"):
        for verdict in (None, "Keep"):
            got = sorted(tuple(x) for x in review.search_index(spark, path, term, verdict).collect())
            assert got == sorted((x["game_id"], x["sequence_index"]) for x in review.search(s, verdict, term).collect()), term
    plan = review.search_index(spark, path, "this")._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "In(gram" in plan and "bucket" in plan.split("PartitionFilters: [", 1)[1][:200]
