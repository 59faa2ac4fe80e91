from __future__ import annotations

import itertools
import math
import random
from dataclasses import replace
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.config import Config, IdentityConfig
from trackloom.functions.geometry import wrap_angle
from trackloom.operators import augment, clean, dynamics, frames as fr, ingest, resample, review, samples, sequences, splits, tensors, tracking
from trackloom.schemas import BALL, FLAGS, FRAMES, REFEREE, REVIEWS, ROBOT

CFG = Config(team_size=2)
ZERO_FLAGS = {"duplicate_timestamp": False, "carried_ball": False, "out_of_bounds_objects": 0, "missing_target_robot_slots": 0, "likely_identity_swap": False, "referee_live": True, "heuristic_live": True}


def robot(x=0.0, y=0.0, theta=0.0, stable_id=0, visibility=1.0, **more):
    x, y, theta = float(x), float(y), float(theta)
    return {"raw_id": 1, "stable_id": stable_id, "role": "Unknown", "x": x, "y": y, "theta": theta, "vx": 0.0, "vy": 0.0, "omega": 0.0, "ax": 0.0, "ay": 0.0, "visibility": visibility} | more


def ball(x=0.0, y=0.0, **more):
    return {"x": float(x), "y": float(y), "z": 0.0, "vx": 0.0, "vy": 0.0, "ax": 0.0, "ay": 0.0, "visibility": 1.0} | more


def frame(pos, t, b=None, target=(), opponent=(), game="g", flags=None, positive=False, live=True):
    pad = lambda team: (list(team) + [None, None])[:2]
    referee = {"stage": 0, "command": 2, "blue_team_on_positive_half": True, "match_type": 1, "yellow_name": "Y", "blue_name": "B", "yellow_score": 1, "blue_score": 2}
    return (game, pos, float(t), 100 + pos, b, pad(target), pad(opponent), referee, live, positive, "Unknown", ZERO_FLAGS | (flags or {}))


def frames_of(spark, rows):
    return spark.createDataFrame(rows, FRAMES)


def ordered(df):
    return sorted(df.collect(), key=lambda r: (r["game_id"], r["frame_pos"]))


def test_mirror_vectors():
    """Published vectors: the entries of a one-step window of two-robot teams that a mirror along x negates."""
    flips = set(augment.flipped_entries("x", 2))
    assert {0, 2, 4, 7, 8, 10, 12, 15, 29, 31, 33, 36, 38} <= flips and len(flips) == 8 + 3 * 5
    assert Config(team_size=2).step_features == 71 and Config().step_features == 183 and Config().sample_features == 2928


def test_mirrors_and_grids(spark):
    r = random.Random(1)
    values = [r.random() for _ in range(142)]
    df = spark.createDataFrame([(values, [0.1, 0.2, 0.3], [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])], "input array<float>, target array<float>, grid array<float>")
    row = df.select(
        augment.mirror_input(F.col("input"), "y", 2).alias("once"), augment.mirror_input(augment.mirror_input(F.col("input"), "y", 2), "y", 2).alias("twice"),
        augment.mirror_target(F.col("target"), "y").alias("t"), augment.mirror_grid(F.col("grid"), 3, 2, y=True).alias("g"), augment.mirror_grid(F.col("grid"), 3, 2, x=True).alias("gx"),
    ).first()
    flips = set(augment.flipped_entries("y", 2))
    assert all(abs(b - (-a if i % 71 in flips else a)) < 1e-6 for i, (a, b) in enumerate(zip(values, row["once"])))
    assert np.allclose(row["twice"], values) and np.allclose(row["t"], [0.1, -0.2, -0.3]) and row["g"] == [4, 5, 6, 1, 2, 3] and row["gx"] == [3, 2, 1, 6, 5, 4]


def test_noise_is_normal_and_repeatable(spark):
    df = spark.range(20_000).select(augment.gaussian(3, F.col("id")).alias("z"))
    a = [r["z"] for r in df.collect()]
    assert a == [r["z"] for r in df.collect()] and abs(np.mean(a)) < 0.03 and abs(np.std(a) - 1) < 0.03


@pytest.mark.parametrize("n, want", [(1, (1, 0, 0)), (2, (1, 0, 1)), (3, (2, 0, 1)), (4, (3, 1, 0)), (5, (4, 1, 0)), (6, (4, 1, 1)), (7, (5, 1, 1)), (10, (7, 2, 1))])
def test_split_vectors(spark, n, want):
    games = spark.createDataFrame([(f"g{k:02}", "Group") for k in range(n)], "game_id string, phase string")
    got = [r["split"] for r in splits.assign_splits(games, Config()).orderBy("game_id").collect()]
    assert tuple(got.count(s) for s in ("train", "validation", "test")) == want and got == sorted(got, key=["train", "validation", "test"].index)


def test_wrap_angle(spark):
    xs = [0.0, math.pi, -math.pi, 3.5, -3.5, 10.0, -10.0, 100.0, float("nan"), float("inf"), None]
    got = [r["a"] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(wrap_angle(F.col("x")).alias("a")).collect()]
    assert got[1] == math.pi and got[2] == -math.pi and got[8:] == [None] * 3
    assert all(abs(g) <= math.pi + 1e-12 and abs(math.sin(g) - math.sin(x)) < 1e-9 for x, g in zip(xs[:8], got))


def test_assignment_against_all_matchings():
    r = random.Random(7)
    for _ in range(150):
        n, m = r.randrange(5), r.randrange(5)
        tracks = [tracking.Track(k, robot(r.random() * 2, r.random())) for k in range(n)]
        seen = [robot(r.random() * 2, r.random(), r.random()) for _ in range(m)]
        best = math.inf
        for k in range(min(n, m) + 1):
            for ts in itertools.combinations(range(n), k):
                for os in itertools.permutations(range(m), k):
                    costs = [tracking.motion_cost(tracks[t].state, seen[o]) for t, o in zip(ts, os)]
                    if all(c <= 0.9 for c in costs):
                        best = min(best, sum(costs) + 1.2 * (n - k))
        pairs = tracking.assign(tracks, seen, 0.9, 1.2)
        assert len({t for t, _ in pairs}) == len({o for _, o in pairs}) == len(pairs)
        assert abs(sum(tracking.motion_cost(tracks[t].state, seen[o]) for t, o in pairs) + 1.2 * (n - len(pairs)) - best) < 1e-9


def raw_frames(spark, rows):
    schema = f"game_id string, msg_pos bigint, source_name string, timestamp_s double, frame_number bigint, ball {BALL}, yellow array<{ROBOT}>, blue array<{ROBOT}>"
    return spark.createDataFrame(rows, schema)


def test_tracking_first_frame_order_swaps_eviction_and_roles(spark):
    seen = [
        [robot(2.0, raw_id=1), robot(0.0, raw_id=2)],  # first frame keeps the order of observation
        [robot(2.1, raw_id=1), robot(0.1, raw_id=2)],
        [robot(2.1, raw_id=9), robot(0.1, raw_id=2)],  # a raw id changes on a track
        *[[robot(0.1, raw_id=2)]] * 10,  # the other is gone for more than eight frames
        [robot(0.1, raw_id=2), robot(2.0, raw_id=1)],
    ]
    rows = [("g", k, None, float(k), k, None, s, None) for k, s in enumerate(seen)]
    cfg = Config(team_size=2, identity=IdentityConfig())
    got = ordered(tracking.track(ingest.order_frames(raw_frames(spark, rows)), cfg))
    ids = [[s and s["stable_id"] for s in r["yellow"]] for r in got]
    assert ids[0] == [0, 1] and ids[1] == [1, 0] and [r["yellow_swap"] for r in got] == [False, False, True] + [False] * (len(got) - 3)
    assert ids[3 + 7] == [1, 0] and ids[3 + 8] == [1, None] and ids[-1] == [1, 2]
    assert [s["role"] for s in got[1]["yellow"]] == ["Goalkeeper", "Defender"] and all(r["blue"] == [None, None] for r in got)
    assert got[0]["yellow"][1]["role"] == "Goalkeeper"


def resample_plain(times):
    d = [b - a for a, b in zip(times, times[1:]) if b - a > 0]
    if len(times) < 3 or not d:
        return list(range(len(times)))
    mean = 0.0
    for x in d:
        mean += x
    mean /= len(d)
    if max(d) - min(d) <= 0.25 * mean:
        return list(range(len(times)))
    out, tick = [], times[0]
    while tick <= times[-1]:
        before = [i for i, t in enumerate(times) if t < tick]
        out.append(before[-1] if before else 0)
        tick += mean
    return out


def test_resample_against_a_running_clock(spark):
    r = random.Random(11)
    games = {}
    for g in range(12):
        t, times = r.choice([0.0, 1.7e9]), []
        for _ in range(r.choice([2, 3, 40, 300])):
            times.append(t)
            t += r.choice([0.0, 0.033, 0.03, 0.2, r.random() * 0.1]) if g else 0.033
        games[f"g{g}"] = times
    df = frames_of(spark, [frame(i, t, game=g) for g, ts in games.items() for i, t in enumerate(ts)])
    got: dict[str, list] = {}
    for x in ordered(resample.resample(df)):
        got.setdefault(x["game_id"], []).append(x["frame_number"] - 100)
    assert got == {g: resample_plain(ts) for g, ts in games.items()}


def test_dynamics_against_an_updating_loop(spark):
    r = random.Random(2)
    rows, t = [], 0.0
    for k in range(60):
        rows.append(frame(k, t, ball(r.random(), r.random(), vx=0.3, vy=0.1) if r.random() > 0.1 else None, [robot(r.random(), 0, r.random() * 6)] if r.random() > 0.1 else []))
        t += r.choice([0.0, 0.5, 1.0])
    got = ordered(dynamics.estimate_dynamics(frames_of(spark, rows), CFG))
    b = [x[4] and dict(x[4]) for x in rows]
    p = [x[5][0] and dict(x[5][0]) for x in rows]
    cut = lambda v, m: max(-m, min(m, v))
    for track, turn in ((b, False), (p, True)):
        for i in range(1, len(rows) - 1):
            dt = rows[i + 1][2] - rows[i - 1][2]
            if dt <= 0 or not (track[i - 1] and track[i] and track[i + 1]):
                continue
            track[i]["vx"] = cut((track[i + 1]["x"] - track[i - 1]["x"]) / dt, 4.0)
            track[i]["ax"] = cut((track[i]["vx"] - track[i - 1]["vx"]) / (dt / 2), 3.0)
            if turn:
                track[i]["omega"] = cut((track[i + 1]["theta"] - track[i - 1]["theta"]) / dt, 12.0)
    for x, bb, pp in zip(got, b, p):
        assert (x["ball"] is None) == (bb is None) and (bb is None or (abs(x["ball"]["vx"] - bb["vx"]) < 1e-9 and abs(x["ball"]["ax"] - bb["ax"]) < 1e-9))
        rr = x["target_team"][0]
        assert pp is None or (abs(rr["vx"] - pp["vx"]) < 1e-9 and abs(rr["ax"] - pp["ax"]) < 1e-9 and abs(rr["omega"] - pp["omega"]) < 1e-9)


def test_smoothing_against_plain_medians(spark):
    r = random.Random(3)
    xs = [r.random() if r.random() > 0.2 else None for _ in range(30)]
    rows = [frame(k, k, None if x is None else ball(x, -x), [] if x is None else [robot(x, 1 - x)]) for k, x in enumerate(xs)]
    got = ordered(clean.smooth_positions(frames_of(spark, rows), CFG))
    for k, x in enumerate(xs):
        around = [v for v in xs[max(0, k - 1) : k + 2] if v is not None]
        want = x if x is None or k in (0, 29) or len(around) < 3 else median(around)
        assert (got[k]["ball"] and got[k]["ball"]["x"]) == want and (got[k]["target_team"][0] and got[k]["target_team"][0]["x"]) == want


def test_teleports_also_drop_the_way_back_and_spikes_need_both_neighbours(spark):
    xs = [0.0, 0.1, 3.0, 0.1, 0.2]
    df = frames_of(spark, [frame(k, k * 0.033, None, [robot(x)]) for k, x in enumerate(xs)])
    assert [r["frame_pos"] for r in ordered(clean.drop_teleports(df, CFG))] == [0, 1, 4]
    far = frames_of(spark, [frame(k, k, None, [robot(x)]) for k, x in enumerate([0.0, 0.0, 50.0, 0.0])])
    assert [r["frame_pos"] for r in ordered(clean.drop_spikes(far, CFG))] == [0, 3]  # the row before it is off its line too
    other = frames_of(spark, [frame(k, k, None, [robot(x, stable_id=k)]) for k, x in enumerate([0.0, 0.0, 50.0, 0.0])])
    assert clean.drop_spikes(other, CFG).count() == 4 and clean.drop_teleports(other, CFG).count() == 4


def test_canonical_direction_is_idempotent(spark):
    df = frames_of(spark, [frame(0, 0, ball(1.0, 2.0), [robot(1.0, 2.0, 0.5, vx=1.0)]), frame(1, 1, ball(1.0), [robot(1.0)], positive=True)])
    once = fr.canonicalise(df)
    a = ordered(once)
    assert (a[0]["ball"]["x"], a[0]["ball"]["y"], a[1]["ball"]["x"]) == (-1.0, 2.0, 1.0) and abs(a[0]["target_team"][0]["theta"] - (math.pi - 0.5)) < 1e-12
    assert ordered(fr.canonicalise(once)) == a and a[0]["target_team"][1] is None


def test_sequences_break_at_a_missing_ball_and_drops_cascade(spark):
    rows, pos = [], 0
    for n in (60, 10, 70, 400, 80, 90):
        for _ in range(n):
            rows.append(frame(pos, pos * 0.03, ball(0.0)))
            pos += 1
        rows.append(frame(pos, pos * 0.03, None))
        pos += 1
    seg = sequences.segment(frames_of(spark, rows), Config(team_size=2))
    found = sequences.summarise(seg, Config(team_size=2))
    assert [(r["sequence_index"], r["frame_count"]) for r in found.orderBy("sequence_index").collect()] == [(0, 60), (1, 70), (2, 80), (3, 90)]
    marks = spark.createDataFrame([("g", 1, "Drop", ""), ("g", 0, "NeedsAttention", "")], REVIEWS)
    kept = sequences.apply_reviews(found, marks).collect()
    assert [(r["sequence_index"], r["warnings"][-1]) for r in kept] == [(0, "manual-needs-attention")]
    assert {r["sequence_index"] for r in sequences.apply_reviews(found, marks, cascade=False).collect()} == {0, 2, 3}
    assert {round(r["quality_score"], 6) for r in found.collect()} == {1.0}
    none = sequences.summarise(sequences.segment(frames_of(spark, rows[:0]), CFG), CFG)
    assert none.count() == 0


def plain_step(f, ego_slot, cfg):
    def rel(ego, e):
        dx, dy = e["x"] - ego["x"], e["y"] - ego["y"]
        a = math.atan2(dy, dx) - ego["theta"]
        return [dx / 4.5, dy / 3, e["vx"] / 4, e["vy"] / 4, e["ax"] / 3, e["ay"] / 3], math.hypot(dx, dy) / 9, a

    target, opponent, b, flags, referee = f[5], f[6], f[4], f[11], f[7]
    ego = target[ego_slot]
    if ego is None:
        return [0.0] * cfg.step_features
    out = [ego["x"] / 4.5, ego["y"] / 3, ego["vx"] / 4, ego["vy"] / 4, ego["ax"] / 3, ego["ay"] / 3, math.sin(ego["theta"]), math.cos(ego["theta"])]
    if b is None:
        out += [0.0] * 10
    else:
        moved, far, a = rel(ego, b)
        out += [*moved, far, math.sin(a), math.cos(a), b["visibility"]]
    out += [1.0, 0.0, 0.0, 0.0, referee["blue_score"], referee["yellow_score"], float(flags["carried_ball"]), 0.0, flags["missing_target_robot_slots"], 0.0, float(f[8])]
    for e in [t for k, t in enumerate(target) if k != ego_slot] + list(opponent):
        if e is None:
            out += [0.0] * 14
        else:
            moved, far, a = rel(ego, e)
            out += [*moved, math.sin(e["theta"]), math.cos(e["theta"]), far, math.sin(a), math.cos(a), e["visibility"], (e["stable_id"] or 0) / 15, 1.0]
    return out


def test_windows_features_targets_and_grids(spark):
    r = random.Random(9)
    cfg = Config(team_size=2, window=replace(Config().window, length=3, stride=2), grid_width=4, grid_height=3)
    one = lambda: robot(r.uniform(-5, 5), r.uniform(-3, 3), r.uniform(-3, 3), r.randrange(4), r.random(), vx=r.random(), ay=r.random()) if r.random() > 0.2 else None
    rows = [frame(k, k, ball(r.uniform(-4, 4), r.random()) if r.random() > 0.2 else None, [one(), one()], [one(), one()], flags={"missing_target_robot_slots": k}) for k in range(9)]
    played = frames_of(spark, rows).withColumns({"sequence_index": F.lit(0).cast("bigint"), "seq_pos": F.col("frame_pos"), "phase": F.lit("Group"), "quality_score": F.lit(1.0), "warnings": F.array().cast("array<string>")})
    stretched = samples.stretch(played, cfg)
    got = {(x["window_index"], x["ego_slot"]): x for x in samples.windows(stretched, cfg).collect()}
    want = {(w, e) for w in range(0, 6, 2) for e in range(2) if rows[w + 2][5][e] and rows[w + 3][5][e]}
    assert set(got) == want and want
    for (w, e), x in got.items():
        assert np.allclose(x["input"], sum((plain_step(rows[w + k], e, cfg) for k in range(3)), []), atol=1e-5)
        a, b = rows[w + 2][5][e], rows[w + 3][5][e]
        assert abs(x["target"][0] - (b["x"] - a["x"])) < 1e-5 and abs(math.sin(x["target"][2]) - math.sin(b["theta"] - a["theta"])) < 1e-5
        assert x["sample_weight"] == 1.0
    for g in samples.occupancy(stretched, cfg).collect():
        grid = [0.0] * 36
        for k in range(3):
            f = rows[g["window_index"] + k]
            for c, objects in enumerate((f[5], f[6], [f[4]])):
                for o in filter(None, objects):
                    cx = int(min(0.9999, max(0, (o["x"] + 4.5) / 9)) * 4)
                    cy = int(min(0.9999, max(0, (o["y"] + 3) / 6)) * 3)
                    grid[c * 12 + cy * 4 + cx] = max(grid[c * 12 + cy * 4 + cx], (k + 1) / 3)
        assert np.allclose(g["grid"], grid)


def test_stretch_lengths(spark):
    rows = [frame(k, k, ball()) for k in range(5)]
    played = frames_of(spark, rows).withColumns({"sequence_index": F.lit(0).cast("bigint"), "seq_pos": F.col("frame_pos")})
    cfg = replace(Config(), augment=replace(Config().augment, stretch_factors=(0.5, 0.0, 2.0, 0.1)))
    got: dict[int, list] = {}
    for x in samples.stretch(played, cfg).orderBy("stretch_index", "seq_pos").collect():
        got.setdefault(x["stretch_index"], []).append(x["frame_number"] - 100)
    assert got == {0: [0, 1, 2, 3, 4], 1: [0, 1, 3], 2: [0, 0, 1, 1, 2, 2, 3, 3, 4, 4], 3: [0, 2]}


def test_stats_and_tensors(spark):
    df = spark.createDataFrame([([0.0, 0.0, 3.0, 4.0, 6.0, 8.0, 0.0, 0.0, 9.0], [0.1, 0.2, 0.3], 1.0)], "input array<float>, target array<float>, sample_weight double")
    s = splits.pooled_stats(df, splits.magnitudes_of_inputs(F.col("input"))).first()
    assert tuple(s) == (7.5, 2.5, 7.5, 2.5, 2)
    assert tuple(splits.pooled_stats(df.limit(0), splits.magnitudes_of_inputs(F.col("input"))).first()) == (0.0, 1.0, 0.0, 1.0, 0)
    rows = [{"input": [0.5] * 366, "target": [0.1, 0.2, 0.3], "sample_weight": 1.0}]
    b = tensors.to_batch(rows, 2)
    assert b.inputs.shape == (1, 2, 183) and b.targets.shape == (1, 3) and b.mask.shape == (1, 2) and b.grids is None
    assert next(tensors.batches(df, 3)).inputs.shape == (1, 3, 3)
    with pytest.raises(ValueError):
        tensors.to_batch(rows, 7)
    with pytest.raises(ValueError):
        tensors.to_batch([rows[0] | {"grid": [1.0] * 3}, rows[0] | {"grid": None}], 2, (1, 1))


def test_review_payload_of_one_sequence(spark):
    df = frames_of(spark, [frame(k, k, ball(k), [robot(k), robot(-k)]) for k in range(5)])
    seqs = spark.createDataFrame([("g", 0, 101, 103, 1.0, 3.0, 3, 0.9, "Unknown", ["w"])], "game_id string, sequence_index bigint, start_frame bigint, end_frame bigint, start_time_s double, end_time_s double, frame_count bigint, quality_score double, sequence_kind string, warnings array<string>")
    marks = spark.createDataFrame([("g", 0, "Keep", "fine Pass")], REVIEWS)
    row = review.sequence_payload(df, df, seqs, marks, "g", 0).first()
    assert row["verdict"] == "Keep" and [x["frame_number"] for x in row["cleaned_frames"]] == [101, 102, 103] == [x["frame_number"] for x in row["raw_frames"]]
    assert review.sequence_payload(df, df, seqs, marks, "g", 5).count() == 0
    full = review.with_verdicts(seqs, marks)
    assert [review.search(full, *a).count() for a in ((None, "PASS"), ("Drop", ""), ("Keep", "  "), (None, "nothing"))] == [1, 0, 1, 0]
    assert FLAGS and REFEREE
