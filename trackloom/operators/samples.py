"""Training samples: sliding windows, ego-centred features, targets and occupancy grids.

Features of a frame are computed once for each ego; windows are cut from a sequence's array of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.geometry import as_number, clamp, one_hot_phase, role_code, wrap_angle



def stretch(frames: DataFrame, cfg: Config) -> DataFrame:
    """Add ``stretch_index``: 0 is the sequence itself, then one resampling for each positive factor.

    A stretched sequence of *m* frames takes at *i* the frame at floor(i / m * n).
    """
    base = frames.withColumn("stretch_index", F.lit(0))
    lengths = frames.groupBy("game_id", "sequence_index").agg(F.count("*").alias("_n"))
    for k, factor in enumerate((x for x in cfg.augment.stretch_factors if x > 0), 1):
        m = F.greatest(F.lit(2), F.round(F.col("_n").cast("double") * float(factor)).cast("int"))
        plan = lengths.withColumn("_m", m).select("game_id", "sequence_index", "_n", "_m", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)).alias("_i"))
        source = F.least(F.floor(F.col("_i") / F.col("_m") * F.col("_n")), F.col("_n") - 1).cast("bigint")
        picked = plan.select("game_id", "sequence_index", source.alias("seq_pos"), F.col("_i").cast("bigint").alias("_i"))
        out = picked.join(frames, ["game_id", "sequence_index", "seq_pos"]).withColumn("seq_pos", F.col("_i")).drop("_i")
        base = base.unionByName(out.withColumn("stretch_index", F.lit(k)))
    return base


def pose(r: Column, cfg: Config) -> list[Column]:
    return [
        r["x"] / cfg.half_length_m, r["y"] / cfg.half_width_m, r["vx"] / cfg.max_speed, r["vy"] / cfg.max_speed,
        r["ax"] / cfg.max_acceleration, r["ay"] / cfg.max_acceleration, F.sin(r["theta"]), F.cos(r["theta"]),
    ]


def _relative(ego: Column, e: Column, cfg: Config) -> tuple[list[Column], Column, Column]:
    dx, dy = e["x"] - ego["x"], e["y"] - ego["y"]
    moved = [dx / cfg.half_length_m, dy / cfg.half_width_m, e["vx"] / cfg.max_speed, e["vy"] / cfg.max_speed, e["ax"] / cfg.max_acceleration, e["ay"] / cfg.max_acceleration]
    return moved, F.sqrt(dx * dx + dy * dy) / (2 * cfg.half_length_m), wrap_angle(F.atan2(dy, dx) - ego["theta"])


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def ball_features(ego: Column, ball: Column, cfg: Config) -> Column:
    moved, far, angle = _relative(ego, ball, cfg)
    return F.when(ball.isNotNull(), F.array(*moved, far, F.sin(angle), F.cos(angle), ball["visibility"])).otherwise(zeros(10))


def robot_features(ego: Column, r: Column, cfg: Config) -> Column:
    moved, far, angle = _relative(ego, r, cfg)
    identity = F.coalesce(r["stable_id"], F.lit(0)) / 15.0
    out = F.array(*moved, F.sin(r["theta"]), F.cos(r["theta"]), far, F.sin(angle), F.cos(angle), r["visibility"], identity, role_code(r["role"]))
    return F.when(r.isNotNull(), out).otherwise(zeros(14))


def score_features() -> list[Column]:
    f, r = F.col("flags"), F.col("referee")
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    return [
        number(r["blue_score"]), number(r["yellow_score"]), as_number(f["carried_ball"]), as_number(f["duplicate_timestamp"]),
        number(f["missing_target_robot_slots"]), number(f["out_of_bounds_objects"]), as_number(F.col("live")),
    ]


def step_features(cfg: Config, slot: Column | None = None) -> Column:
    """The features of one frame for the ego in ``slot`` (``ego_slot`` by default); all zero if it isn't there."""
    slot = F.col("ego_slot") if slot is None else slot
    ego = F.get("target_team", slot)
    mates = F.filter(F.transform(F.sequence(F.lit(0), F.lit(cfg.team_size - 1)), lambda i: F.struct(i.alias("i"), F.get("target_team", i).alias("r"))), lambda s: s["i"] != slot)
    rivals = F.transform(F.sequence(F.lit(0), F.lit(cfg.team_size - 1)), lambda i: F.get("opponent_team", i))
    around = F.flatten(F.concat(F.transform(mates, lambda s: robot_features(ego, s["r"], cfg)), F.transform(rivals, lambda r: robot_features(ego, r, cfg))))
    whole = F.concat(F.array(*pose(ego, cfg)), ball_features(ego, F.col("ball"), cfg), one_hot_phase(F.col("phase")), F.array(*score_features()), around)
    return F.when(ego.isNotNull(), whole).otherwise(zeros(cfg.step_features))


def windows(frames: DataFrame, cfg: Config) -> DataFrame:
    """One row for each window and present ego: features, target, times and weight.

    ``frames`` come from ``stretch`` with ``phase`` joined.  A window of L frames starts every
    ``stride`` frames and needs a next frame; its ego is there in its last and in the next one.
    Sequences of at most L frames give none.
    """
    size, stride = cfg.window.length, cfg.window.stride
    keys = ("game_id", "phase", "sequence_index", "stretch_index")
    slots = F.sequence(F.lit(0), F.lit(cfg.team_size - 1))
    absent = zeros(cfg.step_features).cast("array<float>")

    def seen(slot: Column) -> Column:
        r = F.get("target_team", slot)
        ego = F.when(r.isNotNull(), F.struct(r["x"].alias("x"), r["y"].alias("y"), r["theta"].alias("theta"), r["role"].alias("role")))
        return F.struct(ego.alias("ego"), F.when(r.isNotNull(), step_features(cfg, slot).cast("array<float>")).alias("step"))

    coded = frames.select(*keys, "sequence_kind", "quality_score", "warnings", F.struct("seq_pos", "timestamp_s", F.transform(slots, seen).alias("egos")).alias("_f"))
    # A sequence has a bounded number of frames: it is put in order as one array and cut to windows there.
    whole = coded.groupBy(*keys).agg(F.first("sequence_kind").alias("sequence_kind"), F.first("quality_score").alias("quality_score"), F.first("warnings").alias("warnings"), F.array_sort(F.collect_list("_f")).alias("_f"))
    last = F.floor((F.size("_f") - size - 1) / stride).cast("int")

    def cut(at: Column, slot: Column) -> Column:
        held = F.slice("_f", at + 1, size)
        now, nxt = F.get(F.get("_f", at + (size - 1))["egos"], slot)["ego"], F.get(F.get("_f", at + size)["egos"], slot)["ego"]
        target = F.array(nxt["x"] - now["x"], nxt["y"] - now["y"], wrap_angle(nxt["theta"] - now["theta"])).cast("array<float>")
        made = F.struct(
            at.cast("bigint").alias("window_index"), slot.alias("ego_slot"), now["role"].alias("role_label"),
            F.flatten(F.transform(held, lambda f: F.coalesce(F.get(f["egos"], slot)["step"], absent))).alias("input"), target.alias("target"),
            F.get("_f", at)["timestamp_s"].alias("timestamp_start_s"), F.get("_f", at + (size - 1))["timestamp_s"].alias("timestamp_end_s"),
        )
        return F.when(now.isNotNull() & nxt.isNotNull(), made)

    # Starts and egos are listed first and one window is cut for each, so no row holds several.
    starts = F.transform(F.sequence(F.lit(0), last), lambda k: F.transform(slots, lambda slot: F.struct((k * stride).cast("int").alias("at"), slot.alias("slot"))))
    listed = whole.where(F.size("_f") > size).withColumn("_p", F.explode(F.flatten(starts)))
    made = listed.select(*keys, "sequence_kind", "quality_score", "warnings", cut(F.col("_p.at"), F.col("_p.slot")).alias("_w")).where("_w is not null")
    return made.select(
        "game_id", "phase", "sequence_index", "stretch_index", "_w.window_index", "_w.ego_slot", "_w.role_label", "_w.input", "_w.target",
        sample_weight(F.col("phase"), cfg).alias("sample_weight"), "sequence_kind", "_w.timestamp_start_s", "_w.timestamp_end_s", F.col("warnings").alias("quality_flags"), "quality_score",
    )


def sample_weight(phase: Column, cfg: Config) -> Column:
    return F.when(phase == "Elimination", cfg.split.elimination_weight).otherwise(1.0)


def cell(x: Column, half: float, cells: int) -> Column:
    """The grid cell of a coordinate; places beyond the edge count for the edge."""
    return F.floor(clamp((x + half) / (2 * half), 0.0, 0.9999) * cells).cast("int")


def occupancy(frames: DataFrame, cfg: Config) -> DataFrame:
    """``game_id, sequence_index, stretch_index, window_index, grid``: three planes, the newest frame brightest.

    Each window's lit cells are put in order, and the planes are written out around them.
    """
    size, stride = cfg.window.length, cfg.window.stride
    w, h = cfg.grid_width, cfg.grid_height
    plane = w * h
    place = lambda r, c: F.lit(c * plane) + cell(r["y"], cfg.half_width_m, h) * w + cell(r["x"], cfg.half_length_m, w)
    team = lambda c, k: F.transform(F.filter(c, lambda r: r.isNotNull()), lambda r: place(r, k))
    ball = F.when(F.col("ball").isNotNull(), F.array(place(F.col("ball"), 2))).otherwise(F.array().cast("array<int>"))
    cells = frames.select("game_id", "sequence_index", "stretch_index", "seq_pos", F.array_distinct(F.concat(team("target_team", 0), team("opponent_team", 1), ball)).alias("cells"))
    track = Window.partitionBy("game_id", "sequence_index", "stretch_index").orderBy("seq_pos")
    gathered = cells.withColumns({"_w": F.collect_list("cells").over(track.rowsBetween(-(size - 1), 0)), "_next": F.lead("seq_pos").over(track)})
    at = F.col("seq_pos") - (size - 1)
    kept = gathered.where((at >= 0) & (at % stride == 0) & F.col("_next").isNotNull()).withColumn("window_index", at)
    keys = ["game_id", "sequence_index", "stretch_index", "window_index"]
    # From the newest frame back, each frame adds the cells that no newer one has lit.
    bright = lambda c, n: F.transform(c, lambda x: F.struct(x.alias("cell"), (n / F.lit(float(size))).alias("v")))
    none = F.struct(F.array().cast("array<int>").alias("seen"), F.array().cast("array<struct<cell:int,v:double>>").alias("lit"), F.lit(size).alias("n"))
    step = lambda a, c: F.struct(
        F.array_union(a["seen"], c).alias("seen"), F.concat(a["lit"], bright(F.array_except(c, a["seen"]), a["n"])).alias("lit"), (a["n"] - 1).alias("n")
    )
    lit = kept.select(*keys, F.array_sort(F.aggregate(F.reverse("_w"), none, step, lambda a: a["lit"])).alias("_l"))
    gap = lambda to, since: F.array_repeat(F.lit(0.0), to - since - 1)
    before = lambda i: F.coalesce(F.get("_l", i - 1)["cell"], F.lit(-1))
    parts = F.flatten(F.transform("_l", lambda x, i: F.concat(gap(x["cell"], before(i)), F.array(x["v"]))))
    rest = gap(F.lit(3 * plane), before(F.size("_l")))
    return lit.select(*keys, F.concat(parts, rest).cast("array<float>").alias("grid"))
