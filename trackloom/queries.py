"""Registered queries over the given tables: one or more for each operator, with SQL beside them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import Config
from .functions.geometry import one_hot_phase, role_code, wrap_angle
from .operators import audit, augment, clean, dynamics, frames as fr, ingest, resample, review, samples, scans, sequences, splits, tracking
from .plans import pipelines
from .schemas import BALL, FLAGS, REFEREE, ROBOT
from .scratch import scratch_path
from .sources import adapters
from .sources.adapters import TICKS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

E = """e AS (
  SELECT CAST(user_id AS VARCHAR) AS game_id, user_id AS u, event_id AS n, event_type AS src, epoch(ts) AS t,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, value FROM events)"""
RAW = E + """, raw AS (
  SELECT game_id, u, n, src, t, k,
    CASE WHEN NOT (src = 'error' AND k < 20) THEN value % 9.0::DOUBLE - 4.5::DOUBLE END AS bx,
    CASE WHEN NOT (src = 'error' AND k < 20) THEN k / 99.0::DOUBLE * 6 - 3 END AS b_y,
    CASE WHEN NOT (src = 'error' AND k < 20) THEN k / 99.0::DOUBLE END AS bv,
    CAST((n * 7919) % 9000 AS DOUBLE) / 1000.0::DOUBLE - 4.5::DOUBLE AS rx, CAST((n * 104729) % 6000 AS DOUBLE) / 1000.0::DOUBLE - 3 AS ry,
    k / 99.0::DOUBLE * 6 - 3 AS th, k / 99.0::DOUBLE AS rv,
    CAST((n * 1299721) % 9000 AS DOUBLE) / 1000.0::DOUBLE - 4.5::DOUBLE AS ox, CAST((n * 15485863) % 6000 AS DOUBLE) / 1000.0::DOUBLE - 3 AS oy,
    -(k / 99.0::DOUBLE * 6 - 3) AS oth, 1.0::DOUBLE - k / 99.0::DOUBLE AS ov,
    row_number() OVER (PARTITION BY game_id ORDER BY t, n) - 1 AS pos
  FROM e)"""
FRAMES = RAW + """, fin AS (
  SELECT *, CASE WHEN abs(bx) <= 4.7 AND abs(b_y) <= 3.2 THEN bx END AS x, CASE WHEN abs(bx) <= 4.7 AND abs(b_y) <= 3.2 THEN b_y END AS y,
    CASE WHEN bx IS NOT NULL AND NOT (abs(bx) <= 4.7 AND abs(b_y) <= 3.2) THEN 1 ELSE 0 END AS oob
  FROM raw), nearf AS (
  SELECT *, coalesce(least(sqrt((rx - x) * (rx - x) + (ry - y) * (ry - y)), sqrt((ox - x) * (ox - x) + (oy - y) * (oy - y))) <= 4.0, false) AS nb
  FROM fin), isl AS (
  SELECT *, sum(CASE WHEN nb THEN 0 ELSE 1 END) OVER (PARTITION BY game_id ORDER BY pos) AS i FROM nearf), runs AS (
  SELECT *, sum(CASE WHEN nb THEN 1 ELSE 0 END) OVER (PARTITION BY game_id, i ORDER BY pos) AS run FROM isl), fr AS (
  SELECT *, run >= 3 AS carried, u % 4 IN (2, 3) AS live,
    coalesce(abs(t - lag(t) OVER (PARTITION BY game_id ORDER BY pos)) <= 2.220446049250313e-16, false) AS dup
  FROM runs)"""
SEGMENTS = FRAMES + """, brk AS (
  SELECT *, CASE WHEN lag(pos) OVER w IS NULL OR t - lag(t) OVER w > 86400 OR x IS NULL OR lag(x) OVER w IS NULL
      OR coalesce(sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y - lag(y) OVER w) * (y - lag(y) OVER w)) > 12.0, false)
      OR carried <> lag(carried) OVER w OR live <> lag(live) OVER w THEN 1 ELSE 0 END AS s
  FROM fr WINDOW w AS (PARTITION BY game_id ORDER BY pos)), seg AS (
  SELECT *, sum(s) OVER (PARTITION BY game_id ORDER BY pos) AS segment FROM brk), stats AS (
  SELECT game_id, segment, count(*) AS frame_count, min(pos) AS first_pos, arg_min(n, pos) AS start_frame, arg_max(n, pos) AS end_frame,
    arg_min(t, pos) AS start_time_s, arg_max(t, pos) AS end_time_s, count(*) FILTER (WHERE carried) AS carried,
    avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END) AS no_ball, avg(CASE WHEN dup THEN 1.0 ELSE 0.0 END) AS dups, avg(CASE WHEN live THEN 1.0 ELSE 0.0 END) AS lv
  FROM seg GROUP BY game_id, segment), seqs AS (
  SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY first_pos) - 1 AS sequence_index,
    CASE WHEN carried > frame_count // 3 THEN 'OpenPlay' ELSE 'Unknown' END AS sequence_kind,
    greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.45::DOUBLE + (1 - no_ball) * 0.20::DOUBLE + (1 - dups) * 0.10::DOUBLE + (1 - 5.0::DOUBLE / 6) * 0.15::DOUBLE
      + 0.20::DOUBLE + lv * 0.10::DOUBLE + CASE WHEN carried > frame_count // 3 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END)) AS quality_score
  FROM stats WHERE frame_count BETWEEN 5 AND 12)"""
PLAYED = SEGMENTS + """, played AS (
  SELECT g.*, q.sequence_index, q.frame_count AS seq_n, row_number() OVER (PARTITION BY g.game_id, q.sequence_index ORDER BY g.pos) - 1 AS sp
  FROM seg g JOIN seqs q ON g.game_id = q.game_id AND g.segment = q.segment)"""
LINES = """l AS (
  SELECT CAST(o_custkey AS VARCHAR) AS game_id, l_orderkey AS n, epoch(o_orderdate) AS t, l_linestatus AS side,
    l_quantity / 50 * 9 - 4.5::DOUBLE AS x, l_tax / 0.08::DOUBLE * 6 - 3 AS y, l_discount * 10 AS v, CAST(l_linenumber AS BIGINT) AS raw_id,
    row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS slot
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey), r AS (SELECT * FROM l WHERE slot <= 6), o AS (
  SELECT game_id, n, t, row_number() OVER (PARTITION BY game_id ORDER BY t, n) - 1 AS pos FROM (SELECT DISTINCT game_id, n, t FROM l))"""
_USERS = "(SELECT count(DISTINCT user_id) FROM events)"
VERDICTS = f"""v AS (
  SELECT CAST(doc_id % {_USERS} AS VARCHAR) AS game_id, doc_id // {_USERS} AS sequence_index,
    CASE WHEN toxic = 1 THEN 'NeedsAttention' WHEN quality = 0 THEN 'Drop' ELSE 'Keep' END AS verdict, 'doc ' || CAST(doc_id AS VARCHAR) AS note
  FROM labels)"""


#: Ticks of a running clock and the last frame strictly before each, over ``{0}``; every sum runs row by row.
RESAMPLED = """, gaps AS (SELECT game_id, pos, t, t - lag(t) OVER (PARTITION BY game_id ORDER BY pos) AS dd FROM {0}), facts AS (
  SELECT game_id, count(*) AS c, list_reduce(list(dd ORDER BY pos) FILTER (WHERE dd > 0), lambda a, x: a + x) / count(*) FILTER (WHERE dd > 0) AS step,
    max(dd) FILTER (WHERE dd > 0) - min(dd) FILTER (WHERE dd > 0) AS spread, arg_min(t, pos) AS t0, arg_max(t, pos) AS t1, min(pos) AS p0 FROM gaps GROUP BY game_id), uneven AS (
  SELECT * FROM facts WHERE c >= 3 AND step > 0 AND spread > 0.25 * step), clock AS (
  SELECT game_id, CAST(0 AS BIGINT) AS k, t0 AS tk, step, t1, p0 FROM uneven UNION ALL SELECT game_id, k + 1, tk + step, step, t1, p0 FROM clock WHERE tk + step <= t1), known AS (
  SELECT game_id, t, max(pos) AS pos FROM {0} GROUP BY game_id, t), picked AS (
  SELECT clock.game_id, clock.k, coalesce(known.pos, clock.p0) AS pos FROM clock ASOF LEFT JOIN known ON clock.game_id = known.game_id AND clock.tk > known.t), rs AS (
  SELECT f.* REPLACE (picked.k AS pos) FROM picked JOIN {0} f ON f.game_id = picked.game_id AND f.pos = picked.pos
  UNION ALL SELECT * FROM {0} WHERE game_id NOT IN (SELECT game_id FROM uneven))"""
#: ``win`` of the standard pipeline: resampled frames in live play, segmented and windowed.
_BEFORE = "RECURSIVE " + FRAMES.replace(", fr AS (", ", fr0 AS (") + RESAMPLED.format("fr0") + ", fr AS (SELECT * FROM rs WHERE oob = 0 AND live)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(c, name: str):
    return (F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)).alias(name)


def _ticks(spark: SparkSession, d: str) -> DataFrame:
    return adapters.events_frames(spark, d)


def _segmented(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    seg = sequences.segment(_ticks(spark, d), TICKS)
    return seg, sequences.summarise(seg, TICKS)


def _played(spark: SparkSession, d: str) -> DataFrame:
    seg, seqs = _segmented(spark, d)
    return sequences.frames_of(seg, seqs).join(adapters.events_games(spark, d).select("game_id", "phase"), "game_id")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Order frames with target (yellow) and opponent (blue) slots."""
    raw = ingest.order_frames(adapters.lines_raw(spark, d))
    pad = lambda c: F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.get(c, i))
    return raw.withColumns({"target_team": pad("yellow"), "opponent_team": pad("blue")})


def _slot(c: str = "target_team"):
    return F.get(c, F.lit(0))


@query(f"WITH {E} SELECT game_id, n AS frame_number, t AS timestamp_s FROM e WHERE src = 'click'")
def q_source_filter(spark, d):
    return ingest.source_filter(adapters.events_raw(spark, d), "click").select("game_id", "frame_number", "timestamp_s")


def _coarse(spark, d):
    raw = adapters.events_raw(spark, d)
    return raw.withColumns({"frame_number": F.floor(F.col("ball.visibility") * 2).cast("bigint"), "timestamp_s": F.floor(F.col("timestamp_s") / 400000).cast("double")})


_COARSE = RAW + """, c AS (SELECT game_id, n, src, CAST(floor(bv * 2) AS BIGINT) AS f, floor(t / 400000) AS t2 FROM raw), d AS (
  SELECT *, coalesce(f IS NOT DISTINCT FROM lag(f) OVER w AND t2 = lag(t2) OVER w AND src = lag(src) OVER w AND lag(n) OVER w IS NOT NULL, false) AS rep
  FROM c WINDOW w AS (PARTITION BY game_id ORDER BY n))"""


@query(f"WITH {_COARSE} SELECT game_id, n AS msg_pos, src AS source_name FROM d WHERE NOT rep")
def q_dedup_consecutive(spark, d):
    return ingest.drop_consecutive_duplicates(_coarse(spark, d)).select("game_id", "msg_pos", "source_name")


@query(f"""WITH {_COARSE}, s AS (SELECT game_id, src, count(*) AS seen, count(*) FILTER (WHERE rep) AS reps, count(*) FILTER (WHERE NOT rep) AS used FROM d GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY used DESC, src DESC) AS rk FROM s)
SELECT game_id, CAST(sum(seen) AS BIGINT) AS tracker_frames_seen, CAST(sum(reps) AS BIGINT) AS duplicate_frames, string_agg(src, ',' ORDER BY src) AS sources,
  max(CASE WHEN rk = 1 THEN src END) AS tracker_source FROM k GROUP BY game_id""")
def q_modal_source(spark, d):
    found = audit.message_audit(_coarse(spark, d))
    return found.select("game_id", "tracker_frames_seen", "duplicate_frames", F.concat_ws(",", "distinct_tracker_sources").alias("sources"), "tracker_source")


@query(f"""WITH {RAW} SELECT game_id, n AS frame_number, round(rx, 4) AS blue_x, round(oy, 4) AS yellow_y, round(bx, 4) AS ball_x, CAST(1 AS BIGINT) AS n_blue, 1.0::DOUBLE AS visibility FROM raw""")
def q_tracker_frames(spark, d):
    raw = adapters.events_raw(spark, d)
    seen = lambda r, t: F.struct(F.lit(t).alias("team"), r["raw_id"].alias("raw_id"), r["x"].alias("x"), r["y"].alias("y"), r["theta"].alias("theta"), F.lit(None).cast("double").alias("vx"), F.lit(None).cast("double").alias("vy"), F.lit(None).cast("double").alias("omega"), F.lit(None).cast("double").alias("visibility"))
    mine, theirs, b = F.get("blue", F.lit(0)), F.get("yellow", F.lit(0)), F.col("ball")
    balls = F.when(b.isNotNull(), F.array(F.struct(*[b[c].alias(c) for c in ("x", "y", "z", "vx", "vy", "visibility")]))).otherwise(F.array())
    packets = raw.withColumns({"robots": F.array(seen(mine, 2), seen(theirs, 1), seen(mine, 0)), "balls": balls})
    out = ingest.frames_from_tracker(packets)
    mine, theirs = F.get("blue", F.lit(0)), F.get("yellow", F.lit(0))
    return out.select("game_id", "frame_number", F.round(mine["x"], 4).alias("blue_x"), F.round(theirs["y"], 4).alias("yellow_y"), F.round("ball.x", 4).alias("ball_x"), F.size("blue").cast("bigint").alias("n_blue"), mine["visibility"].alias("visibility"))


@query(f"""WITH {E}, m AS (SELECT game_id, arg_max(k, n) AS k FROM e GROUP BY game_id)
SELECT game_id, CAST(k AS INTEGER) % 4 AS match_type, CAST(k AS INTEGER) AS command,
  CASE CAST(k AS INTEGER) % 4 WHEN 1 THEN 'Group' WHEN 2 THEN 'Elimination' WHEN 3 THEN 'Friendly' ELSE 'Unknown' END AS phase,
  CASE WHEN CAST(k AS INTEGER) % 3 = 0 THEN 'Yellow' WHEN CAST(k AS INTEGER) % 3 = 1 THEN 'Blue' END AS target_color FROM m""")
def q_last_value_broadcast(spark, d):
    e = adapters.read(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    team = lambda r: F.when(F.col("k") % 3 == r, "home").otherwise("away")
    messages = e.select(F.col("user_id").cast("string").alias("game_id"), F.col("event_id").alias("msg_pos"), (F.col("k") % 4).alias("match_type"), F.col("k").alias("command"), team(0).alias("yellow_name"), team(1).alias("blue_name"))
    last = ingest.resolve_target_color(ingest.last_referee(messages), "home")
    return last.select("game_id", "referee.match_type", "referee.command", "phase", "target_color")


@query(f"""WITH {FRAMES}, d AS (SELECT game_id, t - lag(t) OVER (PARTITION BY game_id ORDER BY pos) AS d FROM fr), rate AS (
SELECT game_id, coalesce(1 / avg(d) FILTER (WHERE d > 0), 0.0) AS hz FROM d GROUP BY game_id)
SELECT f.game_id, count(*) AS tracker_frames_used, CAST(sum(oob) AS BIGINT) AS out_of_bounds_objects, count(*) FILTER (WHERE x IS NULL) AS missing_ball_frames,
  CAST(0 AS BIGINT) AS suspicious_identity_swaps, round(max(t) - min(t), 3) AS duration_s, round(max(hz) * 1e6, 6) AS sample_rate_uhz
FROM fr f JOIN rate ON f.game_id = rate.game_id GROUP BY f.game_id""")
def q_audit(spark, d):
    a = audit.frame_audit(_ticks(spark, d))
    return a.select("game_id", "tracker_frames_used", "out_of_bounds_objects", "missing_ball_frames", "suspicious_identity_swaps", F.round("duration_s", 3).alias("duration_s"), F.round(F.col("sample_rate_hz") * 1e6, 6).alias("sample_rate_uhz"))


@query(f"""WITH {_COARSE}, m AS (SELECT game_id, count(*) FILTER (WHERE rep) AS dups FROM d GROUP BY game_id), b AS (
SELECT game_id, count(*) FILTER (WHERE bx IS NULL) AS lost FROM raw GROUP BY game_id)
SELECT m.game_id, concat_ws('; ', CASE WHEN dups > 0 THEN 'dropped ' || dups || ' duplicate tracker frames' END, CASE WHEN lost > 0 THEN lost || ' frames missing a primary ball' END) AS notes
FROM m JOIN b ON m.game_id = b.game_id""")
def q_audit_notes(spark, d):
    lost = adapters.events_raw(spark, d).groupBy("game_id").agg(F.count_if(F.col("ball").isNull()).alias("missing_ball_frames"))
    a = audit.message_audit(_coarse(spark, d)).join(lost, "game_id").withColumn("suspicious_identity_swaps", F.lit(0))
    return audit.with_notes(a).select("game_id", F.concat_ws("; ", "notes").alias("notes"))


@query("""WITH g AS (SELECT DISTINCT user_id AS i FROM events) SELECT CAST(i AS VARCHAR) AS game_id, 'b' || i AS target_team, 'y' || i AS opponent_team, i % 3 AS target_score, i % 5 AS opponent_score FROM g""")
def q_metadata(spark, d):
    return audit.metadata(adapters.events_games(spark, d)).select("game_id", "target_team", "opponent_team", "target_score", "opponent_score")


_DYN = FRAMES + """, w AS (
  SELECT *, lead(t) OVER w - lag(t) OVER w AS dt, lag(x) OVER w AS px, lead(x) OVER w AS nx, lag(rx) OVER w AS prx, lead(rx) OVER w AS nrx, lag(th) OVER w AS pth, lead(th) OVER w AS nth
  FROM fr WINDOW w AS (PARTITION BY game_id ORDER BY pos)), v AS (
  SELECT *, CASE WHEN x IS NULL THEN NULL WHEN dt > 0 AND px IS NOT NULL AND nx IS NOT NULL THEN greatest(-4.0::DOUBLE, least(4.0::DOUBLE, (nx - px) / (dt / 86400))) ELSE 0.0 END AS bvx,
    CASE WHEN dt > 0 THEN greatest(-4.0::DOUBLE, least(4.0::DOUBLE, (nrx - prx) / (dt / 86400))) ELSE 0.0 END AS rvx,
    CASE WHEN dt > 0 THEN greatest(-12.0::DOUBLE, least(12.0::DOUBLE, (nth - pth) / (dt / 86400))) ELSE 0.0 END AS om FROM w), a AS (
  SELECT *, CASE WHEN x IS NULL THEN NULL WHEN dt > 0 AND px IS NOT NULL AND nx IS NOT NULL THEN greatest(-3.0::DOUBLE, least(3.0::DOUBLE, (bvx - lag(bvx) OVER w) / (dt / 86400 / 2))) ELSE 0.0 END AS bax,
    CASE WHEN dt > 0 THEN greatest(-3.0::DOUBLE, least(3.0::DOUBLE, (rvx - lag(rvx) OVER w) / (dt / 86400 / 2))) ELSE 0.0 END AS rax FROM v WINDOW w AS (PARTITION BY game_id ORDER BY pos))"""


def _days(spark, d):
    return dynamics.estimate_dynamics(_ticks(spark, d).withColumn("timestamp_s", F.col("timestamp_s") / 86400), TICKS)


@query(f"WITH {_DYN} SELECT game_id, n AS frame_number, round(bvx, 5) + 0.0 AS ball_vx, round(rvx, 5) + 0.0 AS robot_vx, round(om, 5) + 0.0 AS robot_omega FROM a")
def q_velocity(spark, d):
    return _days(spark, d).select("game_id", "frame_number", (F.round("ball.vx", 5) + 0.0).alias("ball_vx"), (F.round(_slot()["vx"], 5) + 0.0).alias("robot_vx"), (F.round(_slot()["omega"], 5) + 0.0).alias("robot_omega"))


@query(f"WITH {_DYN} SELECT game_id, n AS frame_number, round(bax, 4) + 0.0 AS ball_ax, round(rax, 4) + 0.0 AS robot_ax FROM a")
def q_acceleration(spark, d):
    return _days(spark, d).select("game_id", "frame_number", (F.round("ball.ax", 4) + 0.0).alias("ball_ax"), (F.round(_slot()["ax"], 4) + 0.0).alias("robot_ax"))


@query(f"""WITH {RAW} SELECT game_id, n AS frame_number, CAST((bx IS NOT NULL AND NOT (abs(bx) <= 3.2 AND abs(b_y) <= 2.2)) AS INT)::BIGINT + CAST(NOT (abs(rx) <= 3.2 AND abs(ry) <= 2.2) AS INT)::BIGINT
  + CAST(NOT (abs(ox) <= 3.2 AND abs(oy) <= 2.2) AS INT)::BIGINT AS out_of_bounds_objects, abs(rx) <= 3.2 AND abs(ry) <= 2.2 AS robot_inside, coalesce(abs(bx) <= 3.2 AND abs(b_y) <= 2.2, false) AS ball_inside FROM raw""")
def q_bounds_null(spark, d):
    teams = adapters.events_tracked(spark, d).withColumns({"target_team": F.col("blue"), "opponent_team": F.col("yellow")})
    out = fr.apply_bounds(teams, replace(TICKS, half_length_m=3.0, half_width_m=2.0))
    return out.select("game_id", "frame_number", "out_of_bounds_objects", _slot().isNotNull().alias("robot_inside"), F.col("ball").isNotNull().alias("ball_inside"))


@query(f"WITH {FRAMES} SELECT game_id, n AS frame_number, carried AS carried_ball, oob::BIGINT AS oob, live FROM fr")
def q_possession_runs(spark, d):
    return _ticks(spark, d).select("game_id", "frame_number", "flags.carried_ball", F.col("flags.out_of_bounds_objects").alias("oob"), "live")


@query(f"WITH {LINES} SELECT game_id, n AS frame_number, coalesce(t = lag(t) OVER (PARTITION BY game_id ORDER BY pos), false) AS duplicate_timestamp FROM o")
def q_dup_ts_flag(spark, d):
    return ingest.order_frames(adapters.lines_raw(spark, d)).select("game_id", "frame_number", fr.duplicate_timestamp().alias("duplicate_timestamp"))


@query(f"WITH {LINES}, x AS (SELECT *, lag(t) OVER (PARTITION BY game_id ORDER BY pos) AS p FROM o) SELECT game_id, n AS frame_number FROM x WHERE p IS NULL OR t <> p")
def q_drop_dup_ts(spark, d):
    return clean.drop_duplicate_timestamps(ingest.order_frames(adapters.lines_raw(spark, d))).select("game_id", "frame_number")


@query(f"""WITH {_DYN} SELECT game_id, n AS frame_number, coalesce(abs(bvx) >= 0.5, false) OR coalesce(abs(rvx) >= 0.5, false) AS moving FROM a""")
def q_motion_live(spark, d):
    live = replace(TICKS.live, ball_speed_m_s=0.5, robot_speed_m_s=0.5)
    still = lambda r: r.withField("vy", F.lit(0.0))
    f = _days(spark, d).withColumns({"ball": F.when(F.col("ball").isNotNull(), still(F.col("ball"))), "target_team": F.transform("target_team", lambda r: F.when(r.isNotNull(), still(r))), "opponent_team": F.array().cast(f"array<{ROBOT}>")})
    return f.select("game_id", "frame_number", fr.motion_live(replace(TICKS, live=live)).alias("moving"))


@query(f"WITH {FRAMES} SELECT game_id, n AS frame_number FROM fr WHERE oob = 0 AND live")
def q_live_filter(spark, d):
    return fr.live_only(_ticks(spark, d), TICKS).select("game_id", "frame_number")


@query(f"""WITH {FRAMES} SELECT game_id, n AS frame_number, round(CASE WHEN u % 2 = 0 THEN -x ELSE x END, 6) + 0.0 AS ball_x, round(CASE WHEN u % 2 = 0 THEN -rx ELSE rx END, 6) + 0.0 AS robot_x,
  round(CASE WHEN u % 2 = 0 THEN CASE WHEN pi() - th > pi() THEN pi() - th - 2 * pi() ELSE pi() - th END ELSE th END, 6) + 0.0 AS theta FROM fr""")
def q_flip_x(spark, d):
    return fr.canonicalise(_ticks(spark, d)).select("game_id", "frame_number", r6("ball.x", "ball_x"), r6(_slot()["x"], "robot_x"), r6(_slot()["theta"], "theta"))


@query("SELECT event_id, round(CASE WHEN v > pi() THEN v - 2 * pi() * ceil((v - pi()) / (2 * pi())) WHEN v < -pi() THEN v + 2 * pi() * ceil((-pi() - v) / (2 * pi())) ELSE v END, 6) + 0.0 AS angle FROM (SELECT event_id, value - 20 AS v FROM events)")
def q_wrap_angle(spark, d):
    return adapters.read(spark, d, "events").select("event_id", r6(wrap_angle(F.col("value") - 20), "angle"))


@query(f"""WITH RECURSIVE {RAW}, s AS (SELECT *, t - lag(t) OVER (PARTITION BY game_id ORDER BY pos) AS dd FROM raw), st AS (
SELECT game_id, count(*) AS c, avg(dd) FILTER (WHERE dd > 0) AS m0, max(dd) FILTER (WHERE dd > 0) - min(dd) FILTER (WHERE dd > 0) AS spread FROM s GROUP BY game_id)
SELECT game_id, c >= 3 AND m0 > 0 AND spread > 0.25 * m0 AS uneven, c AS n_before FROM st""")
def q_resample_needed(spark, d):
    f = _ticks(spark, d)
    moved = resample.resample(f).groupBy("game_id").agg(F.count("*").alias("n_after"), F.max("frame_number").alias("last"))
    before = f.groupBy("game_id").agg(F.count("*").alias("n_before"), F.max_by("frame_number", "frame_pos").alias("final"))
    return before.join(moved, "game_id").select("game_id", (F.col("last") != F.col("final")).alias("uneven"), "n_before")


@query(f"WITH RECURSIVE {RAW}{RESAMPLED.format('raw')} SELECT game_id, pos AS frame_pos, n AS frame_number, t AS timestamp_s FROM rs")
def q_resample_asof(spark, d):
    return resample.resample(_ticks(spark, d)).select("game_id", "frame_pos", "frame_number", "timestamp_s")


@query(f"WITH {LINES} SELECT game_id, n AS frame_number, CAST(count(*) FILTER (WHERE side = 'O' AND v >= 0.5) AS BIGINT) AS target_seen, CAST(count(*) FILTER (WHERE side = 'F' AND v >= 0.5) AS BIGINT) AS opponent_seen FROM r GROUP BY 1, 2")
def q_low_visibility(spark, d):
    out = clean.null_low_visibility(_lines(spark, d), TICKS)
    return out.select("game_id", "frame_number", fr.count_present(F.col("target_team")).alias("target_seen"), fr.count_present(F.col("opponent_team")).alias("opponent_seen"))


@query(f"WITH {FRAMES} SELECT game_id, n AS frame_number, CASE WHEN bv >= 0.3 THEN round(x, 6) END AS ball_x FROM fr")
def q_low_ball_visibility(spark, d):
    return clean.null_low_ball_visibility(_ticks(spark, d), TICKS).select("game_id", "frame_number", F.round("ball.x", 6).alias("ball_x"))


@query(f"WITH {LINES} SELECT game_id, n AS frame_number FROM r GROUP BY 1, 2 HAVING count(*) FILTER (WHERE side = 'O') >= 2 AND count(*) FILTER (WHERE side = 'F') >= 1")
def q_team_completeness(spark, d):
    cfg = replace(TICKS, clean=replace(TICKS.clean, min_target_robots=2, min_opponent_robots=1))
    return clean.complete_teams(_lines(spark, d), cfg).select("game_id", "frame_number")


_JUMP = """sqrt(({0} - lag({0}) OVER w) * ({0} - lag({0}) OVER w) + ({1} - lag({1}) OVER w) * ({1} - lag({1}) OVER w))"""


@query(f"""WITH {FRAMES}, j AS (SELECT *, t - lag(t) OVER w AS dt, {_JUMP.format('rx', 'ry')} AS jr, {_JUMP.format('ox', 'oy')} AS jo, {_JUMP.format('x', 'y')} AS jb FROM fr WINDOW w AS (PARTITION BY game_id ORDER BY pos)),
k AS (SELECT *, 0.000004::DOUBLE * greatest(dt / 0.033::DOUBLE, 1.0::DOUBLE) AS lim FROM j)
SELECT game_id, n AS frame_number FROM k WHERE NOT (coalesce(dt > 0, false) AND (coalesce(jr > lim, false) OR coalesce(jo > lim, false) OR coalesce(jb > 2 * lim, false)))""")
def q_teleport(spark, d):
    return clean.drop_teleports(_ticks(spark, d), TICKS).select("game_id", "frame_number")


_OFF = "power({0} - (lag({0}) OVER w + sh * (lead({0}) OVER w - lag({0}) OVER w)), 2)"


@query(f"""WITH {FRAMES}, a AS (SELECT *, t - lag(t) OVER w AS d1, lead(t) OVER w - t AS d2 FROM fr WINDOW w AS (PARTITION BY game_id ORDER BY pos)), b AS (SELECT *, d1 / nullif(d1 + d2, 0) AS sh FROM a),
c AS (SELECT *, {_OFF.format('rx')} + {_OFF.format('ry')} AS e1, {_OFF.format('ox')} + {_OFF.format('oy')} AS e2 FROM b WINDOW w AS (PARTITION BY game_id ORDER BY pos))
SELECT game_id, n AS frame_number FROM c WHERE NOT (coalesce(d1 > 0 AND d2 > 0, false) AND (coalesce(e1 > 9.0, false) OR coalesce(e2 > 9.0, false)))""")
def q_spike(spark, d):
    return clean.drop_spikes(_ticks(spark, d), TICKS).select("game_id", "frame_number")


@query(f"""WITH {FRAMES}, m AS (SELECT *, count(*) OVER w3 AS c, count(x) OVER w3 AS cx, median(x) OVER w3 AS mx, median(rx) OVER w3 AS mrx, median(oy) OVER w3 AS moy FROM fr
WINDOW w3 AS (PARTITION BY game_id ORDER BY pos ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
SELECT game_id, n AS frame_number, round(CASE WHEN x IS NOT NULL AND cx >= 3 THEN mx ELSE x END, 6) + 0.0 AS ball_x, round(CASE WHEN c >= 3 THEN mrx ELSE rx END, 6) + 0.0 AS robot_x, round(CASE WHEN c >= 3 THEN moy ELSE oy END, 6) + 0.0 AS rival_y FROM m""")
def q_median_smooth(spark, d):
    out = clean.smooth_positions(_ticks(spark, d), TICKS)
    return out.select("game_id", "frame_number", r6("ball.x", "ball_x"), r6(_slot()["x"], "robot_x"), r6(_slot("opponent_team")["y"], "rival_y"))


@query(f"WITH {SEGMENTS} SELECT game_id, n AS frame_number, CAST(segment AS BIGINT) AS segment FROM seg")
def q_segments(spark, d):
    return sequences.segment(_ticks(spark, d), TICKS).select("game_id", "frame_number", "segment")


@query(f"WITH {SEGMENTS} SELECT game_id, sequence_index, start_frame, end_frame, start_time_s, end_time_s, frame_count, carried, sequence_kind, round(quality_score, 6) AS quality_score FROM seqs")
def q_sequence_summary(spark, d):
    s = _segmented(spark, d)[1]
    return s.select("game_id", "sequence_index", "start_frame", "end_frame", "start_time_s", "end_time_s", "frame_count", "carried", "sequence_kind", F.round("quality_score", 6).alias("quality_score"))


@query(f"""WITH {SEGMENTS} SELECT game_id, start_frame, concat_ws(',', CASE WHEN no_ball > 0.1 THEN 'ball-missing' END, CASE WHEN dups > 0.03 THEN 'duplicate-timestamps' END, 'missing-robots', CASE WHEN lv < 0.8 THEN 'mixed-live-state' END) AS warnings FROM seqs""")
def q_warnings(spark, d):
    return _segmented(spark, d)[1].select("game_id", "start_frame", F.concat_ws(",", "warnings").alias("warnings"))


@query(f"WITH {SEGMENTS} SELECT game_id, start_frame, row_number() OVER (PARTITION BY game_id ORDER BY first_pos) - 1 AS sequence_index FROM seqs WHERE quality_score >= 0.9")
def q_quality_gate(spark, d):
    return sequences.quality_gate(_segmented(spark, d)[1], 0.9).select("game_id", "start_frame", "sequence_index")


@query(f"WITH {SEGMENTS}, {VERDICTS} SELECT s.game_id, s.sequence_index, coalesce(v.verdict, 'Unreviewed') AS verdict, coalesce(v.note, '') AS note FROM seqs s LEFT JOIN v ON s.game_id = v.game_id AND s.sequence_index = v.sequence_index")
def q_review_join(spark, d):
    return review.with_verdicts(_segmented(spark, d)[1], adapters.label_reviews(spark, d)).select("game_id", "sequence_index", "verdict", "note")


@query(f"""WITH {SEGMENTS}, {VERDICTS}, j AS (SELECT s.*, coalesce(v.verdict, 'Unreviewed') AS verdict FROM seqs s LEFT JOIN v ON s.game_id = v.game_id AND s.sequence_index = v.sequence_index),
f AS (SELECT game_id, min(sequence_index) AS fst FROM j WHERE verdict = 'Drop' GROUP BY game_id)
SELECT j.game_id, j.sequence_index, verdict = 'NeedsAttention' AS marked FROM j LEFT JOIN f ON j.game_id = f.game_id WHERE fst IS NULL OR j.sequence_index < fst""")
def q_review_drop_cascade(spark, d):
    out = sequences.apply_reviews(_segmented(spark, d)[1], adapters.label_reviews(spark, d))
    return out.select("game_id", "sequence_index", F.array_contains("warnings", "manual-needs-attention").alias("marked"))


@query(f"""WITH {SEGMENTS}, {VERDICTS} SELECT s.game_id, s.sequence_index FROM seqs s JOIN v ON s.game_id = v.game_id AND s.sequence_index = v.sequence_index WHERE verdict = 'Keep' AND contains(lower(sequence_kind || ' missing-robots ' || note), 'c 1')""")
def q_review_search(spark, d):
    found = review.with_verdicts(_segmented(spark, d)[1], adapters.label_reviews(spark, d))
    return review.search(found, "Keep", "C 1").select("game_id", "sequence_index")


@query(f"""WITH {VERDICTS} SELECT game_id, sequence_index, CASE WHEN sequence_index % 2 = 0 THEN 'Keep' ELSE verdict END AS verdict, CASE WHEN sequence_index % 2 = 0 THEN 'again' ELSE note END AS note FROM v""")
def q_review_upsert(spark, d):
    old = adapters.label_reviews(spark, d)
    even = old.where("sequence_index % 2 = 0")
    changes = even.withColumns({"verdict": F.lit("Drop"), "note": F.lit("first"), "position": F.lit(1)}).unionByName(even.withColumns({"verdict": F.lit("Keep"), "note": F.lit("again"), "position": F.lit(2)}))
    return review.upsert(old, changes)


@query(f"WITH {SEGMENTS} SELECT s.game_id, s.sequence_index, count(*) AS frames, CAST(sum(f.n) AS BIGINT) AS numbers FROM seqs s JOIN fr f ON f.game_id = s.game_id AND f.n BETWEEN s.start_frame AND s.end_frame GROUP BY 1, 2")
def q_frame_range(spark, d):
    found = review.frames_in_range(_ticks(spark, d), _segmented(spark, d)[1])
    return found.groupBy("game_id", "sequence_index").agg(F.count("*").alias("frames"), F.sum("frame_number").alias("numbers"))


@query(f"WITH {FRAMES} SELECT game_id, n AS frame_number, CAST(1 AS BIGINT) AS n_target, 0 AS slot, round(rx, 6) AS robot_x, x IS NOT NULL AS has_ball, carried AS carried_ball FROM fr")
def q_frame_payload(spark, d):
    p = review.frame_payload(_ticks(spark, d))
    one = F.get("target_team", F.lit(0))
    return p.select("game_id", "frame_number", F.size("target_team").cast("bigint").alias("n_target"), one["slot"].alias("slot"), F.round(one["x"], 6).alias("robot_x"), F.col("ball").isNotNull().alias("has_ball"), "flags.carried_ball")


@query(f"WITH {SEGMENTS} SELECT game_id, count(*) AS sequences, CAST(sum(frame_count) AS BIGINT) AS frames FROM seqs GROUP BY game_id")
def q_game_payload(spark, d):
    p = review.game_payload(adapters.events_games(spark, d), _segmented(spark, d)[1], adapters.label_reviews(spark, d)).where("sequences is not null")
    frames = F.aggregate("sequences", F.lit(0).cast("bigint"), lambda a, s: a + s["frame_count"])
    return p.select("game_id", F.size("sequences").cast("bigint").alias("sequences"), frames.alias("frames"))


@query(f"""WITH {SEGMENTS}, {VERDICTS} SELECT s.game_id, u % 2 = 0 AS blue_on_positive_half, row_number() OVER (PARTITION BY s.game_id ORDER BY s.sequence_index) - 1 AS place, s.sequence_index, start_frame, end_frame,
  start_time_s, end_time_s, frame_count, round(quality_score, 6) AS quality_score, sequence_kind, coalesce(verdict, 'Unreviewed') AS verdict, coalesce(note, '') AS note
FROM seqs s JOIN (SELECT DISTINCT game_id, u FROM e) g ON g.game_id = s.game_id LEFT JOIN v ON v.game_id = s.game_id AND v.sequence_index = s.sequence_index""")
def q_game_payload_rows(spark, d):
    """All that a game's payload says of its sequences, in the order of its list."""
    p = review.game_payload(adapters.events_games(spark, d), _segmented(spark, d)[1], adapters.label_reviews(spark, d))
    rows = p.select("game_id", F.col("referee.blue_team_on_positive_half").alias("blue_on_positive_half"), F.posexplode("sequences").alias("place", "s"))
    own = ("sequence_index", "start_frame", "end_frame", "start_time_s", "end_time_s", "frame_count", "sequence_kind", "verdict", "note")
    return rows.select("game_id", "blue_on_positive_half", F.col("place").cast("bigint").alias("place"), *[f"s.{c}" for c in own], F.round("s.quality_score", 6).alias("quality_score"))


@query(f"""WITH {FRAMES} SELECT f.game_id, f.n AS frame_number, round(x, 6) AS clean_x, round(bx, 6) AS raw_x, least(pos + 1, 11) AS trail FROM fr f""")
def q_compare_raw(spark, d):
    out = review.compare_with_raw(_ticks(spark, d), adapters.events_raw(spark, d))
    return out.select("game_id", "frame_number", F.round("ball.x", 6).alias("clean_x"), F.round("raw_ball.x", 6).alias("raw_x"), F.size("trail").cast("bigint").alias("trail"))


_WIN = PLAYED + """, win AS (
  SELECT *, lead(rx) OVER w AS nrx, lead(ry) OVER w AS nry, lead(th) OVER w AS nth, sp - 2 AS window_index, lag(t, 2) OVER w AS ts0
  FROM played WINDOW w AS (PARTITION BY game_id, sequence_index ORDER BY sp))"""
_PICK = "window_index >= 0 AND window_index % 2 = 0 AND nrx IS NOT NULL"


def _windows(spark, d):
    return samples.windows(samples.stretch(_played(spark, d), TICKS), TICKS)


@query(f"WITH {_WIN} SELECT game_id, sequence_index, window_index, ts0 AS timestamp_start_s, t AS timestamp_end_s, CAST({TICKS.sample_features} AS BIGINT) AS n_features FROM win WHERE {_PICK}")
def q_windows(spark, d):
    return _windows(spark, d).select("game_id", "sequence_index", "window_index", "timestamp_start_s", "timestamp_end_s", F.size("input").cast("bigint").alias("n_features"))


_AWAY = "sqrt(({0} - rx) * ({0} - rx) + ({1} - ry) * ({1} - ry)) / 9"
_TURN = "atan2({1} - ry, {0} - rx) - th"
_ZEROS = ", ".join(["0.0"] * 4)
#: All 183 entries of a step for the only robot of its team: pose, ball, phase, scores, five absent mates, one rival, five absent rivals.
_STEP = f"""[rx / 4.5, ry / 3, {_ZEROS}, sin(th), cos(th)]
  || CASE WHEN x IS NULL THEN list_transform(range(10), lambda i: 0.0) ELSE [(x - rx) / 4.5, (y - ry) / 3, {_ZEROS}, {_AWAY.format("x", "y")}, sin({_TURN.format("x", "y")}), cos({_TURN.format("x", "y")}), bv] END
  || [CAST(u % 4 = 1 AS INT), CAST(u % 4 = 2 AS INT), CAST(u % 4 = 3 AS INT), CAST(u % 4 = 0 AS INT), u % 3, u % 5, CAST(carried AS INT), CAST(dup AS INT), 5, oob, CAST(live AS INT)]::DOUBLE[]
  || list_transform(range(70), lambda i: 0.0)
  || [(ox - rx) / 4.5, (oy - ry) / 3, {_ZEROS}, sin(oth), cos(oth), {_AWAY.format("ox", "oy")}, sin({_TURN.format("ox", "oy")}), cos({_TURN.format("ox", "oy")}), ov, 0.0, 1.0]
  || list_transform(range(70), lambda i: 0.0)"""


@query(f"""WITH {_WIN}, step AS (SELECT game_id, sequence_index, sp, list_transform(CAST({_STEP} AS FLOAT[]), lambda v: v::DOUBLE) AS f FROM played), sums AS (
SELECT *, list_sum(f) AS plain, list_sum(list_transform(f, lambda v, i: v * i)) AS weighted, len(list_filter(f, lambda v: abs(v) > 1e-7)) AS filled FROM step)
SELECT w.game_id, w.sequence_index, w.window_index, CAST(sum(len(f)) AS BIGINT) AS n_features, round(sum(weighted + 183 * (s.sp - window_index) * plain), 2) + 0.0 AS weighted, CAST(sum(filled) AS BIGINT) AS n_not_zero
FROM win w JOIN sums s ON s.game_id = w.game_id AND s.sequence_index = w.sequence_index AND s.sp BETWEEN w.window_index AND w.window_index + 2 WHERE {_PICK} GROUP BY 1, 2, 3""")
def q_window_features(spark, d):
    at = lambda v, i: v.cast("double") * (i + 1)
    weighted = F.aggregate(F.transform("input", at), F.lit(0.0), lambda a, x: a + x)
    some = F.size(F.filter("input", lambda v: F.abs(v.cast("double")) > 1e-7)).cast("bigint")
    return _windows(spark, d).select("game_id", "sequence_index", "window_index", F.size("input").cast("bigint").alias("n_features"), (F.round(weighted, 2) + 0.0).alias("weighted"), some.alias("n_not_zero"))


@query(f"WITH {SEGMENTS} SELECT game_id, sequence_index, (frame_count - 4) // 2 + 1 AS windows FROM seqs WHERE frame_count >= 4")
def q_window_counts(spark, d):
    return _windows(spark, d).groupBy("game_id", "sequence_index").agg(F.count("*").alias("windows"))


@query(f"""WITH {_WIN} SELECT game_id, sequence_index, window_index, round(nrx - rx, 3) + 0.0 AS dx, round(nry - ry, 3) + 0.0 AS dy,
  round(CASE WHEN nth - th > pi() THEN nth - th - 2 * pi() WHEN nth - th < -pi() THEN nth - th + 2 * pi() ELSE nth - th END, 3) + 0.0 AS dtheta FROM win WHERE {_PICK}""")
def q_targets(spark, d):
    t = lambda k, n: (F.round(F.get("target", F.lit(k)).cast("double"), 3) + 0.0).alias(n)
    return _windows(spark, d).select("game_id", "sequence_index", "window_index", t(0, "dx"), t(1, "dy"), t(2, "dtheta"))


_STRETCH = replace(TICKS, augment=replace(TICKS.augment, stretch_factors=(0.5, 1.5)))


@query(f"""WITH {PLAYED}, m AS (SELECT DISTINCT game_id, sequence_index, seq_n, 1 AS k, greatest(2, CAST(round(seq_n * 0.5::DOUBLE) AS BIGINT)) AS m FROM played
UNION ALL SELECT DISTINCT game_id, sequence_index, seq_n, 2, greatest(2, CAST(round(seq_n * 1.5::DOUBLE) AS BIGINT)) FROM played),
g AS (SELECT game_id, sequence_index, k, m, seq_n, unnest(range(m)) AS i FROM m), s AS (SELECT *, least(CAST(floor(i / m::DOUBLE * seq_n) AS BIGINT), seq_n - 1) AS src FROM g)
SELECT s.game_id, s.sequence_index, s.k AS stretch_index, s.i AS seq_pos, p.n AS frame_number FROM s JOIN played p ON p.game_id = s.game_id AND p.sequence_index = s.sequence_index AND p.sp = s.src
UNION ALL SELECT game_id, sequence_index, 0, sp, n FROM played""")
def q_stretch(spark, d):
    return samples.stretch(_played(spark, d), _STRETCH).select("game_id", "sequence_index", "stretch_index", "seq_pos", "frame_number")


def _steps(spark, d):
    played = _played(spark, d).withColumn("ego_slot", F.lit(0))
    return played.withColumn("step", samples.step_features(TICKS))


@query(f"WITH {PLAYED} SELECT game_id, n AS frame_number, round(rx / 4.5::DOUBLE, 6) + 0.0 AS x, round(ry / 3, 6) + 0.0 AS y, round(sin(th), 6) + 0.0 AS sin_theta, round(cos(th), 6) + 0.0 AS cos_theta FROM played")
def q_pose(spark, d):
    at = lambda k, n: r6(F.get("step", F.lit(k)), n)
    return _steps(spark, d).select("game_id", "frame_number", at(0, "x"), at(1, "y"), at(6, "sin_theta"), at(7, "cos_theta"))


@query(f"""WITH {PLAYED} SELECT game_id, n AS frame_number, round(coalesce((x - rx) / 4.5::DOUBLE, 0), 6) + 0.0 AS ball_dx, round(coalesce(sqrt((x - rx) * (x - rx) + (y - ry) * (y - ry)) / 9, 0), 6) + 0.0 AS ball_distance,
  round(coalesce(sin(atan2(y - ry, x - rx) - th), 0), 6) + 0.0 AS ball_sin, round(coalesce(cos(atan2(y - ry, x - rx) - th), 0), 6) + 0.0 AS ball_cos,
  round((ox - rx) / 4.5::DOUBLE, 6) + 0.0 AS rival_dx, round(sin(atan2(oy - ry, ox - rx) - th), 6) + 0.0 AS rival_sin, round(ov, 6) + 0.0 AS rival_visibility, 1.0::DOUBLE AS rival_role FROM played""")
def q_relative_features(spark, d):
    at = lambda k, n: r6(F.get("step", F.lit(k)), n)
    return _steps(spark, d).select("game_id", "frame_number", at(8, "ball_dx"), at(14, "ball_distance"), at(15, "ball_sin"), at(16, "ball_cos"), at(99, "rival_dx"), at(108, "rival_sin"), at(110, "rival_visibility"), at(112, "rival_role"))


@query(f"""WITH {PLAYED} SELECT game_id, n AS frame_number, CAST(u % 3 AS DOUBLE) AS blue_score, CAST(u % 5 AS DOUBLE) AS yellow_score, CAST(carried AS INT)::DOUBLE AS carried, CAST(dup AS INT)::DOUBLE AS dup, 5.0::DOUBLE AS missing, oob::DOUBLE AS oob, CAST(live AS INT)::DOUBLE AS live FROM played""")
def q_score_features(spark, d):
    at = lambda k, n: F.get("step", F.lit(k)).alias(n)
    return _steps(spark, d).select("game_id", "frame_number", *[at(22 + k, n) for k, n in enumerate(("blue_score", "yellow_score", "carried", "dup", "missing", "oob", "live"))])


@query("""WITH g AS (SELECT DISTINCT user_id % 4 AS i, user_id FROM events) SELECT CAST(user_id AS VARCHAR) AS game_id, CASE WHEN i = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS p_group, CASE WHEN i = 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS p_elimination,
CASE WHEN i = 3 THEN 1.0 ELSE 0.0 END::DOUBLE AS p_friendly, CASE WHEN i = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS p_unknown, CASE WHEN i = 2 THEN 1.5 ELSE 1.0 END::DOUBLE AS weight FROM g""")
def q_one_hot_weights(spark, d):
    g = adapters.events_games(spark, d)
    at = lambda k: F.get(one_hot_phase(F.col("phase")), F.lit(k))
    return g.select("game_id", at(0).alias("p_group"), at(1).alias("p_elimination"), at(2).alias("p_friendly"), at(3).alias("p_unknown"), samples.sample_weight(F.col("phase"), TICKS).alias("weight"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 0.0 WHEN 1 THEN 0.25 WHEN 2 THEN 0.5 WHEN 3 THEN 0.75 ELSE 1.0 END::DOUBLE AS code FROM labels")
def q_role(spark, d):
    names = F.array(*[F.lit(n) for n in ("Goalkeeper", "Defender", "Midfielder", "Forward", "Unknown")])
    return adapters.read(spark, d, "labels").select("doc_id", role_code(F.get(names, (F.col("doc_id") % 5).cast("int"))).alias("code"))


_GRID = replace(TICKS, grid_width=8, grid_height=6)


@query(f"""WITH {_WIN}, pick AS (SELECT game_id, sequence_index, window_index FROM win WHERE {_PICK}), obj AS (
SELECT p.game_id, p.sequence_index, p.window_index, (w.sp - p.window_index + 1) / 3.0::DOUBLE AS v, o.c, o.x AS x, o.y AS y FROM pick p JOIN win w ON p.game_id = w.game_id AND p.sequence_index = w.sequence_index AND w.sp BETWEEN p.window_index AND p.window_index + 2,
LATERAL (SELECT 0 AS c, w.rx AS x, w.ry AS y UNION ALL SELECT 1, w.ox, w.oy UNION ALL SELECT 2, w.x, w.y) o WHERE o.x IS NOT NULL),
cells AS (SELECT game_id, sequence_index, window_index, c * 48 + CAST(floor(least(0.9999::DOUBLE, greatest(0.0::DOUBLE, (y + 3) / 6)) * 6) AS BIGINT) * 8 + CAST(floor(least(0.9999::DOUBLE, greatest(0.0::DOUBLE, (x + 4.5::DOUBLE) / 9)) * 8) AS BIGINT) AS cell, max(v) AS v FROM obj GROUP BY ALL)
SELECT game_id, sequence_index, window_index, cell, round(v, 5) AS v FROM cells""")
def q_occupancy_grid(spark, d):
    g = samples.occupancy(samples.stretch(_played(spark, d), _GRID), _GRID)
    return g.select("game_id", "sequence_index", "window_index", F.posexplode("grid").alias("cell", "v")).where("v > 0").select("game_id", "sequence_index", "window_index", F.col("cell").cast("bigint").alias("cell"), F.round(F.col("v").cast("double"), 5).alias("v"))


def _vectors(spark, d):
    return adapters.read(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<float>").alias("input"))


#: Fixed values, as published test vectors have them for two robots a side: the first 64 entries that change sign.
_SIGNS = {
    "x": "0, 2, 4, 7, 8, 10, 12, 15, 29, 31, 33, 36, 38, 43, 45, 47, 50, 52, 57, 59, 61",
    "y": "1, 3, 5, 6, 9, 11, 13, 15, 30, 32, 34, 35, 38, 44, 46, 48, 49, 52, 58, 60, 62, 63",
}


def _mirror_sql(axis: str) -> str:
    ones = _SIGNS[axis]
    return f"""WITH x AS (SELECT vec_id, unnest(range(64)) AS i, embedding FROM embeddings), y AS (
SELECT vec_id, CASE WHEN i IN ({ones}) THEN -embedding[i + 1] ELSE embedding[i + 1] END::DOUBLE AS v, i FROM x)
SELECT vec_id, round(sum(v * (i + 1)), 3) + 0.0 AS weighted, round(max(v), 5) AS most FROM y GROUP BY vec_id"""


def _mirrored(spark, d, axis):
    v = _vectors(spark, d).withColumn("m", augment.mirror_input(F.col("input"), axis, 2))
    return v.select("vec_id", F.posexplode("m").alias("i", "v")).groupBy("vec_id").agg(
        (F.round(F.sum(F.col("v").cast("double") * (F.col("i") + 1)), 3) + 0.0).alias("weighted"), F.round(F.max(F.col("v").cast("double")), 5).alias("most")
    )


@query(_mirror_sql("y"))
def q_mirror_y(spark, d):
    return _mirrored(spark, d, "y")


@query(_mirror_sql("x"))
def q_mirror_x(spark, d):
    return _mirrored(spark, d, "x")


@query("""WITH x AS (SELECT vec_id, unnest(range(60)) AS i, embedding FROM embeddings) SELECT vec_id, i AS cell, round(embedding[(i // 20) * 20 + (3 - (i % 20) // 5) * 5 + (4 - i % 5) + 1]::DOUBLE, 5) AS v FROM x""")
def q_mirror_grid(spark, d):
    g = _vectors(spark, d).withColumn("g", augment.mirror_grid(F.slice("input", 1, 60), 5, 4, x=True, y=True))
    return g.select("vec_id", F.posexplode("g").alias("i", "v")).select("vec_id", F.col("i").cast("bigint").alias("cell"), F.round(F.col("v").cast("double"), 5).alias("v"))


@query(None)
def q_noise(spark, d):
    v = _vectors(spark, d)
    return v.select("vec_id", F.transform("input", lambda x, i: x + 0.01 * augment.gaussian(17, F.col("vec_id"), i)).alias("input"))


@query("SELECT count(*) AS vectors, true AS mean_is_zero, true AS deviation_is_sigma, true AS tails_are_normal, true AS all_moved FROM embeddings")
def q_noise_moments(spark, d):
    """Of all entries' noise: mean within five standard errors, deviation within 2 %, 4.55 % beyond two sigma within half a per cent."""
    v = _vectors(spark, d).withColumn("n", F.transform("input", lambda x, i: 0.01 * augment.gaussian(17, F.col("vec_id"), i)))
    one = v.select("vec_id", F.posexplode("n").alias("i", "e"))
    m = one.agg(F.countDistinct("vec_id").alias("vectors"), F.avg("e").alias("m"), F.stddev_pop("e").alias("s"), F.count("*").alias("n"), F.avg((F.abs("e") > 0.02).cast("double")).alias("far"), F.min(F.abs("e")).alias("least"))
    return m.select(
        "vectors", (F.abs("m") < 0.05 / F.sqrt("n")).alias("mean_is_zero"), (F.abs(F.col("s") - 0.01) < 0.0002).alias("deviation_is_sigma"),
        (F.abs(F.col("far") - 0.0455) < 0.005).alias("tails_are_normal"), (F.col("least") > 0).alias("all_moved"),
    )


_SPLIT_OF = """g AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS game_id, user_id % 4 AS i FROM events), ranked AS (SELECT *, row_number() OVER (ORDER BY game_id) - 1 AS k, count(*) OVER () AS n FROM g), sp AS (
SELECT game_id, i, CASE WHEN k < round(n * 0.7::DOUBLE) THEN 'train' WHEN k < round(n * 0.7::DOUBLE) + round(n * 0.15::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM ranked)"""


@query(f"""WITH {_WIN}, {_SPLIT_OF} SELECT w.game_id, w.sequence_index, w.window_index, split, CASE WHEN sp.i = 2 THEN 1.5 ELSE 1.0 END::DOUBLE AS sample_weight FROM win w JOIN sp ON w.game_id = sp.game_id WHERE {_PICK}""")
def q_sample_splits(spark, d):
    split = splits.assign_splits(adapters.events_games(spark, d), TICKS)
    return splits.with_split(_windows(spark, d), split, TICKS).select("game_id", "sequence_index", "window_index", "split", "sample_weight")


@query("""WITH g AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS game_id, user_id % 4 AS i FROM events), r AS (SELECT *, row_number() OVER (ORDER BY game_id) - 1 AS k, count(*) OVER () AS n FROM g)
SELECT game_id, CASE WHEN k < round(n * 0.7::DOUBLE) THEN 'train' WHEN k < round(n * 0.7::DOUBLE) + round(n * 0.15::DOUBLE) THEN 'validation' ELSE 'test' END AS split,
CASE i WHEN 1 THEN 'Group' WHEN 2 THEN 'Elimination' WHEN 3 THEN 'Friendly' ELSE 'Unknown' END AS phase, CAST(0 AS BIGINT) AS sample_count FROM r""")
def q_splits(spark, d):
    return splits.assign_splits(adapters.events_games(spark, d), TICKS)


@query("SELECT lower(CASE i WHEN 1 THEN 'Group' WHEN 2 THEN 'Elimination' WHEN 3 THEN 'Friendly' ELSE 'Unknown' END) AS phase, count(*) AS games FROM (SELECT DISTINCT user_id, user_id % 4 AS i FROM events) GROUP BY 1")
def q_phase_counts(spark, d):
    return sequences.phase_counts(adapters.events_games(spark, d))


@query(f"""WITH {LINES}, s AS (SELECT sqrt(x * x + y * y) AS v FROM r UNION ALL SELECT v * 2 FROM r) SELECT round(avg(v), 6) AS velocity_mean, round(stddev_pop(v), 6) AS velocity_std, count(v) AS sample_count FROM s""")
def q_norm_stats_frames(spark, d):
    team = lambda c: F.transform(F.filter(c, lambda r: r.isNotNull()), lambda r: r.withField("vx", r["x"]).withField("vy", r["y"]).withField("ax", 2 * r["visibility"]))
    rows = _lines(spark, d).withColumns({"target_team": team("target_team"), "opponent_team": team("opponent_team")})
    s = splits.pooled_stats(rows, splits.magnitudes_of_teams())
    return s.select(F.round("velocity_mean", 6).alias("velocity_mean"), F.round("velocity_std", 6).alias("velocity_std"), "sample_count")


@query("""WITH x AS (SELECT embedding AS e, unnest(range(8)) AS k FROM embeddings), s AS (
SELECT sqrt(e[k * 8 + 3]::DOUBLE * e[k * 8 + 3] + e[k * 8 + 4]::DOUBLE * e[k * 8 + 4]) AS v FROM x UNION ALL SELECT sqrt(e[k * 8 + 5]::DOUBLE * e[k * 8 + 5] + e[k * 8 + 6]::DOUBLE * e[k * 8 + 6]) FROM x)
SELECT round(avg(v), 5) AS velocity_mean, round(stddev_pop(v), 5) AS velocity_std, round(avg(v), 5) AS acceleration_mean, round(stddev_pop(v), 5) AS acceleration_std, count(v) AS sample_count FROM s""")
def q_norm_stats_vectors(spark, d):
    s = splits.pooled_stats(_vectors(spark, d), splits.magnitudes_of_inputs(F.col("input")))
    return s.select(*[F.round(c, 5).alias(c) for c in s.columns[:4]], "sample_count")


@query(None)
def q_tracking(spark, d):
    out = tracking.track(ingest.order_frames(adapters.lines_raw(spark, d)), TICKS)
    return out.select("game_id", "frame_number", "yellow", "blue", "yellow_swap", "blue_swap")


def _lanes(spark: SparkSession, d: str) -> DataFrame:
    """Five robots far apart, one of four hidden in each frame and the fifth out of sight for long: only one matching is possible."""
    o = adapters.read(spark, d, "orders").select((F.col("o_custkey") % 50).cast("string").alias("game_id"), F.col("o_orderkey").alias("frame_number"), "o_orderdate")
    order = Window.partitionBy("game_id").orderBy("o_orderdate", "frame_number")
    placed = o.withColumn("frame_pos", F.row_number().over(order).cast("bigint") - 1)
    pos, zero = F.col("frame_pos"), F.lit(0.0)
    hidden = lambda r: (pos % 20 >= 8) if r == 4 else ((pos + r) % 4 == 0)
    robots = F.array_compact(F.array(*[
        F.when(~hidden(r), adapters._robot(F.lit(2.0 * r - 3) + 0.01 * (F.col("frame_number") % 7), zero, zero, F.lit(1.0), r + 10 * F.floor(pos / 16), F.lit(None))) for r in range(5)
    ]))
    return tracking.track(placed.withColumns({"yellow": robots, "blue": F.array().cast(f"array<{ROBOT}>")}), replace(TICKS, identity=Config().identity))


@query(f"""WITH RECURSIVE o AS (SELECT CAST(o_custkey % 50 AS VARCHAR) AS game_id, o_orderkey AS n, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders),
lane AS (SELECT o.game_id, o.n, o.pos, r, CASE WHEN r = 4 THEN CASE WHEN pos % 20 < 8 THEN pos WHEN pos % 20 < 16 THEN pos - pos % 20 + 7 END WHEN (pos + r) % 4 <> 0 THEN pos ELSE pos - 1 END AS lp,
  CASE WHEN r = 4 THEN CASE WHEN pos < 20 THEN 3 ELSE 4 + pos // 20 END WHEN r = 0 THEN 4 ELSE r - 1 END AS id FROM o, range(5) t(r)),
seen AS (SELECT l.*, 2 * l.r - 3 + 0.01::DOUBLE * (o.n % 7) AS x, row_number() OVER (PARTITION BY l.game_id, l.pos ORDER BY l.r) - 1 AS slot FROM lane l JOIN o ON o.game_id = l.game_id AND o.pos = l.lp),
was AS (SELECT *, lag(lp) OVER (PARTITION BY game_id, r, id ORDER BY pos) AS before FROM seen)
SELECT game_id, n AS frame_number, string_agg(id, ',' ORDER BY slot) AS ids, string_agg(substr('GDDMM', CAST(slot AS INT) + 1, 1), '' ORDER BY slot) AS roles, round(sum(x * (slot + 1)), 6) AS places,
  bool_or(lp = pos AND before IS NOT NULL AND before // 16 <> pos // 16) AS swapped FROM was GROUP BY game_id, n""")
def q_tracking_lanes(spark, d):
    tracked = _lanes(spark, d)
    slots = F.filter("yellow", lambda s: s.isNotNull())
    places = F.aggregate(F.transform(slots, lambda s, i: s["x"] * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return tracked.select(
        "game_id", "frame_number", F.concat_ws(",", F.transform(slots, lambda s: s["stable_id"].cast("string"))).alias("ids"),
        F.concat_ws("", F.transform(slots, lambda s: F.substring(s["role"], 1, 1))).alias("roles"), F.round(places, 6).alias("places"), F.col("yellow_swap").alias("swapped"),
    )


@query(f"""WITH {_BEFORE}{_WIN[len(FRAMES):]}, {VERDICTS}, {_SPLIT_OF}, drops AS (
SELECT s.game_id, min(s.sequence_index) AS fst FROM seqs s JOIN v ON s.game_id = v.game_id AND s.sequence_index = v.sequence_index WHERE verdict = 'Drop' GROUP BY s.game_id)
SELECT w.game_id, w.sequence_index, w.window_index, variant, ts0 AS timestamp_start_s, t AS timestamp_end_s, sp.split, CASE WHEN sp.i = 2 THEN 1.5 ELSE 1.0 END::DOUBLE AS sample_weight,
  w.game_id AS source_log, 'b' || u AS target_team, 'y' || u AS opponent_team, 'Blue' AS target_color, u % 3 AS target_score, u % 5 AS opponent_score
FROM win w JOIN sp ON w.game_id = sp.game_id LEFT JOIN drops ON w.game_id = drops.game_id, (VALUES ('base'), ('mirror_y'), ('noise')) AS kinds(variant) WHERE {_PICK} AND (fst IS NULL OR w.sequence_index < fst)""")
def q_sample_metadata(spark, d):
    """The standard pipeline's samples by what they say about themselves: every stage decides which there are."""
    rows = q_standard_pipeline(spark, d)
    return rows.select("game_id", "sequence_index", "window_index", "variant", "timestamp_start_s", "timestamp_end_s", "split", "sample_weight", *pipelines.GAME_FACTS)


@query(None)
def q_standard_pipeline(spark, d):
    return pipelines.build(_ticks(spark, d), adapters.events_games(spark, d), TICKS, adapters.label_reviews(spark, d)).samples


#: Settings under which every step of the cleaning leaves something out and over a thousand samples stay.
_AUTO = replace(
    TICKS, max_gap_s=864000.0, min_sequence_frames=4, max_sequence_frames=60, window=replace(TICKS.window, stride=1),
    clean=replace(TICKS.clean, teleport_m=0.00003, spike_m=7.0, min_visibility=0.02, min_ball_visibility=0.02, min_quality=0.9),
)
#: The cleaning, step by step: repeated times, hidden robots, jumps, spikes, medians of three, hidden balls; then the gate.
_CLEANED = """, c1 AS (SELECT * EXCLUDE (_d) FROM (SELECT *, t - lag(t) OVER (PARTITION BY game_id ORDER BY pos) AS _d FROM fr1) WHERE _d IS NULL OR abs(_d) > 2.220446049250313e-16),
c2 AS (SELECT * FROM c1 WHERE rv >= 0.02 AND ov >= 0.02),
c3 AS (SELECT * EXCLUDE (_t, _r, _o, _b) FROM (SELECT *, t - lag(t) OVER w AS _t, sqrt((rx - lag(rx) OVER w) * (rx - lag(rx) OVER w) + (ry - lag(ry) OVER w) * (ry - lag(ry) OVER w)) AS _r,
    sqrt((ox - lag(ox) OVER w) * (ox - lag(ox) OVER w) + (oy - lag(oy) OVER w) * (oy - lag(oy) OVER w)) AS _o, sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y - lag(y) OVER w) * (y - lag(y) OVER w)) AS _b
  FROM c2 WINDOW w AS (PARTITION BY game_id ORDER BY pos)) WHERE NOT coalesce(_t > 0 AND (coalesce(greatest(_r, _o) > 0.00003::DOUBLE * greatest(_t / 0.033::DOUBLE, 1), false) OR coalesce(_b > 0.00006::DOUBLE * greatest(_t / 0.033::DOUBLE, 1), false)), false)),
c4 AS (SELECT *, (t - lag(t) OVER w) / (lead(t) OVER w - lag(t) OVER w) AS _s, lag(rx) OVER w AS r0, lead(rx) OVER w AS r1, lag(ry) OVER w AS s0, lead(ry) OVER w AS s1,
    lag(ox) OVER w AS o0, lead(ox) OVER w AS o1, lag(oy) OVER w AS q0, lead(oy) OVER w AS q1 FROM c3 WINDOW w AS (PARTITION BY game_id ORDER BY pos)),
c5 AS (SELECT * EXCLUDE (_s, r0, r1, s0, s1, o0, o1, q0, q1) FROM c4 WHERE NOT coalesce(
  (rx - r0 - _s * (r1 - r0)) * (rx - r0 - _s * (r1 - r0)) + (ry - s0 - _s * (s1 - s0)) * (ry - s0 - _s * (s1 - s0)) > 49
  OR (ox - o0 - _s * (o1 - o0)) * (ox - o0 - _s * (o1 - o0)) + (oy - q0 - _s * (q1 - q0)) * (oy - q0 - _s * (q1 - q0)) > 49, false)),
mid AS (SELECT *, """ + ", ".join(
    f"CASE WHEN lag({c}) OVER w IS NOT NULL AND lead({c}) OVER w IS NOT NULL AND {c} IS NOT NULL THEN list_sort([lag({c}) OVER w, {c}, lead({c}) OVER w])[2] ELSE {c} END AS m_{c}"
    for c in ("rx", "ry", "ox", "oy", "x", "y")
) + """ FROM c5 WINDOW w AS (PARTITION BY game_id ORDER BY pos)),
fr AS (SELECT * REPLACE (m_rx AS rx, m_ry AS ry, m_ox AS ox, m_oy AS oy, CASE WHEN bv >= 0.02 THEN m_x END AS x, CASE WHEN bv >= 0.02 THEN m_y END AS y) FROM mid)"""
_AUTO_WIN = _WIN[len(FRAMES):].replace("> 86400", "> 864000").replace("BETWEEN 5 AND 12", "BETWEEN 4 AND 60").replace(", seqs AS (", ", seqs0 AS (")
_GATED = ", seqs AS (SELECT * REPLACE (row_number() OVER (PARTITION BY game_id ORDER BY first_pos) - 1 AS sequence_index) FROM seqs0 WHERE quality_score >= 0.9)"


@query(f"""WITH {_BEFORE.replace(", fr AS (", ", fr1 AS (")}{_CLEANED}{_AUTO_WIN.replace(", played AS (", _GATED + ", played AS (")}, {_SPLIT_OF}
SELECT w.game_id, w.sequence_index, w.window_index, ts0 AS timestamp_start_s, t AS timestamp_end_s, sp.split, variant, round(quality_score, 6) AS quality_score,
  round(CASE WHEN u % 2 = 0 THEN rx - nrx ELSE nrx - rx END, 3) + 0.0 AS dx, round(CASE WHEN variant = 'mirror_y' THEN ry - nry ELSE nry - ry END, 3) + 0.0 AS dy
FROM win w JOIN sp ON w.game_id = sp.game_id JOIN seqs q ON q.game_id = w.game_id AND q.sequence_index = w.sequence_index, (VALUES ('base'), ('mirror_y'), ('noise')) AS kinds(variant) WHERE window_index >= 0 AND nrx IS NOT NULL""")
def q_automatic_pipeline(spark, d):
    """The automatic pipeline's samples: what the cleaning and the gate leave, and where the smoothed robot goes next."""
    rows = pipelines.build(_ticks(spark, d), adapters.events_games(spark, d), _AUTO, automatic=True).samples
    t = lambda k, n: (F.round(F.get("target", F.lit(k)).cast("double"), 3) + 0.0).alias(n)
    return rows.select("game_id", "sequence_index", "window_index", "timestamp_start_s", "timestamp_end_s", "split", "variant", F.round("quality_score", 6).alias("quality_score"), t(0, "dx"), t(1, "dy"))


@query(SQL["q_tracking_lanes"].split("SELECT game_id, n AS frame_number")[0] + """, frame AS (
SELECT game_id, n, pos, count(*) FILTER (WHERE r < 4) AS present, bool_or(lp = pos AND before IS NOT NULL AND before // 16 <> pos // 16) AS swapped FROM was GROUP BY ALL),
f AS (SELECT *, epoch(o_orderdate) AS t FROM frame JOIN orders ON o_orderkey = n),
b AS (SELECT *, coalesce(abs(t - lag(t) OVER w) <= 2.220446049250313e-16, false) AS dup, CASE WHEN pos IN (0, 2) OR t - lag(t) OVER w > 1728000 THEN 1 ELSE 0 END AS s FROM f WINDOW w AS (PARTITION BY game_id ORDER BY pos)),
g AS (SELECT *, sum(s) OVER (PARTITION BY game_id ORDER BY pos) AS segment FROM b),
k AS (SELECT game_id, min(pos) AS first_pos, count(*) AS frames, count(*) FILTER (WHERE swapped) AS swaps, count(*) FILTER (WHERE pos >= 2) AS carried, avg(CAST(dup AS INT)) AS dups, avg((6 - present) / 6::DOUBLE) AS missing FROM g GROUP BY game_id, segment),
q AS (SELECT *, CASE WHEN swaps > 0 THEN 'Transition' WHEN carried > frames // 3 THEN 'OpenPlay' ELSE 'Unknown' END AS kind FROM k WHERE frames BETWEEN 3 AND 40)
SELECT game_id, row_number() OVER (PARTITION BY game_id ORDER BY first_pos) - 1 AS sequence_index, frames AS frame_count, kind AS sequence_kind,
  round(least(1.0::DOUBLE, 0.65::DOUBLE + (1 - dups) * 0.1::DOUBLE + (1 - missing) * 0.15::DOUBLE + (1 - swaps / frames) * 0.2::DOUBLE + CASE WHEN kind = 'OpenPlay' THEN 0.05::DOUBLE ELSE 0 END), 6) AS score,
  concat_ws(',', CASE WHEN dups > 0.03 THEN 'duplicate-timestamps' END, CASE WHEN missing > 0.1 THEN 'missing-robots' END, CASE WHEN swaps > 0 THEN 'identity-instability' END, 'mixed-live-state') AS warnings FROM q""")
def q_transition_sequences(spark, d):
    """Sequences of tracked lanes, most with a swap of identities; the ball lies still, and one robot is off the field."""
    cfg = replace(TICKS, max_gap_s=1728000.0, min_sequence_frames=3, max_sequence_frames=40)
    tracked = _lanes(spark, d).withColumns({"timestamp_s": F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 1e6, "ball": F.struct(*[F.lit(0.0) for _ in range(7)], F.lit(1.0)).cast(BALL)})
    games = tracked.select("game_id").distinct().withColumns({"referee": F.lit(None).cast(REFEREE), "target_color": F.lit("Yellow")})
    found = sequences.summarise(sequences.segment(fr.clean_frames(tracked, games, cfg), cfg), cfg)
    return found.select("game_id", "sequence_index", "frame_count", "sequence_kind", F.round("quality_score", 6).alias("score"), F.concat_ws(",", "warnings").alias("warnings"))


@query(f"""WITH {LINES}, e AS (SELECT *, slot - 1 AS i FROM r WHERE side = 'O'), m AS (
SELECT a.game_id, a.n, a.i, CASE WHEN b.i < a.i THEN b.i ELSE b.i - 1 END * 14 AS first, b.x - a.x AS dx, b.y - a.y AS dy, b.v FROM e a JOIN e b ON a.n = b.n AND a.i <> b.i)
SELECT game_id, n AS frame_number, CAST(i AS INT) AS ego_slot, count(*) AS mates, round(sum((first + 1) * dx / 4.5::DOUBLE + (first + 2) * dy / 3 + (first + 8) + (first + 9) * sqrt(dx * dx + dy * dy) / 9
  + (first + 10) * sin(atan2(dy, dx)) + (first + 11) * cos(atan2(dy, dx)) + (first + 12) * v + (first + 14)), 4) + 0.0 AS weighted FROM m GROUP BY ALL""")
def q_mates_features(spark, d):
    """All entries that an ego's mates have in a step, as a weighted sum, for every robot with mates."""
    f = _lines(spark, d).withColumns(
        {"flags": F.lit(None).cast(FLAGS), "referee": F.lit(None).cast(REFEREE), "live": F.lit(False), "phase": F.lit("Unknown"), "ego_slot": F.explode(F.sequence(F.lit(0), F.lit(5)))}
    )
    seen = fr.count_present(F.col("target_team"))
    step = f.where(F.get("target_team", "ego_slot").isNotNull() & (seen > 1)).withColumn("mates", F.slice(samples.step_features(TICKS), 30, 70))
    weighted = F.aggregate(F.transform("mates", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return step.select("game_id", "frame_number", "ego_slot", (seen - 1).alias("mates"), (F.round(weighted, 4) + 0.0).alias("weighted"))


@query(SQL["q_norm_stats_vectors"])
def q_norm_stats_merged(spark, d):
    """The same statistics from moments of seven groups of vectors, merged."""
    parts = splits.moments(_vectors(spark, d).withColumn("part", F.col("vec_id") % 7), splits.magnitudes_of_inputs(F.col("input")), ["part"])
    s = splits.merged_stats(parts)
    return s.select(*[F.round(c, 5).alias(c) for c in s.columns[:4]], "sample_count")


#: The same SQL over three long games instead of one for each user.
_LONG = ("CAST(user_id AS VARCHAR) AS game_id, user_id AS u", "CAST(user_id % 3 + 1 AS VARCHAR) AS game_id, user_id % 3 + 1 AS u")
_PIECE_S = 5 * 86400.0


@query(SQL["q_velocity"].replace(*_LONG))
def q_long_velocity(spark, d):
    """Flags and velocities of long games whose frames are shared out in pieces of 100."""
    days = lambda f: dynamics.estimate_dynamics(f.withColumn("timestamp_s", F.col("timestamp_s") / 86400), TICKS)
    moved = scans.in_pieces(adapters.long_teams(spark, d, _PIECE_S), 100, max(2, fr.reach(TICKS)), 1, lambda piece: days(fr.flagged(piece, TICKS)))
    return moved.select("game_id", "frame_number", (F.round("ball.vx", 5) + 0.0).alias("ball_vx"), (F.round(_slot()["vx"], 5) + 0.0).alias("robot_vx"), (F.round(_slot()["omega"], 5) + 0.0).alias("robot_omega"))


def _long_frames(spark: SparkSession, d: str) -> DataFrame:
    return scans.in_pieces(adapters.long_teams(spark, d, _PIECE_S), 100, fr.reach(TICKS), 0, lambda piece: fr.flagged(piece, TICKS))


@query(SQL["q_segments"].replace(*_LONG))
def q_long_segments(spark, d):
    return sequences.segment(_long_frames(spark, d), TICKS, piece_rows=100).select("game_id", "frame_number", "segment")


@query(SQL["q_resample_asof"].replace(*_LONG))
def q_long_resample(spark, d):
    return resample.resample_split(_long_frames(spark, d), _PIECE_S).select("game_id", "frame_pos", "frame_number", "timestamp_s")


@query(SQL["q_review_search"])
def q_review_index(spark, d):
    """The search through an index at rest: postings of trigrams, intersected and checked."""
    found = review.with_verdicts(_segmented(spark, d)[1], adapters.label_reviews(spark, d))
    path = scratch_path(spark, "review-index")
    review.write_index(found, path)
    return review.search_index(spark, path, "C 1", "Keep")


@query("""WITH o AS (SELECT CAST(o_custkey % 20 AS VARCHAR) AS game_id, o_orderkey AS n, row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders),
f AS (SELECT *, pos % 2 = 0 AS wide, n % 2 = 1 AS odd, n % 5 < 2 AS third FROM o),
g AS (SELECT *, sum(CASE WHEN wide AND odd AND pos > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY game_id ORDER BY pos) % 2 AS fst, first_value(third) OVER (PARTITION BY game_id ORDER BY pos) AS began FROM f)
SELECT game_id, n AS frame_number, concat_ws(',', fst, 1 - fst, 2, 3) AS ids,
  concat_ws(',', CASE WHEN NOT wide THEN 0 WHEN pos = 0 AND odd THEN 3 ELSE -3 END, CASE WHEN NOT wide THEN 0 WHEN pos = 0 AND odd THEN -3 ELSE 3 END, 20, 20) AS xs,
  concat_ws(',', CASE WHEN wide THEN 0 WHEN n % 3 = 0 THEN 2 ELSE -2 END, CASE WHEN wide THEN 0 WHEN n % 3 = 0 THEN -2 ELSE 2 END,
    CASE WHEN NOT wide THEN 0 WHEN third = began THEN 1 ELSE -1 END, CASE WHEN NOT wide THEN 0 WHEN third = began THEN -1 ELSE 1 END) AS ys,
  concat_ws(',', CASE WHEN began THEN 30 ELSE 0 END, CASE WHEN began THEN 0 ELSE 30 END) AS headings FROM g""")
def q_tracking_ties(spark, d):
    """Four robots: two that are equally far from both observations, so the order decides, and two that only their heading tells apart."""
    o = adapters.read(spark, d, "orders").select((F.col("o_custkey") % 20).cast("string").alias("game_id"), F.col("o_orderkey").alias("frame_number"), "o_orderdate")
    placed = o.withColumn("frame_pos", F.row_number().over(Window.partitionBy("game_id").orderBy("o_orderdate", "frame_number")).cast("bigint") - 1)
    n, wide = F.col("frame_number"), F.col("frame_pos") % 2 == 0
    side = F.when(n % 2 == 1, 0.3).otherwise(-0.3)
    up = F.when(n % 3 == 0, 0.2).otherwise(-0.2)
    at = lambda x, y, theta: adapters._robot(x, y, theta, F.lit(1.0), F.lit(None), F.lit(None))
    zero, far = F.lit(0.0), F.lit(2.0)
    pair = [at(F.when(wide, s * side).otherwise(0.0), F.when(wide, 0.0).otherwise(s * up), zero) for s in (1, -1)]
    turned = [at(far, F.when(wide, y).otherwise(0.0), F.when((n % 5 < 2) == first, 3.0).otherwise(0.0)) for y, first in ((0.1, True), (-0.1, False))]
    tracked = tracking.track(placed.withColumns({"yellow": F.array(*pair, *turned), "blue": F.array().cast(f"array<{ROBOT}>")}), replace(TICKS, identity=Config().identity))
    slots = F.filter("yellow", lambda s: s.isNotNull())
    tenths = lambda s, c: F.concat_ws(",", F.transform(s, lambda r: F.round(r[c] * 10).cast("int").cast("string")))
    return tracked.select(
        "game_id", "frame_number", F.concat_ws(",", F.transform(slots, lambda s: s["stable_id"].cast("string"))).alias("ids"),
        tenths(slots, "x").alias("xs"), tenths(slots, "y").alias("ys"), tenths(F.slice(slots, 3, 2), "theta").alias("headings"),
    )


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return q_sequence_summary(spark, d)
