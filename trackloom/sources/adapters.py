"""Frames from general event and order tables, so that every operator has data to run on."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CleanConfig, Config, WindowConfig
from ..schemas import BALL, REFEREE, REVIEWS, ROBOT

#: Thresholds that suit the event clock: users act a few times a day.
TICKS = replace(
    Config(), possession_radius_m=4.0, max_gap_s=86400.0, min_sequence_frames=5, max_sequence_frames=12, carried_ball_frames=3,
    window=WindowConfig(length=3, stride=2), clean=CleanConfig(teleport_m=0.000004, spike_m=3.0, min_target_robots=1, min_opponent_robots=1),
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _robot(x, y, theta, visibility, raw_id, stable_id):
    zero = F.lit(0.0)
    return F.struct(
        raw_id.cast("bigint").alias("raw_id"), stable_id.cast("bigint").alias("stable_id"), F.lit("Unknown").alias("role"), x.alias("x"), y.alias("y"),
        theta.alias("theta"), zero.alias("vx"), zero.alias("vy"), zero.alias("omega"), zero.alias("ax"), zero.alias("ay"), visibility.alias("visibility"),
    ).cast(ROBOT)


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw frame for each event: a game is a user, with a ball and one robot for each side."""
    e = read(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"),
        F.get_json_object("props", "$.k").cast("int").cast("double").alias("k"),
    )
    n, k = F.col("event_id"), F.col("k")
    ball = F.struct(
        (F.col("value") % 9.0 - 4.5).alias("x"), (k / 99.0 * 6 - 3).alias("y"), *[F.lit(0.0).alias(c) for c in ("z", "vx", "vy", "ax", "ay")], (k / 99.0).alias("visibility")
    ).cast(BALL)
    at = lambda a, m: ((n * a) % m).cast("double") / 1000.0
    theta = k / 99.0 * 6 - 3
    mine = _robot(at(7919, 9000) - 4.5, at(104729, 6000) - 3, theta, k / 99.0, n % 4, F.lit(0))
    theirs = _robot(at(1299721, 9000) - 4.5, at(15485863, 6000) - 3, -theta, F.lit(1.0) - k / 99.0, n % 3, F.lit(0))
    return e.select(
        F.col("user_id").cast("string").alias("game_id"), n.alias("msg_pos"), F.col("event_type").alias("source_name"), F.col("t").alias("timestamp_s"),
        n.alias("frame_number"), F.when(~F.coalesce((F.col("event_type") == "error") & (k < 20), F.lit(False)), ball).alias("ball"),
        F.array(theirs).alias("yellow"), F.array(mine).alias("blue"),
    )


def events_tracked(spark: SparkSession, sf_dir: str, size: int = 6) -> DataFrame:
    """The raw frames in order, with slots in place of observations, as if tracked."""
    from ..operators.ingest import order_frames

    return in_slots(order_frames(events_raw(spark, sf_dir)), size)


def in_slots(raw: DataFrame, size: int = 6) -> DataFrame:
    pad = F.array_repeat(F.lit(None).cast(ROBOT), size - 1)
    return raw.withColumns({"yellow": F.concat("yellow", pad), "blue": F.concat("blue", pad), "yellow_swap": F.lit(False), "blue_swap": F.lit(False)})


def long_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same frames in three long games: every third user plays in each one, named after users 1 to 3."""
    return events_raw(spark, sf_dir).withColumn("game_id", (F.col("game_id").cast("bigint") % 3 + 1).cast("string"))


def long_teams(spark: SparkSession, sf_dir: str, piece_s: float, cfg: Config = TICKS) -> DataFrame:
    """Long games in order, numbered piece by piece, with teams by target."""
    from ..operators.frames import with_targets
    from ..operators.ingest import order_frames

    return with_targets(in_slots(order_frames(long_raw(spark, sf_dir), piece_s), cfg.team_size), events_games(spark, sf_dir))


def events_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One game for each user: phase, sides and scores follow from the id."""
    u = read(spark, sf_dir, "events").select("user_id").where("user_id is not null").distinct()
    i = F.col("user_id")
    referee = F.struct(
        F.lit(0).alias("stage"), (i % 4).cast("int").alias("command"), (i % 2 == 0).alias("blue_team_on_positive_half"), (i % 4).cast("int").alias("match_type"),
        F.concat(F.lit("y"), i.cast("string")).alias("yellow_name"), F.concat(F.lit("b"), i.cast("string")).alias("blue_name"),
        (i % 5).alias("yellow_score"), (i % 3).alias("blue_score"),
    ).cast(REFEREE)
    phase = F.when(i % 4 == 1, "Group").when(i % 4 == 2, "Elimination").when(i % 4 == 3, "Friendly").otherwise("Unknown")
    return u.select(i.cast("string").alias("game_id"), referee.alias("referee"), phase.alias("phase"), F.lit("Blue").alias("target_color"))


def events_frames(spark: SparkSession, sf_dir: str, cfg: Config = TICKS) -> DataFrame:
    """Clean frames of the events."""
    from ..operators.frames import clean_frames

    return clean_frames(events_tracked(spark, sf_dir, cfg.team_size), events_games(spark, sf_dir), cfg)


def lines_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw frame for each order: a game is a customer, and the lines of each side are robots."""
    lines = read(spark, sf_dir, "lineitem").join(
        read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 1e6).alias("t")),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    robot = _robot(
        F.col("l_quantity") / 50 * 9 - 4.5, F.col("l_tax") / 0.08 * 6 - 3, F.lit(0.0), F.col("l_discount") * 10, F.col("l_linenumber"), F.lit(None)
    )
    body = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", robot.alias("r"))
    side = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("l_linestatus") == s, body))), lambda x: x["r"])
    return lines.groupBy("o_custkey", "l_orderkey", "t").agg(side("O").alias("yellow"), side("F").alias("blue")).select(
        F.col("o_custkey").cast("string").alias("game_id"), F.col("l_orderkey").alias("msg_pos"), F.lit("orders").alias("source_name"),
        F.col("t").alias("timestamp_s"), F.col("l_orderkey").alias("frame_number"), F.lit(None).cast(BALL).alias("ball"), "yellow", "blue",
    )


def label_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts from labels: a document's id gives the game, of all users, and the sequence."""
    users = read(spark, sf_dir, "events").agg(F.countDistinct("user_id").alias("n")).first()["n"]
    rows = read(spark, sf_dir, "labels").where("doc_id is not null").select(
        (F.col("doc_id") % users).cast("string").alias("game_id"),
        F.floor(F.col("doc_id") / users).cast("bigint").alias("sequence_index"),
        F.when(F.col("toxic") == 1, "NeedsAttention").when(F.col("quality") == 0, "Drop").otherwise("Keep").alias("verdict"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("note"),
    )
    return rows.selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in REVIEWS.split(", ")])
