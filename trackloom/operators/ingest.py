"""From decoded tracker messages to ordered raw frames and one referee row for each game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import BALL, ROBOT
from .scans import of_time, running_sum


def source_filter(raw: DataFrame, source: str | None) -> DataFrame:
    """Frames of one tracker source; no source named is ``unknown``."""
    return raw if source is None else raw.where(F.coalesce("source_name", F.lit("unknown")) == source)


def drop_consecutive_duplicates(raw: DataFrame, keep_flag: bool = False) -> DataFrame:
    """Drop a message that repeats the one before it: frame number, time and source.

    With ``keep_flag``, rows stay and ``is_repeat`` tells.
    """
    order = Window.partitionBy("game_id").orderBy("msg_pos")
    key = F.struct("frame_number", "timestamp_s", F.coalesce("source_name", F.lit("unknown")))
    flagged = raw.withColumn("is_repeat", F.coalesce(key.eqNullSafe(F.lag(key).over(order)) & F.lag(F.lit(True)).over(order), F.lit(False)))
    return flagged if keep_flag else flagged.where(~F.col("is_repeat")).drop("is_repeat")


def frames_from_tracker(packets: DataFrame) -> DataFrame:
    """Split a packet's robots by team and keep its first ball.

    ``packets`` has ``robots`` (``team`` 1 yellow, 2 blue; other teams are dropped) and
    ``balls``.  Missing velocities are 0, missing visibility is 1; packets without a frame
    (null ``robots`` and ``balls``) are dropped.
    """
    zero = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))

    def robot(r: Column) -> Column:
        return F.struct(
            r["raw_id"].cast("bigint").alias("raw_id"), F.lit(None).cast("bigint").alias("stable_id"), F.lit("Unknown").alias("role"),
            r["x"].cast("float").cast("double").alias("x"), r["y"].cast("float").cast("double").alias("y"), r["theta"].cast("float").cast("double").alias("theta"),
            zero(r["vx"]).alias("vx"), zero(r["vy"]).alias("vy"), zero(r["omega"]).alias("omega"), F.lit(0.0).alias("ax"), F.lit(0.0).alias("ay"),
            F.coalesce(r["visibility"].cast("double"), F.lit(1.0)).alias("visibility"),
        ).cast(ROBOT)

    def team(n: int) -> Column:
        return F.transform(F.filter("robots", lambda r: r["team"] == n), robot)

    b = F.get("balls", F.lit(0))
    ball = F.struct(
        b["x"].cast("float").cast("double").alias("x"), b["y"].cast("float").cast("double").alias("y"), zero(b["z"]).alias("z"),
        zero(b["vx"]).alias("vx"), zero(b["vy"]).alias("vy"), F.lit(0.0).alias("ax"), F.lit(0.0).alias("ay"),
        F.coalesce(b["visibility"].cast("double"), F.lit(1.0)).alias("visibility"),
    ).cast(BALL)
    empty = F.array().cast(f"array<{ROBOT}>")
    return packets.where("robots is not null or balls is not null").select(
        "game_id", "msg_pos", "source_name", "timestamp_s", "frame_number", F.when(b.isNotNull(), ball).alias("ball"),
        F.coalesce(team(1), empty).alias("yellow"), F.coalesce(team(2), empty).alias("blue"),
    )


def last_referee(messages: DataFrame) -> DataFrame:
    """The last message of each game in message order, as ``game_id, referee, phase``."""
    cols = [c for c in messages.columns if c not in ("game_id", "msg_pos")]
    last = messages.groupBy("game_id").agg(F.max_by(F.struct(*cols), "msg_pos").alias("referee"))
    kind = F.col("referee.match_type")
    return last.withColumn("phase", F.when(kind == 1, "Group").when(kind == 2, "Elimination").when(kind == 3, "Friendly").otherwise("Unknown"))


def order_frames(raw: DataFrame, piece_s: float | None = None) -> DataFrame:
    """Number frames of a game by time and frame number; ties stay in message order.

    With ``piece_s``, a game's frames are shared out by time, in pieces of so many seconds.
    """
    order = ["timestamp_s", "frame_number", "msg_pos"]
    if piece_s is not None:
        return running_sum(raw, F.lit(1).cast("bigint"), order, of_time(piece_s), "_n").withColumn("frame_pos", F.col("_n") - 1).drop("_n")
    return raw.withColumn("frame_pos", F.row_number().over(Window.partitionBy("game_id").orderBy(*order)).cast("bigint") - 1)


def resolve_target_color(referee: DataFrame, name: str | None, color: str = "Blue") -> DataFrame:
    """Add ``target_color``: the given colour, or that of the named team (yellow first); null if no team has the name."""
    if name is None:
        return referee.withColumn("target_color", F.lit(color))
    return referee.withColumn(
        "target_color", F.when(F.col("referee.yellow_name") == name, "Yellow").when(F.col("referee.blue_name") == name, "Blue")
    )


def game_id_from_path(path: Column) -> Column:
    return F.replace(F.element_at(F.split(path, "/"), -1), F.lit("."), F.lit("_"))


def year_from_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, "^([0-9]{4})", 1), F.lit("")).cast("int")
