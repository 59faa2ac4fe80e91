"""Scans that split a long game: work in order over frames, in pieces that tasks share.

A piece is a range of a game's frames or of its time, told from the row alone, so it is one more
grouping key and needs no sampling.  Three ways to see over a piece's edge:

* ``in_pieces``: frames close to an edge are copied into the next piece, for operators whose reach is bounded;
* ``last_before``: what the pieces before end with, for the last known value;
* ``running_sum``: what the pieces before add up to.

The last two summarise a piece in one row; only these rows are put in order by game.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..scratch import written

#: Between a game and its piece in the name under which an operator sees it.
_MARK = "\u0001"
_LAST = (1 << 62) - 1


def of_position(rows: int) -> Column:
    return F.floor(F.col("frame_pos") / rows).cast("bigint")


def of_time(seconds: float, time: str = "timestamp_s") -> Column:
    """Times of no number are after all others, like in a sort; null comes first."""
    t = F.col(time)
    return F.when(F.isnan(t), F.lit(_LAST)).when(t.isNotNull(), F.greatest(F.lit(-_LAST), F.least(F.lit(_LAST - 1), F.floor(t / seconds).cast("bigint"))))


def in_pieces(frames: DataFrame, rows: int, before: int, after: int, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """An operator that looks at most ``before`` frames back and ``after`` ahead, over pieces of ``rows`` frames.

    ``frame_pos`` has to count a game's frames without gaps.  The operator sees each piece, with the
    frames around it, as a game of its own; results of those frames are left out.  It has to
    keep ``game_id`` and ``frame_pos``.
    """
    if rows < max(before, after, 1):
        raise ValueError("a piece can't be shorter than the reach")
    own, place = of_position(rows), F.pmod(F.col("frame_pos"), F.lit(rows))
    near = F.array_compact(F.array(own, F.when(place >= rows - before, own + 1), F.when((place < after) & (own > 0), own - 1)))
    cut = frames.withColumn("_piece", F.explode(near)).withColumn("game_id", F.concat("game_id", F.lit(_MARK), F.col("_piece").cast("string"))).drop("_piece")
    out = operator(cut)
    split = F.col("game_id")
    core = F.substring_index(split, _MARK, -1).cast("bigint") == own
    return out.where(core).withColumn("game_id", F.substring(split, F.lit(1), F.length(split) - F.length(F.substring_index(split, _MARK, -1)) - 1))


def step_in_pieces(frames: DataFrame, rows: int, before: int, after: int, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``in_pieces`` for frames whose ``frame_pos`` has gaps, as filters leave them: they are counted anew for the step.

    Each step is written, so that a chain of them doesn't compute the ones before again and again.
    """
    counted = running_sum(frames, F.lit(1).cast("bigint"), ["frame_pos"], of_position(rows), "_n")
    dense = written(counted.withColumns({"_kept_pos": F.col("frame_pos"), "frame_pos": F.col("_n") - 1}).drop("_n"), "step")
    out = in_pieces(dense, rows, before, after, operator).withColumn("frame_pos", F.col("_kept_pos")).drop("_kept_pos")
    return out.select(*frames.columns)


def _order(columns: list[Column | str]) -> WindowSpec:
    return Window.partitionBy("game_id", "_piece").orderBy(*columns)


def _summaries_before(pieces: DataFrame, carried: Column, name: str) -> DataFrame:
    """``game_id, _piece, name``: an aggregate's value over the rows of all pieces before."""
    earlier = Window.partitionBy("game_id").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select(F.col("game_id").alias("_game"), F.col("_piece").alias("_p"), carried.over(earlier).alias(name))


def _joined(rows: DataFrame, summaries: DataFrame) -> DataFrame:
    both = rows["game_id"].eqNullSafe(summaries["_game"]) & rows["_piece"].eqNullSafe(summaries["_p"])
    return rows.join(summaries, both, "left").drop("_game", "_p")


def given(rows: DataFrame, facts: DataFrame, piece: Column) -> DataFrame:
    """What is known of a game beside each of its rows: facts go to the pieces first, so no join has a game as its key."""
    cut = rows.withColumn("_piece", piece)
    pieces = cut.select(F.col("game_id").alias("_game"), F.col("_piece").alias("_p")).distinct()
    known = pieces.join(facts, pieces["_game"].eqNullSafe(facts["game_id"])).drop("game_id")
    return _joined(cut, known).drop("_piece")


def running_sum(rows: DataFrame, value: Column, order: list[Column | str], piece: Column, name: str) -> DataFrame:
    """The sum of ``value`` over a game's rows up to each one; pieces have to follow the order."""
    cut = rows.withColumns({"_piece": piece, "_value": value})
    sums = cut.groupBy("game_id", "_piece").agg(F.sum("_value").alias("_sum"))
    known = _joined(cut, _summaries_before(sums, F.sum("_sum"), "_base"))
    upto = _order(order).rowsBetween(Window.unboundedPreceding, 0)
    return known.withColumn(name, F.coalesce("_base", F.lit(0)) + F.coalesce(F.sum("_value").over(upto), F.lit(0))).drop("_piece", "_value", "_base")


def last_before(rows: DataFrame, value: Column, order: list[Column | str], piece: Column, name: str, key: Column, strict: bool = True) -> DataFrame:
    """The last ``value`` that isn't null among a game's rows before each one, or up to it.

    ``key`` sorts like ``order`` and is kept small: it picks a piece's last value.
    """
    cut = rows.withColumns({"_piece": piece, "_value": value, "_key": key})
    ends = cut.where("_value is not null").groupBy("game_id", "_piece").agg(F.max_by("_value", "_key").alias("_end"))
    pieces = cut.select("game_id", "_piece").distinct().withColumnsRenamed({"game_id": "_g", "_piece": "_q"})
    every = pieces.join(ends, pieces["_g"].eqNullSafe(ends["game_id"]) & pieces["_q"].eqNullSafe(ends["_piece"]), "left").select(
        F.col("_g").alias("game_id"), F.col("_q").alias("_piece"), "_end"
    )
    known = _joined(cut, _summaries_before(every, F.last("_end", ignorenulls=True), "_base"))
    upto = _order(order).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    return known.withColumn(name, F.coalesce(F.last("_value", ignorenulls=True).over(upto), F.col("_base"))).drop("_piece", "_value", "_key", "_base")


def ranked(rows: DataFrame, order: list[Column | str], name: str, parts: int | None = None) -> tuple[DataFrame, int]:
    """The place of each row in the order of all, from 0, and how many rows there are.

    Ranges of the order are sorted by tasks and written once; only the ranges' counts, one for
    each, are added up to offsets.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    ranges = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kept = written(ranges.withColumns({"_range": F.shiftright(place, 33), "_place": place.bitwiseAND(F.lit((1 << 33) - 1))}), "ranges")
    counts = {r["_range"]: r["n"] for r in kept.groupBy("_range").agg(F.count("*").alias("n")).collect()}  # at most ``parts``
    offsets, total = [], 0
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    known = spark.createDataFrame(offsets, "_range long, _offset long")
    out = kept.join(F.broadcast(known), "_range").withColumn(name, F.col("_offset") + F.col("_place"))
    return out.select(*rows.columns, name), total
