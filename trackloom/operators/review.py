"""Review verdicts, payloads and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def with_verdicts(sequences: DataFrame, reviews: DataFrame) -> DataFrame:
    """Sequences with ``verdict`` and ``note``; ``Unreviewed`` and an empty note by default."""
    joined = sequences.join(reviews.select("game_id", "sequence_index", "verdict", "note"), ["game_id", "sequence_index"], "left")
    return joined.withColumns({"verdict": F.coalesce("verdict", F.lit("Unreviewed")), "note": F.coalesce("note", F.lit(""))})


def upsert(reviews: DataFrame, changes: DataFrame) -> DataFrame:
    """The newest entry for each sequence; ``changes`` has ``position`` to order several for one."""
    cols = ["game_id", "sequence_index", "verdict", "note"]
    both = reviews.select(*cols, F.lit(-1).cast("bigint").alias("position")).unionByName(changes.select(*cols, F.col("position").cast("bigint").alias("position")))
    latest = both.groupBy("game_id", "sequence_index").agg(F.max_by(F.struct("verdict", "note"), "position").alias("_l"))
    return latest.select("game_id", "sequence_index", "_l.verdict", "_l.note")


def search(sequences: DataFrame, verdict: str | None = None, term: str = "") -> DataFrame:
    """Sequences with a verdict whose kind, warnings and note hold a term, in any case.  A blank term finds all."""
    out = sequences if verdict is None else sequences.where(F.col("verdict") == verdict)
    if not term.strip():
        return out
    return out.where(F.contains(_review_text(), F.lit(term.lower())))


def game_payload(games: DataFrame, sequences: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row for each game with its sequences, verdicts and notes, in order."""
    listed = with_verdicts(sequences, reviews).groupBy("game_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct("sequence_index", "start_frame", "end_frame", "start_time_s", "end_time_s", "frame_count", "quality_score", "sequence_kind", "warnings", "verdict", "note")
            )
        ).alias("sequences")
    )
    return games.join(listed, "game_id", "left")


def in_bins(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, start: str, end: str) -> DataFrame:
    """The pairs of ``points`` and ``ranges`` that agree in ``keys`` and where ``at`` is from ``start`` to ``end``."""
    return meetings(points, ranges, keys, at, start, end).where(F.col(at).between(F.col(start), F.col(end)))


def meetings(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, start: str, end: str) -> DataFrame:
    """The pairs that meet in a bin, among them all whose range holds the point.

    A range is filed under the one or two bins of a width that it spans: the power of eight that
    is as long as the range or just over.  Points look into their bin of every width that
    occurs (at most 22), so both sides meet by equality, and a bin of a width holds only ranges of
    an eighth of it and longer.  Nulls meet nothing.
    """
    length = F.col(end).cast("bigint") - F.col(start).cast("bigint") + 1
    level = F.ceil(F.log2(length.cast("double")) / 3).cast("int")
    sized = ranges.where(F.col(start) <= F.col(end)).withColumn("_level", F.least(F.lit(20), level))
    levels = sorted(r["_level"] for r in sized.select("_level").distinct().collect())
    bin_of = lambda c, k: F.shiftright(F.col(c).cast("bigint"), k * 3)
    width = [F.when(F.col("_level") == k, F.array_distinct(F.array(bin_of(start, k), bin_of(end, k)))) for k in levels]
    filed = sized.withColumn("_bin", F.explode(F.coalesce(*width) if width else F.array().cast("array<bigint>")))
    looks = F.array(*[F.struct(F.lit(k).alias("_level"), bin_of(at, k).alias("_bin")) for k in levels]).cast("array<struct<_level:int,_bin:bigint>>")
    return points.withColumn("_look", F.explode(looks)).select(*points.columns, "_look.*").join(filed, [*keys, "_level", "_bin"]).drop("_level", "_bin")


def frames_in_range(frames: DataFrame, sequences: DataFrame) -> DataFrame:
    """Frames of each sequence by the range of its frame numbers, which are looked up without the frames' bodies."""
    s = sequences.select("game_id", "sequence_index", "start_frame", "end_frame")
    numbers = frames.select("game_id", "frame_number").distinct()
    found = in_bins(numbers, s, ["game_id"], "frame_number", "start_frame", "end_frame")
    return frames.join(found, ["game_id", "frame_number"]).select(*[frames[c] for c in frames.columns], "sequence_index", "start_frame", "end_frame")


def _review_text() -> Column:
    return F.lower(F.concat_ws(" ", "sequence_kind", F.concat_ws(" ", "warnings"), "note"))


GRAM, BUCKETS = 3, 64


def _grams(text: Column) -> Column:
    """All runs of three characters; none of a shorter text."""
    last = F.length(text) - GRAM + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda k: F.substring(text, k, F.lit(GRAM))))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def write_index(sequences: DataFrame, path: str) -> None:
    """An index of reviewed sequences' texts: postings and counts by trigram, and texts by key, in buckets.

    Postings are sorted within a bucket, so that a scan for some trigrams skips the others' row groups.
    """
    text = sequences.select("game_id", "sequence_index", "verdict", _review_text().alias("text"))
    key = _bucket(F.struct("game_id", "sequence_index"))
    text.withColumn("bucket", key).repartition("bucket", "game_id").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/texts")
    postings = text.select(F.explode(_grams(F.col("text"))).alias("gram"), "game_id", "sequence_index").withColumn("bucket", _bucket(F.col("gram")))
    spread = postings.repartitionByRange("bucket", "gram", "game_id").sortWithinPartitions("bucket", "gram", "game_id", "sequence_index")
    spread.write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/postings")
    stored = sequences.sparkSession.read.schema("gram string, game_id string, sequence_index bigint, bucket int").parquet(f"{path}/postings")
    counts = stored.groupBy("bucket", "gram").agg(F.count("*").alias("n"))
    counts.repartitionByRange("bucket", "gram").sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/counts")


def search_index(spark: SparkSession, path: str, term: str, verdict: str | None = None, most: int = 4) -> DataFrame:
    """``game_id, sequence_index`` as ``search`` finds them, from an index.

    The postings of the term's ``most`` rarest trigrams are read and intersected, and the texts
    that remain are checked.  A term of under three characters has no trigram: the texts are scanned.
    """
    texts = spark.read.schema("game_id string, sequence_index bigint, verdict string, text string, bucket int").parquet(f"{path}/texts")
    kept = texts if verdict is None else texts.where(F.col("verdict") == verdict)
    found = kept.where(F.contains("text", F.lit(term.lower()))) if term.strip() else kept
    grams = spark.range(1).select(F.explode(_grams(F.lit(term.lower()))).alias("gram")).withColumn("bucket", _bucket(F.col("gram"))).collect() if term.strip() else []
    if not grams:
        return found.select("game_id", "sequence_index")
    asked = F.col("bucket").isin([g["bucket"] for g in grams]) & F.col("gram").isin([g["gram"] for g in grams])
    counts = spark.read.schema("gram string, n bigint, bucket int").parquet(f"{path}/counts").where(asked)
    rarest = [r["gram"] for r in counts.orderBy("n", "gram").limit(most).collect()]
    if not rarest:
        return found.select("game_id", "sequence_index").limit(0)
    postings = spark.read.schema("gram string, game_id string, sequence_index bigint, bucket int").parquet(f"{path}/postings")
    own = F.col("bucket").isin([g["bucket"] for g in grams if g["gram"] in rarest]) & F.col("gram").isin(rarest)
    both = postings.where(own).groupBy("game_id", "sequence_index").agg(F.count("*").alias("_n")).where(F.col("_n") == len(rarest))
    places = both.withColumn("bucket", _bucket(F.struct("game_id", "sequence_index")))
    return found.join(places, ["bucket", "game_id", "sequence_index"], "left_semi").select("game_id", "sequence_index")


def frame_payload(frames: DataFrame) -> DataFrame:
    """What a viewer needs of a frame: present robots with their slots, ball and flags."""

    def team(c: str):
        slots = F.transform(F.col(c), lambda r, i: F.struct(i.alias("slot"), r.alias("r")))
        present = F.filter(slots, lambda s: s["r"].isNotNull())
        names = ("raw_id", "stable_id", "role", "x", "y", "theta", "vx", "vy")
        return F.transform(present, lambda s: F.struct(s["slot"].alias("slot"), *[s["r"][n].alias(n) for n in names]))

    b, f = F.col("ball"), F.col("flags")
    return frames.select(
        *[c for c in ("game_id", "sequence_index") if c in frames.columns], "timestamp_s", "frame_number", "live", "target_attacks_positive_x",
        team("target_team").alias("target_team"), team("opponent_team").alias("opponent_team"),
        F.when(b.isNotNull(), F.struct(b["x"].alias("x"), b["y"].alias("y"), b["vx"].alias("vx"), b["vy"].alias("vy"))).alias("ball"),
        F.struct(*[f[n].alias(n) for n in ("duplicate_timestamp", "carried_ball", "likely_identity_swap", "referee_live", "heuristic_live")]).alias("flags"),
    )


def sequence_payload(clean: DataFrame, raw: DataFrame, sequences: DataFrame, reviews: DataFrame, game_id: str, sequence_index: int) -> DataFrame:
    """One row with a sequence's summary, verdict, clean and raw frames; no row if it isn't known."""
    one = with_verdicts(sequences.where((F.col("game_id") == game_id) & (F.col("sequence_index") == sequence_index)), reviews)

    def listed(frames: DataFrame, name: str) -> DataFrame:
        shown = frame_payload(frames_in_range(frames, one))
        body = F.struct("frame_number", *[c for c in shown.columns if c not in ("game_id", "sequence_index", "frame_number")])
        return shown.groupBy("game_id", "sequence_index").agg(F.sort_array(F.collect_list(body)).alias(name))

    keys = ["game_id", "sequence_index"]
    return one.join(listed(clean, "cleaned_frames"), keys, "left").join(listed(raw, "raw_frames"), keys, "left")


def compare_with_raw(clean: DataFrame, raw: DataFrame, trail: int = 11) -> DataFrame:
    """Clean and raw ball of the same frame number, and the ball's trail over the last clean frames."""
    order = Window.partitionBy("game_id").orderBy("frame_pos")
    traced = clean.withColumn("trail", F.collect_list(F.struct("ball.x", "ball.y")).over(order.rowsBetween(-(trail - 1), 0)))
    other = raw.select("game_id", "frame_number", F.col("ball").alias("raw_ball"))
    return traced.select("game_id", "frame_pos", "frame_number", "ball", "trail").join(other, ["game_id", "frame_number"], "left")
