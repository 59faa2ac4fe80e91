"""Small helpers that the corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: a cluster has to name it, one machine gets a temporary one."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.conf.get("trackloom.scratch.dir", None)
        if not found:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
            found = "file://" + tempfile.mkdtemp(prefix="trackloom-")
            spark.conf.set("trackloom.scratch.dir", found)
    return found.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new folder's path in the shared folder; it is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/trackloom-{what}-{uuid.uuid4().hex}"
    system, p = _hadoop(spark, path)
    system.mkdirs(p)
    system.deleteOnExit(p)
    return path


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, what)
    schema = df.schema
    df.write.mode("append").parquet(path)
    out = df.sparkSession.read.schema(schema).parquet(path)
    out._scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once nothing that is still to be computed reads it."""
    for df in frames:
        system, p = _hadoop(df.sparkSession, df._scratch)
        system.delete(p, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hex64(col):
    """A long as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def packed(df: DataFrame, keep: list[str], **more) -> DataFrame:
    """The kept columns as one struct ``row``, and others beside it, so that no names can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), *[c.alias(n) for n, c in more.items()])


def unpacked(df: DataFrame, *more: str) -> DataFrame:
    return df.select("row.*", *more)


def in_bitmap(mark: Column, bits: int) -> tuple[Column, Column]:
    """The word of a bitmap of ``bits`` bits that holds the bit of the long ``mark``, and that bit."""
    place = F.pmod(mark, F.lit(bits))
    return F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))


def bitmap(df: DataFrame, mark: Column, what: str, bits: int = 1 << 22) -> DataFrame:
    """``_word, _bits``: the bits of all ``mark`` of ``df``, in at most ``bits / 64`` rows, whatever the data."""
    word, bit = in_bitmap(mark, bits)
    return materialize(df.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits")), what)


def may_hold(df: DataFrame, words: DataFrame, mark: Column, bits: int = 1 << 22, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose bit is set, or with ``left_anti`` those whose bit isn't; the bitmap is broadcast."""
    word, bit = in_bitmap(mark, bits)
    return df.join(F.broadcast(words), (word == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0), how)


def numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns), ``n`` and ``text``, where ``n`` is unique: the id itself where ids are.

    Where ids repeat or are null, rows are numbered by id, null ids last, and equal ids by a hash of their texts.
    """
    src = packed(df, df.columns, n=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string"))
    if src.groupBy("n").agg(F.count("*").alias("_c")).where("_c > 1 or n is null").isEmpty():
        return src
    order = [F.asc_nulls_last("n"), F.xxhash64("text")]
    ranged = src.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    return materialize(ranged.select("row", F.monotonically_increasing_id().alias("n"), "text"), "numbered")
