"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names; a single machine gets a temporary folder where it is unset."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("trackloom.scratch.dir", None)
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
    """A new folder in the shared one; it is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/trackloom-{what}-{uuid.uuid4().hex}"
    system, p = _hadoop(spark, path)
    system.mkdirs(p)
    system.deleteOnExit(p)
    return path


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` from a file of its own: computed once, and still there when executors are lost."""
    path = scratch_path(df.sparkSession, what)
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
