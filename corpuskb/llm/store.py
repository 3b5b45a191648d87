"""Shared scratch tables: lineage is cut by Parquet tables under ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a local folder is set if all runs on one machine; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so later plans start from files that survive executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpuskb/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every scratch table written so far. Call it only when all results built on them are stored."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(hadoop).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
