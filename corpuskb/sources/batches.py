"""Tables written batch by batch that a lost task, a killed job or a rerun neither doubles nor cuts.

A batch is written whole to a folder of its own and only then named in the manifest, a small table of one row a write. What
isn't named there isn't read, and of several writes of one batch the last one counts.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "batch string, path string, written long, n_rows long"


def write_batch(rows: DataFrame, folder: str, batch: str) -> None:
    """Writes a batch in place of an earlier one of its name; ``folder`` is one that driver and executors share."""
    spark, name = rows.sparkSession, f"data/{uuid.uuid4().hex}"
    rows.write.parquet(f"{folder}/{name}")
    n = spark.read.schema(rows.schema).parquet(f"{folder}/{name}").count()
    spark.createDataFrame([(batch, name, time.time_ns(), n)], _MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The write that counts of each batch: batch, path, written, n_rows; no rows before the first write."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _MANIFEST)
    every = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    last = every.groupBy("batch").agg(F.max_by(F.struct("path", "written", "n_rows"), F.struct("written", "path")).alias("last"))
    return last.select("batch", "last.*")


def read_batches(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All batches' rows; the driver sees one path a batch, not their rows."""
    paths = [f"{folder}/{r.path}" for r in manifest(spark, folder).select("path").collect()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
