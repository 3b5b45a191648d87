"""Resuming after a run that ended early."""

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpuskb.operators import checkpoints
from corpuskb.sources import batches

SCHEMA = "k long, v string"


def digest(text):
    return hashlib.md5((text or "").strip().lower().encode()).hexdigest()[:12]


def test_killed_and_rerun_batches(spark, tmp_path):
    folder = f"file://{tmp_path}/table"
    rows = lambda n, v: spark.range(n, numPartitions=4).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    read = lambda: sorted(tuple(r) for r in batches.read_batches(spark, folder, SCHEMA).collect())
    assert read() == []
    batches.write_batch(rows(10, "a"), folder, "one")
    first = [(k, "a") for k in range(10)]
    assert read() == first
    # one task fails after others have written
    broken = rows(100, "b").withColumn("v", F.when(F.col("k") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(PySparkException):
        batches.write_batch(broken, folder, "two")
    assert read() == first
    # a job killed between the data and the manifest
    rows(5, "c").write.parquet(f"{folder}/data/unnamed")
    assert read() == first
    for _ in range(2):
        batches.write_batch(rows(100, "b"), folder, "two")
        assert read() == sorted(first + [(k, "b") for k in range(100)])
    batches.write_batch(rows(0, "a"), folder, "one")
    assert read() == [(k, "b") for k in range(100)]
    assert {r.batch: r.n_rows for r in batches.manifest(spark, folder).collect()} == {"one": 0, "two": 100}


def test_last_valid_record_of_a_chunk(spark):
    chunks = [("a", 0, "Текст"), ("a", 1, None), ("b", 0, "иной"), ("b", 1, "новый")]
    records = [
        ("a", 0, digest("текст "), 1, "old"), ("a", 0, digest("текст"), 5, "last"), ("a", 0, digest("другой"), 9, "stale"), ("a", 1, digest(""), 2, None),
        ("a", 7, digest("x"), 1, "gone"), ("b", None, digest("иной"), 1, "no idx"), ("b", 0, None, 1, "no hash"), (None, 0, digest("иной"), 1, "no book"),
        ("b", 1, digest("новый"), 3, "tie a"), ("b", 1, digest("новый"), 3, "tie b"), ("b", 1, digest("новый"), 3, "tie b"),
    ]
    held = spark.createDataFrame(chunks, "book string, idx long, chunk string").withColumn("seq_", F.lit(1))
    made = spark.createDataFrame(records, "book string, idx long, chunk_hash string, seq long, made string")
    got = {(r.book, r.idx): (r.done, r.made) for r in checkpoints.resumed(made, held).collect()}
    assert got == {("a", 0): (True, "last"), ("a", 1): (True, None), ("b", 0): (False, None), ("b", 1): (True, "tie b")}
    assert [(r.book, r.idx) for r in checkpoints.pending(made, held).collect()] == [("b", 0)]
    assert checkpoints.pending(made.limit(0), held).count() == 4 and checkpoints.resumed(made, held.limit(0)).count() == 0
    with pytest.raises(ValueError, match="made"):
        checkpoints.resumed(made, held.withColumn("made", F.lit(1)))


def test_progress_of_synthesis(spark):
    records = spark.createDataFrame([("h", ("q", "a")), ("h", ("q", "b")), ("i", None), ("", ("x", "y")), (None, ("x", "y"))], "fact_hash string, pair struct<q:string,a:string>")
    done, pairs = checkpoints.synthesis_progress(records)
    assert sorted(r.fact_hash for r in done.collect()) == ["h", "i"] and sorted(r.a for r in pairs.collect()) == ["a", "b"]
    facts = spark.createDataFrame([("h", 1), ("j", 2), ("j", 2), (None, 3)], "fact_hash string, _part int").withColumnRenamed("_part", "n")
    assert sorted(r.n for r in checkpoints.facts_to_do(facts, records).collect()) == [2, 2, 3]
