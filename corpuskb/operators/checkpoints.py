"""What is left to do of chunks, and what was made of them, after a run that ended early."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskb.functions.text import strip_text, text_hash12
from corpuskb.operators.joins import spread


def resumed(records: DataFrame, chunks: DataFrame, key: str = "book") -> DataFrame:
    """Each chunk (key, idx, chunk) with the last valid record of it, and whether it is ``done``; further columns of both stay.

    A record (key, idx, chunk_hash, seq, further columns) is valid if its chunk is still there and has the text that the hash
    was made of; of several valid ones that of the highest seq counts, equal ones by their further columns. (key, idx) is
    unique in chunks. A chunk without a valid record has nulls. Records of other chunks, without an idx or a hash go; a null
    chunk is empty; empty tables are no records, or no chunks.
    """
    further = [c for c in records.columns if c not in (key, "idx", "chunk_hash", "seq")]
    clash = set(further) & set(chunks.columns)
    if clash:
        raise ValueError(f"columns of both records and chunks: {sorted(clash)}")
    told = F.struct("seq", *further)
    # the last record of each text that a chunk ever had, before the join; the text decides between these
    last = records.where(F.col("idx").isNotNull() & F.col("chunk_hash").isNotNull()).groupBy(key, "idx", "chunk_hash").agg(F.max(told).alias("_told"))
    mine = chunks.withColumn("chunk_hash", text_hash12(F.col("chunk")))
    met = mine.join(last, [key, "idx", "chunk_hash"], "left")
    return met.select(*chunks.columns, F.col("_told").isNotNull().alias("done"), *(F.col(f"_told.{c}").alias(c) for c in further))


def pending(records: DataFrame, chunks: DataFrame, key: str = "book") -> DataFrame:
    """The chunks that no valid record stands for; see ``resumed``."""
    return resumed(records, chunks, key).where("not done").select(*chunks.columns)


def synthesis_progress(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of records (fact_hash, pair) the facts that are done, each once, and the pairs made of them, all that there are.

    Records without a hash count for neither; a fact of which nothing could be made has no pair and is done all the same.
    """
    valid = records.where(F.coalesce("fact_hash", F.lit("")) != "")
    return valid.select("fact_hash").distinct(), valid.where("pair is not null").select("pair.*")


def facts_to_do(facts: DataFrame, records: DataFrame, fact_hash: str = "fact_hash") -> DataFrame:
    """Facts that no record of progress names; a hash that many facts have is spread over all tasks."""
    done = synthesis_progress(records)[0].select(F.col("fact_hash").alias("_hash"), F.lit(True).alias("_done"))
    met = spread(facts.withColumn("_hash", strip_text(F.col(fact_hash))), done, ["_hash"])
    return met.where("_done is null").select(*facts.columns)
