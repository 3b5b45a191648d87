"""Corpus cleaning from documents to packed training sequences: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskb.llm import minhash, packing, pii, quality, repeats
from corpuskb.llm.queries import VOCABULARY
from corpuskb.llm.store import materialize, table


def _measured(docs: DataFrame) -> DataFrame:
    """The count of characters follows the text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label quality classifier keeps."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near-duplicates."""
    return minhash.drop_near_copies(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without byte strings that repeat; rows stay even if nothing is left of their text."""
    return _measured(repeats.remove(docs))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind."""
    return _measured(pii.redact(docs, pii.trained()))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048, one row per piece of a document."""
    return packing.pack(docs, VOCABULARY, 2048, 1)


STAGES = [("quality", good), ("near_dedup", distinct), ("suffix_dedup", unrepeated), ("pii", private), ("packing", packed)]

#: The stages train models and hash texts, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
