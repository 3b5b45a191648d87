"""Facts of a chapter with the chunks around them, and edges of the timeline's graph without doubles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskb.functions.names import default_chapter, relation_type
from corpuskb.functions.text import strip_text


def _placed(facts: DataFrame) -> DataFrame:
    chapter = strip_text(F.col("chapter"))
    return facts.withColumn("book", strip_text(F.col("book"))).where("book <> ''").withColumn("chapter", F.when(chapter != "", chapter).otherwise(default_chapter(F.col("book"))))


def groups(facts: DataFrame) -> DataFrame:
    """(book, chapter, n_facts, n_chunks, first_chunk) of facts (book, chapter, chunk_idx); no chapter is the book's own.

    Facts without a book are dropped; a group without chunks has a null first chunk. Sort by book, first chunk, chapter.
    """
    return _placed(facts).groupBy("book", "chapter").agg(F.count("*").alias("n_facts"), F.count_distinct("chunk_idx").alias("n_chunks"), F.min("chunk_idx").alias("first_chunk"))


def group_chunks(facts: DataFrame, chunks: DataFrame, around: int = 1, most: int = 6) -> DataFrame:
    """(book, chapter, idx, place) of the first ``most`` of the chunks (book, idx) that hold a group's facts or lie near them.

    Chunk numbers are made distinct before they are widened and joined; only ``most`` a group stay, which is the feature.
    """
    held = _placed(facts).where("chunk_idx is not null").select("book", "chapter", "chunk_idx").distinct()
    wide = held.select("book", "chapter", F.explode(F.sequence(F.col("chunk_idx") - around, F.col("chunk_idx") + around)).alias("idx")).distinct()
    place = F.row_number().over(W.partitionBy("book", "chapter").orderBy("idx"))
    return wide.join(chunks.select("book", "idx").distinct(), ["book", "idx"]).select("book", "chapter", "idx", place.cast("long").alias("place")).where(F.col("place") <= most)


def unique_edges(edges: DataFrame, order: str) -> DataFrame:
    """Edges (source, target, type, book, chapter, chunk_indices, evidence, confidence) without loops and empty ends, the first of equals by order.

    Unknown types are ``related_to``, chunks are sorted, a missing confidence is ``explicit``.
    """
    rows = edges.where("source <> '' and target <> '' and source <> target")
    rows = rows.withColumns({"type": relation_type(F.col("type")), "chunk_indices": F.sort_array(F.coalesce("chunk_indices", F.array().cast("array<bigint>")))})
    rows = rows.withColumns({c: strip_text(F.col(c)) for c in ("evidence", "confidence")})
    first = rows.groupBy("source", "target", "type", "book", "chapter", "chunk_indices").agg(F.min_by(F.struct("evidence", "confidence"), order).alias("x"))
    return first.select("source", "target", "type", "book", "chapter", "chunk_indices", "x.evidence", F.when(F.col("x.confidence") != "", F.col("x.confidence")).otherwise("explicit").alias("confidence"))
