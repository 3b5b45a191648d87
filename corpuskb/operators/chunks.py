"""Books to chunks: lines, headings carried forward, sections, greedy packing by size, degenerate texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskb.functions.text import estimate_tokens, is_scene_break, looks_like_heading, once, strip_text


def paragraphs(docs: DataFrame, separator: str = r"(?U)\n\s*\n+") -> DataFrame:
    """(doc_id, pos, paragraph) of the non-empty stripped parts of every text between blank lines; null texts have none."""
    parts = docs.select("doc_id", F.posexplode(F.split("text", separator)).alias("pos", "raw"))
    return parts.select("doc_id", "pos", strip_text(F.col("raw")).alias("paragraph")).where("paragraph <> ''")


def with_chapter(parts: DataFrame, default: str = "-") -> DataFrame:
    """Paragraphs with the last heading at or before them and the number of their section."""
    so_far = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    heading = F.when(looks_like_heading(F.col("paragraph")), F.col("paragraph"))
    return parts.select("*", F.coalesce(F.last(heading, ignorenulls=True).over(so_far), F.lit(default)).alias("chapter"), F.count(heading).over(so_far).alias("section"))


def packed(docs: DataFrame, limit: int = 2500) -> DataFrame:
    """(doc_id, idx, chunk_text, est_tokens): paragraphs packed greedily in order up to ``limit`` characters; a longer one stands alone."""
    parts = F.filter(F.transform(F.split("text", "\n"), strip_text), lambda p: p != "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found in batch.column(1).to_pylist():
                start, held, chunks = 0, -2, []
                for k, p in enumerate(found or ()):
                    if k > start and held + 2 + len(p) > limit:
                        chunks.append("\n\n".join(found[start:k]))
                        start, held = k, -2
                    held += 2 + len(p)
                out.append([*chunks, "\n\n".join(found[start:])] if found else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], ["doc_id", "chunks"])

    chunks = docs.select("doc_id", parts.alias("parts")).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, chunks array<string>")
    out = chunks.select("doc_id", F.posexplode("chunks").alias("idx", "chunk_text"))
    return out.select("doc_id", "idx", "chunk_text", estimate_tokens(F.col("chunk_text")).alias("est_tokens"))


SECTION_BREAK = "[[SECTION_BREAK]]"


def sections(parts: DataFrame) -> DataFrame:
    """Paragraphs with the number of their section and whether they are headings; breaks end one and go, a heading begins one unless it is the first."""
    broken = (F.col("paragraph") == SECTION_BREAK) | is_scene_break(F.col("paragraph"))
    order = W.partitionBy("doc_id").orderBy("pos")
    # each line is judged once, before lines are put in order
    judged = parts.select("*", broken.alias("_broken"), looks_like_heading(F.col("paragraph")).alias("_heading"))
    marked = judged.select("*", F.lag("_broken", 1, True).over(order).alias("_after"))
    begins = ~F.col("_broken") & (F.col("_after") | F.col("_heading"))
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    return marked.withColumn("section", F.sum(begins.cast("int")).over(so_far)).where("not _broken").withColumnRenamed("_heading", "heading").drop("_broken", "_after")


def _commonest(found: Column) -> Column:
    """How often the commonest element of an array occurs: the longest stretch of equal ones when sorted."""
    start = F.struct(F.lit(None).cast("string").alias("at"), F.lit(0).alias("run"), F.lit(0).alias("top"))

    def step(state: Column, x: Column) -> Column:
        run = F.when(state["at"].eqNullSafe(x), state["run"] + 1).otherwise(1)
        return F.struct(x.alias("at"), run.alias("run"), F.greatest(state["top"], run).alias("top"))

    return F.aggregate(F.array_sort(found), start, step)["top"].cast("long")


def degenerate(docs: DataFrame, min_lines: int = 8, min_words: int = 20) -> DataFrame:
    """Texts of 200 characters or more in which one line makes up over 60 % of the lines, or one run of four words over 35 % of all runs.

    Both rules need a least number of lines or words; texts that neither fits are not returned. Each row is judged by itself,
    without a shuffle; rows that share an id are judged apart.
    """
    lines = F.filter(F.transform(F.split("text", "\n"), strip_text), lambda x: x != "")
    words = F.filter(F.split(F.lower(strip_text(F.col("text"))), r"(?U)\s+"), lambda w: w != "")
    counts = lambda found: F.struct(F.size(found).cast("long").alias("n"), _commonest(found).alias("top"))
    fours = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - 3), lambda k: F.array_join(F.slice(w, k, 4), " "))
    of_lines = once(lines, lambda x: F.when(F.size(x) > 0, counts(x)))
    of_runs = once(words, lambda w: F.when(F.size(w) >= min_words, once(fours(w), counts)))
    counted = docs.where(F.length("text") >= 200).select("doc_id", of_lines.alias("l"), of_runs.alias("r"))
    counted = counted.select("doc_id", F.col("l.n").alias("n_lines"), F.col("l.top").alias("top_lines"), F.col("r.n").alias("n_runs"), F.col("r.top").alias("top_runs"))
    return counted.where(f"n_lines >= {min_lines} and top_lines > 0.6 * n_lines or top_runs > 0.35 * n_runs")
