"""Readers and writers of books, JSON lines and measurement tables."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def flatten_book(content: bytes) -> str:
    """Paragraphs of an XML book, titles and verses among them, with blank lines between; empty if it can't be parsed."""
    try:
        root = ElementTree.fromstring(content)
    except ElementTree.ParseError:
        return ""
    name = lambda e: e.tag.rpartition("}")[2]
    out: list[str] = []

    def walk(element) -> None:
        for child in element:
            if name(child) in ("p", "v", "subtitle", "text-author"):
                out.append(" ".join("".join(child.itertext()).split()))
            elif name(child) != "binary":
                walk(child)

    for body in root:
        if name(body) == "body" and body.get("name") not in ("notes", "comments"):
            walk(body)
    return "\n\n".join(p for p in out if p)


@F.pandas_udf(StringType())
def _text(path: pd.Series, content: pd.Series) -> pd.Series:
    def one(p: str, c: bytes) -> str | None:
        if p.endswith(".zip"):
            try:
                with zipfile.ZipFile(io.BytesIO(c)) as z:
                    inner = [n for n in z.namelist() if n.endswith(".fb2")]
                    return flatten_book(z.read(inner[0])) if inner else None
            except zipfile.BadZipFile:
                return None
        return flatten_book(c) if p.endswith(".fb2") else c.decode("utf-8", "replace")

    return pd.Series([one(p, c) for p, c in zip(path, content, strict=True)])


def read_books(spark: SparkSession, folder: str) -> DataFrame:
    """(book, text) of the .txt, .fb2 and zipped books below a folder that have over 100 characters."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).where(F.col("path").rlike(r"\.(txt|fb2|zip)$"))
    return files.select(F.col("path").alias("book"), _text("path", "content").alias("text")).where(F.length(F.trim("text")) > 100)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines; malformed ones are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def append_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def measurements(spark: SparkSession, path: str) -> DataFrame:
    """(metric, n, least, mean, most) of a CSV table's numeric cells; cells that are no numbers are skipped."""
    rows = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).csv(path)
    cells = rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.expr(f"try_cast(regexp_extract(`{c}`, '^[-0-9.]+', 0) as double)").alias("value")) for c in rows.columns))).alias("x")).select("x.*")
    return cells.where("value is not null").groupBy("metric").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.avg("value").alias("mean"), F.max("value").alias("most"))
