"""Structured answers of models, read though they are wrapped, damaged or cut off."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskb.functions.text import clean_json

_STRING = r'"(?:[^"\\]|\\.)*(?:"|\\?\Z)'
_MARKS = {"object": re.compile(rf"{_STRING}|[{{}}]", re.DOTALL), "array": re.compile(rf"{_STRING}|[\[\]]", re.DOTALL)}
_QUOTES = re.compile(r'\\.|"(?P<ends>\s*(?=[,}\]:]|\Z))?', re.DOTALL)
_COMMA = re.compile(r",\s*([}\]])")
_BETWEEN = re.compile(r"[\s,]*")


def balanced(text: str, expect: str) -> str | None:
    """The text from the first opening bracket to the one that closes it, strings aside; None if nothing does."""
    start = text.find("{" if expect == "object" else "[")
    depth = 0
    for mark in _MARKS[expect].finditer(text, start) if start >= 0 else ():
        depth += {"{": 1, "[": 1, "}": -1, "]": -1}.get(mark.group(), 0)
        if depth == 0 and mark.group() in "}]":
            return text[start : mark.end()]
    return None


def requoted(text: str) -> str:
    """The text with quotes within strings escaped: a quote ends a string only before a comma, colon, closing bracket or the end."""
    inside = False

    def one(mark: re.Match) -> str:
        nonlocal inside
        if not mark.group().startswith('"'):
            return mark.group()
        if inside and mark["ends"] is None:
            return '\\"'
        inside = not inside
        return mark.group()

    return _QUOTES.sub(one, text)


def leading_items(text: str) -> list:
    """The items of the first array as far as they are whole."""
    items, at, decoder = [], text.find("[") + 1, json.JSONDecoder()
    while at and (at := _BETWEEN.match(text, at).end()) < len(text) and text[at] != "]":
        try:
            item, at = decoder.raw_decode(text, at)
        except (ValueError, RecursionError):
            break
        items.append(item)
    return items


def candidates(text: str, expect: str) -> Iterator[tuple[str, str]]:
    """What an answer may be read as, likeliest first, with the name of what was done to it."""
    whole = balanced(text, expect)
    tried = set()
    for name, found in (("raw", text), ("balanced", whole), ("raw+repair_quotes", requoted(text)), ("balanced+repair_quotes", whole and requoted(whole))):
        found = (found or "").strip()
        if not found or found in tried:
            continue
        tried.add(found)
        yield name, found
        closed = _COMMA.sub(r"\1", found)
        if closed not in tried:
            tried.add(closed)
            yield f"{name}+fix_commas", closed


def read(text: str, expect: str) -> tuple[object, str]:
    """An answer's object or array and how it was found; (None, ``failed``) if there is none.

    Of an array that is cut off the whole items are read. What is nested more deeply than the interpreter's limit isn't read.
    """
    kind = dict if expect == "object" else list
    for name, found in candidates(text, expect):
        try:
            value = json.loads(found)
        except (ValueError, RecursionError):
            continue
        if isinstance(value, kind):
            return value, name
    if expect == "array":
        for name, found in (("partial_array", text), ("partial_array+repair_quotes", requoted(text))):
            if items := leading_items(found):
                return items, name
    return None, "failed"


def _written(value: object) -> str:
    out = json.dumps(value, ensure_ascii=False)
    try:
        out.encode()
    except UnicodeEncodeError:
        out = json.dumps(value)
    return out


def parsed(answers: DataFrame, text: str = "answer", expect: str = "array") -> DataFrame:
    """Answers with ``value``, the object or array that they hold as JSON, null if there is none, and the ``strategy`` that found it.

    Fences of code and the word json before an answer are taken off first. Null answers are empty: they fail. Rows are
    independent; an empty table gives no rows; other columns come back as they are.
    """
    if expect not in ("object", "array"):
        raise ValueError("expect is object or array")
    given = answers.select("*", clean_json(F.col(text)).alias("_clean"))
    schema = answers.select("*", F.lit("").cast("string").alias("value"), F.lit("").cast("string").alias("strategy")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, names = [], []
            for answer in batch.column(batch.num_columns - 1):
                value, name = read(answer.as_py() or "", expect)
                values.append(None if value is None else _written(value))
                names.append(name)
            columns = [*batch.columns[:-1], pa.array(values, pa.string()), pa.array(names, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "value", "strategy"])

    for field in schema.fields[-2:]:
        field.nullable = True
    return given.mapInArrow(run, schema)


def fact_items(answers: DataFrame) -> DataFrame:
    """The facts that parsed arrays hold, one row each with its place; parts that are no objects, or without a fact, are left out."""
    listed = answers.select("*", F.posexplode(F.from_json("value", "array<string>")).alias("pos", "_text")).where("_text like '{%'")
    read_ = listed.withColumn("_item", F.from_json("_text", "category string, subject string, fact string, time_scope string"))
    return read_.where("_item.fact is not null").select(*answers.columns, "pos", "_item.*")
