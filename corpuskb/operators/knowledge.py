"""Facts: line protocol, time scopes, alias maps and first-wins fuzzy deduplication."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskb.functions.text import norm_text

def parse_lines(responses: DataFrame) -> DataFrame:
    """(resp_id, line_no, category, subject, fact, time_scope) of ``k=v | k=v`` and ``category | subject | fact | scope`` lines."""
    lines = responses.select("resp_id", F.posexplode(F.split("response", "\n")).alias("line_no", "line"))
    clean = F.trim(F.regexp_replace("line", r"^\s*([-*•]|[0-9]+[.)])\s*", ""))
    named = lambda key: F.nullif(F.trim(F.regexp_extract(clean, rf"(?i)(?:^|\|)\s*{key}\s*[=:]\s*([^|]*)", 1)), F.lit(""))
    parts = F.split(clean, r"\|")
    place = lambda k: F.when(~clean.contains("=") & (F.size(parts) >= 4), F.nullif(F.trim(F.element_at(parts, k)), F.lit("")))
    out = lines.select("resp_id", "line_no", *(F.coalesce(named(key), place(k)).alias(key) for k, key in enumerate(("category", "subject", "fact", "time_scope"), 1)))
    return out.where("category is not null and subject is not null and fact is not null")


def alias_map(subjects: DataFrame) -> DataFrame:
    """(alias, canonical): a one-word name stands for the only longer name that begins with it."""
    known = subjects.select("subject", norm_text(F.col("subject")).alias("key")).where("key <> ''").groupBy("key").agg(F.min("subject").alias("subject"))
    full = known.where("key like '% %'").groupBy(F.substring_index("key", " ", 1).alias("alias")).agg(F.min("subject").alias("canonical"), F.count("*").alias("n")).where("n = 1")
    return known.where("not key like '% %'").join(full, known["key"] == full["alias"]).select("alias", "canonical")


def first_facts(facts: DataFrame) -> DataFrame:
    """Facts (ord, subject, fact, scope) without later ones that say the same: exact keys by aggregate, then fuzzily.

    Facts are only compared if their normalized subjects share the first word, and not if both scopes are
    definite and differ. A word's rows stream in order through one task, after exact copies have gone.
    """
    keyed = facts.select("*", norm_text(F.col("subject")).alias("ks"), norm_text(F.col("fact")).alias("kf"))
    exact = keyed.groupBy("ks", "kf", "scope").agg(F.min(F.struct("ord", "subject", "fact")).alias("x")).select("x.*", "scope", "ks", "kf", F.substring_index("ks", " ", 1).alias("word"))
    ordered = exact.repartition("word").sortWithinPartitions("word", "ord")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, kept = None, []
        for frame in batches:
            keep = []
            for word, subject, fact, scope in zip(frame["word"], frame["ks"], frame["kf"], frame["scope"], strict=True):
                if word != here:
                    here, kept = word, []
                definite = ("past", "current", "change", "ended")
                same = any(s == subject and not (scope in definite and o in definite and scope != o) and difflib.SequenceMatcher(None, fact, f).ratio() >= 0.88 for s, f, o in kept)
                keep.append(not same)
                if not same:
                    kept.append((subject, fact, scope))
            yield frame[keep]

    return ordered.mapInPandas(run, ordered.schema).select("ord", "subject", "fact", "scope")
