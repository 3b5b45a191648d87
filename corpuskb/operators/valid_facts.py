"""Extracted facts checked against rules and the chunk that they come from."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskb.functions import fact_rules as rules
from corpuskb.functions.canon import character_identity, placeholder
from corpuskb.functions.facts import grounding_keys, normalized_subject, stem, time_scope
from corpuskb.functions.text import norm_text, once, primary_chunk, strip_text
from corpuskb.sources.scratch import stored

#: Facts of one chunk that are looked up in one task; a chunk with more goes to several.
_PART = 20_000
_MET = ("named", "told", "whole", "n_keys", "n_primary", "n_words", "words", "n_said", "said")


def early(category: Column, subject: Column, fact: Column) -> list[tuple[str, Column]]:
    """The rules that need no chunk, each with the reason for which it rejects."""
    return [
        ("short_fact", F.length(fact) < 10),
        ("short_subject", F.length(subject) < 2),
        ("bad_category", ~category.isin(*rules.CATEGORIES)),
        ("placeholder_subject", ((category == "custom") & character_identity(subject)) | placeholder(subject, category)),
    ]


def cascade(category: Column, subject: Column, fact: Column) -> list[tuple[str, Column]]:
    """The rules that follow, in order; they name columns of ``grounded``."""
    return [
        ("ungrounded_subject", ~F.col("_subject_grounded")),
        ("ungrounded_fact", ~F.col("_fact_grounded")),
        ("subject_fact_mismatch", ~rules.anchored(fact, category, subject)),
        ("generic_fact", rules.empty_statement(fact, category, subject)),
        ("too_local_fact", rules.passing_statement(fact, category, subject)),
    ]


def _reason(broken: list[tuple[str, Column]]) -> Column:
    out = F.lit(None).cast("string")
    for name, rule in reversed(broken):
        out = F.when(rule, name).otherwise(out)
    return out


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their chunk, its text before its facts: facts with what the text has of them.

    One text's words are held at a time. ``_met`` is null where there is no text: whether there is a subject, it is the narrator
    and they speak, or it stands there whole; how many words the text and its primary part have; how many the subject and the
    fact have, and how many of these are there.
    """
    kind = pa.struct([*((n, pa.bool_()) for n in _MET[:3]), *((n, pa.int64()) for n in _MET[3:])])
    here, text, told, keys, primary = None, "", False, frozenset(), frozenset()
    count = lambda pairs, known: sum(p["t"] in known or (len(p["s"]) >= 4 and p["s"] in known) for p in pairs)
    for batch in batches:
        column = {n: batch.column(n) for n in batch.schema.names}
        asks = column["_asks"].to_pylist()
        met, places = [], []
        for k, chunk in enumerate(column["_chunk"].to_pylist()):
            if asks[k] is None:
                here, text, told = chunk, f" {column['_text'][k].as_py()} ", column["_told"][k].as_py()
                keys = frozenset(column["_keys"][k].as_py())
                primary = frozenset(column["_primary"][k].as_py()) if column["_primary"][k].is_valid else keys
                continue
            places.append(k)
            a = asks[k]["of"]
            some = chunk is not None and chunk == here and len(text) > 2 and a is not None
            found = (a["n"] != "", told and a["self"], f" {a['n']} " in text, len(keys), len(primary), len(a["words"]), count(a["words"], keys), len(a["said"]), count(a["said"], primary)) if some else None
            met.append(found and dict(zip(_MET, found, strict=True)))
        yield pa.RecordBatch.from_arrays([column["_item"].take(pa.array(places, pa.int64())), pa.array(met, kind)], ["_item", "_met"])


def grounded(items: DataFrame, given: DataFrame) -> DataFrame:
    """Items (category, subject, fact, _chunk, _reason) with whether their subject and fact are grounded in the text (_chunk, _text); what has a reason is not looked up.

    Texts meet their facts in order of the chunk, so neither a text nor its words are copied for each fact: what is dealt
    out is as long as both tables. The facts of a chunk that has very many are dealt into parts, each with the text.
    """
    counts = items.where("_chunk is not null").groupBy("_chunk").agg(F.count("*").alias("n")).where(F.col("n") > _PART)
    # there is at most one such chunk for each _PART facts
    many = F.broadcast(stored(counts.select("_chunk", F.floor(F.col("n") / _PART).cast("int").alias("_parts")), "large-chunks"))
    category, subject, fact = F.col("category"), F.col("subject"), F.col("fact")
    stemmed = lambda found: F.transform(found, lambda t: F.struct(t.alias("t"), stem(t).alias("s")))
    wanted = once(normalized_subject(subject), lambda n: F.struct(n.alias("n"), rules.first_person_subject(n).alias("self"), stemmed(rules.subject_words(subject, category)).alias("words"), stemmed(rules.fact_words(fact, category, subject)).alias("said")))
    nothing = F.lit(None).cast("struct<n:string,self:boolean,words:array<struct<t:string,s:string>>,said:array<struct<t:string,s:string>>>")
    asks = F.struct(F.when(F.col("_reason").isNull(), wanted).otherwise(nothing).alias("of"))
    none = {"_text": F.lit(None).cast("string"), "_told": F.lit(None).cast("boolean"), "_keys": F.lit(None).cast("array<string>"), "_primary": F.lit(None).cast("array<string>")}
    kept = [c for c in items.columns if c != "_chunk"]
    facts = items.join(many, "_chunk", "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*kept), F.col("_parts") + 1), F.lit(0)).cast("int"))
    facts = facts.select("_chunk", "_part", asks.alias("_asks"), F.struct(*kept).alias("_item"), *(v.alias(c) for c, v in none.items()))
    # texts may lie in one file, so they are dealt out before their words are found
    texts = given.where("_chunk is not null").repartition("_chunk").withColumn("_main", primary_chunk(F.col("_text")))
    words = texts.select("_chunk", norm_text(F.col("_text")).alias("_text"), grounding_keys(F.col("_text")).alias("_keys"), F.when(F.col("_main") != F.col("_text"), grounding_keys(F.col("_main"))).alias("_primary"))
    words = words.join(many, "_chunk", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(0)))))
    kinds = {f.name: f.dataType for f in facts.schema.fields}
    words = words.select("_chunk", "_part", F.lit(None).cast(kinds["_asks"]).alias("_asks"), F.lit(None).cast(kinds["_item"]).alias("_item"), "_text", rules.speaks(F.col("_text")).alias("_told"), "_keys", "_primary")
    ordered = facts.unionByName(words).withColumn("_fact", F.col("_asks").isNotNull()).repartition("_chunk", "_part").sortWithinPartitions("_chunk", "_part", "_fact").drop("_fact")
    kind = ",".join(f"{n}:{'boolean' if k < 3 else 'long'}" for k, n in enumerate(_MET))
    met = ordered.mapInArrow(_looked_up, f"_item {kinds['_item'].simpleString()}, _met struct<{kind}>").select("_item.*", "_met")
    m = F.col("_met")
    of_subject = m["named"] & (m["told"] | m["whole"] | (m["n_keys"] == 0) | rules.enough_subject_words(m["n_words"], m["words"]))
    of_fact = (m["n_primary"] == 0) | rules.enough_fact_words(m["n_said"], m["said"], category)
    return met.withColumn("_subject_grounded", m.isNull() | of_subject).withColumn("_fact_grounded", m.isNull() | of_fact).drop("_met")


def validate(items: DataFrame, chunks: DataFrame | None = None, item_key: str = "chunk_id", chunk_key: str = "chunk_id", text: str = "text") -> DataFrame:
    """Facts (category, subject, fact, time_scope, key of their chunk), normalized, with the first ``reason`` to reject them, null if they are valid.

    The rules stand in ``early`` and ``cascade``; a later one isn't computed for what an earlier one rejects. Grounds are looked for in the
    chunk's text, those of facts in its primary part; without a chunk, or in an empty one, all is grounded. A chunk's words are
    found once, not for each of its facts. Null texts are empty; repeated rows stay; an empty table gives no rows; further
    columns come back as they are.
    """
    category, subject, fact = F.col("category"), F.col("subject"), F.col("fact")
    clean = items.withColumns({"category": rules.category_of(category), "subject": strip_text(subject), "fact": strip_text(fact)}).withColumn("_reason", _reason(early(category, subject, fact)))
    if chunks is None:
        met = clean.withColumns({"_subject_grounded": F.lit(True), "_fact_grounded": F.lit(True)})
    else:
        given = chunks.select(F.col(chunk_key).cast("string").alias("_chunk"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
        met = grounded(clean.withColumn("_chunk", F.col(item_key).cast("string")), given)
    reason = F.when(F.col("_reason").isNotNull(), F.col("_reason")).otherwise(_reason(cascade(category, subject, fact)))
    judged = met.withColumn("reason", reason).withColumn("time_scope", time_scope(F.col("time_scope"), fact, category))
    return judged.select(*items.columns, "reason")


def rejections(validated: DataFrame) -> DataFrame:
    """How many facts each reason rejects; valid ones count under ``valid``."""
    return validated.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))
