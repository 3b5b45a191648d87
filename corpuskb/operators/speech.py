"""Direct speech and inner monologues of texts, and the training pairs made from them.

All but the pairs from speech are row by row, without a shuffle; these need each text's lines in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskb.functions.speech import NARRATOR, first_person, is_silent, said, silent_speaker, speaker, voice_marks
from corpuskb.functions.text import strip_text


def _once(value: Column, f) -> Column:
    """``f`` of a value that is computed once a row: within lambdas a plain expression would be computed anew for every element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def direct_speech(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line_num, speaker, text, context_before, raw_line) of all lines with a dash before them.

    Context is what stands in the two lines before; the speaker may be named in the two lines after. Lines and speech of
    under five characters are dropped; null and empty texts give no rows, equal rows give equal rows.
    """
    near = lambda lines, start, n: F.array_join(F.filter(F.transform(F.slice(lines, start, n), strip_text), lambda x: x != ""), " ")
    numbered = lambda lines: F.transform(lines, lambda x, i: F.struct(strip_text(x).alias("line"), i.alias("i")))
    spoken = lambda lines: F.filter(numbered(lines), lambda x: x["line"].rlike(r"^([—–]|-\u00a0)"))
    # neighbours are only looked at for lines that speak
    beside = lambda lines: F.transform(spoken(lines), lambda x: F.struct(x["line"].alias("line"), x["i"].alias("i"), near(lines, F.greatest(x["i"] - 1, F.lit(1)), F.least(x["i"], F.lit(2))).alias("before"), near(lines, x["i"] + 2, F.lit(2)).alias("after")))
    found = _once(F.split(F.col(text), "\n"), beside)
    rows = texts.select(F.col(key), F.explode(found).alias("x"))
    rows = rows.withColumn("speech", strip_text(F.regexp_replace("x.line", r"(?U)^[—–]\s*", ""))).where("length(speech) >= 5")
    rows = rows.select(key, F.col("x.i").cast("long").alias("line_num"), speaker(F.col("speech"), F.col("x.after")).alias("speaker"), said(F.col("speech")).alias("text"), F.substring("x.before", 1, 200).alias("context_before"), F.col("x.line").alias("raw_line"))
    return rows.where("length(text) >= 5")


def pairs_from_speech(speech: DataFrame, key: str) -> DataFrame:
    """(key, line_num, user, assistant): the narrator's lines of 15 characters or more, asked by the line before.

    Another speaker's line asks by name, else what stood before, else a fixed request.
    """
    order = W.partitionBy(key).orderBy("line_num")
    rows = speech.withColumns({"asked_by": F.lag("speaker").over(order), "asked": F.lag("text").over(order)})
    rows = rows.where((F.col("speaker") == NARRATOR) & (F.length("text") >= 15))
    named = (F.col("asked_by") != NARRATOR) & (F.col("asked") != "")
    user = F.when(named, F.concat(F.lit("["), "asked_by", F.lit("]: "), "asked")).when(F.col("context_before") != "", F.concat(F.lit("[Ситуация]: "), "context_before")).otherwise("[Продолжай разговор]")
    return rows.select(key, "line_num", user.alias("user"), F.col("text").alias("assistant"))


def monologues(texts: DataFrame, key: str, text: str = "text", min_length: int = 80) -> DataFrame:
    """(key, pos, text, marker_count, first_person_count) of long paragraphs without a dash that sound like the narrator."""
    parts = texts.select(F.col(key), F.posexplode(F.split(F.col(text), r"(?U)\n\s*\n|\n")).alias("pos", "raw")).select(key, F.col("pos").cast("long").alias("pos"), strip_text(F.col("raw")).alias("text"))
    parts = parts.where((F.length("text") >= min_length) & ~F.col("text").rlike("^[—–]"))
    return parts.withColumns({"marker_count": voice_marks(F.col("text")), "first_person_count": first_person(F.col("text"))}).where("marker_count >= 1 or first_person_count >= 3")


def pairs_from_monologues(found: DataFrame, key: str, max_items: int = 500) -> DataFrame:
    """(key, pos, user, assistant) of a text's first ``max_items`` monologues of 30 to 1,000 characters, asked about their first sentence.

    The limit is the feature: it bounds how much one text contributes.
    """
    first = found.withColumn("k", F.row_number().over(W.partitionBy(key).orderBy("pos"))).where(F.col("k") <= max_items)
    topic = F.substring(strip_text(F.split("text", "[.!?]")[0]), 1, 100)
    return first.where("length(text) between 30 and 1000").select(key, "pos", F.concat(F.lit("[Расскажи, что ты думаешь о: "), topic, F.lit("]")).alias("user"), F.col("text").alias("assistant"))


def silent_speech(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line_num, speaker, text, context) of quotes of 5 to 300 characters in lines that, or whose neighbours, speak of silent speech.

    Each quote comes once in a text, whatever its case, the first one. Emphasis marks are not looked at. Null and empty texts give no rows.
    """
    near = lambda lines, i: strip_text(F.coalesce(F.get(lines, i), F.lit("")))
    quoted = lambda lines: F.filter(F.transform(lines, lambda x, i: F.struct(strip_text(x).alias("line"), i.alias("i"))), lambda x: (F.length(x["line"]) >= 10) & F.contains(x["line"], F.lit("«")))
    # missing neighbours add nothing, not even a space
    around = lambda lines, x: F.concat(x["line"], F.when(x["i"] > 0, F.concat(F.lit(" "), near(lines, x["i"] - 1))).otherwise(""), F.when(x["i"] + 1 < F.size(lines), F.concat(F.lit(" "), near(lines, x["i"] + 1))).otherwise(""))
    silent = lambda lines: F.filter(F.transform(quoted(lines), lambda x: F.struct(x["line"].alias("line"), x["i"].alias("i"), around(lines, x).alias("around"))), lambda x: is_silent(x["around"]))
    found = _once(F.split(F.col(text), "\n"), silent)
    rows = texts.select(F.col(key), F.explode(found).alias("x"))
    rows = rows.select(key, F.col("x.i").cast("long").alias("line_num"), silent_speaker(F.col("x.around")).alias("speaker"), F.substring("x.line", 1, 200).alias("context"), F.posexplode(F.regexp_extract_all("x.line", F.lit("«([^»]{5,300})»"), F.lit(1))).alias("k", "text"))
    first = rows.groupBy(key, F.md5(F.lower("text")).alias("h")).agg(F.min_by(F.struct("line_num", "speaker", "text", "context"), F.struct("line_num", "k")).alias("x"))
    return first.select(key, "x.*")


def pairs_from_silent(found: DataFrame, key: str) -> DataFrame:
    """(key, line_num, user, assistant) of what the narrator says silently, from 15 characters on."""
    return found.where((F.col("speaker") == NARRATOR) & (F.length("text") >= 15)).select(key, "line_num", F.concat(F.lit("[Безмолвная речь] "), F.substring("context", 1, 200)).alias("user"), F.col("text").alias("assistant"))


def training_pair(said_: Column, kind: Column, context: Column, other: Column, other_says: Column) -> Column:
    """(user, assistant) of one extracted dialogue, null if under ten characters are said; a missing kind is a dialogue."""
    said_, context, other_says = strip_text(said_), strip_text(context), strip_text(other_says)
    kind, silent = F.coalesce(kind, F.lit("dialogue")), kind == "silent_speech"
    scene = F.concat(F.lit("["), context, F.lit("]\n\n"))
    name = F.when(other != "", F.concat(other, F.lit(": "))).otherwise("")
    user = (
        F.when(kind.isin("dialogue", "silent_speech") & (other_says != ""), F.concat(scene, F.when(silent, "[Безмолвная речь] ").otherwise(""), name, other_says))
        .when((kind == "monologue") & (context != ""), F.concat(scene, F.lit("Что ты об этом думаешь?")))
        .when(silent & (context != ""), F.concat(scene, F.lit("[Безмолвная речь] Что скажешь?")))
        .when(context != "", context)
        .otherwise("Расскажи, что происходит.")
    )
    return F.when(F.length(said_) >= 10, F.struct(user.alias("user"), said_.alias("assistant")))


def style_candidates(rows: DataFrame, text: str) -> DataFrame:
    """The rows whose text has between 30 and 300 characters, both excluded; all rows if none has."""
    fits = (F.length(text) > 30) & (F.length(text) < 300)
    # one flag
    some = rows.agg(F.coalesce(F.bool_or(fits), F.lit(False)).alias("__some"))
    return rows.crossJoin(F.broadcast(some)).where(F.coalesce(fits, F.lit(False)) | ~F.col("__some")).drop("__some")
