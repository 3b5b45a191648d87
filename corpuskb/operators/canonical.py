"""Canonical subjects of facts, within a book and over all books.

Items have book, narrator, ord, category, subject, fact and time_scope; ord is unique. All that concerns a subject is found
once for each distinct one and then joined to its items, so a name that a third of all items bear is one row until then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskb.functions.canon import EXACT_ONLY, NARRATOR, canonical_character, character_fact, narrator_fact, narrator_subject, place_fact, placeholder
from corpuskb.functions.facts import canonical_place, normalized_subject, time_scope, without_honorifics
from corpuskb.functions.text import norm_text, strip_text, tokens
from corpuskb.operators.joins import spread
from corpuskb.sources.scratch import stored

_SUBJECT = ["book", "narrator", "category", "subject"]


def _fuller(column: str):
    """The name of most words, then of most characters, then the last one."""
    return F.max_by(column, F.struct(F.size(tokens(F.col(column))), F.length(column), F.col(column)))


def character_aliases(subjects: DataFrame, known: dict[str, str] | None = None, exact_only: tuple[str, ...] = EXACT_ONLY) -> DataFrame:
    """(book, key, canonical): the name for each normalized subject of a character, from (book, narrator, category, subject, ord).

    Known names stand for themselves. Another name of one word stands for the only longer name of its book that begins with
    it; if there are several, for itself. Of the spellings of a name the fullest is shown. Where subjects share a key
    the last one counts. Subjects too general to keep give no names.
    """
    named = subjects.where("category = 'character'").withColumn("subject", F.when(F.coalesce("narrator", F.lit("")) == "", strip_text(F.col("subject"))).otherwise(narrator_subject(F.col("subject"), F.col("narrator"))))
    named = named.where((F.col("subject") != "") & ~placeholder(F.col("subject"), F.col("category"), F.col("narrator")))
    named = named.withColumn("shown", without_honorifics(F.col("subject"))).withColumn("core", norm_text(F.col("shown"))).where("core <> ''")
    named = named.withColumn("forced", canonical_character(F.col("shown"), known, exact_only)).withColumn("target", F.coalesce(normalized_subject(F.col("forced")), F.col("core")))
    named = stored(named.where("core <> ''"), "characters")
    best = named.groupBy("book", "core").agg(_fuller("shown").alias("shown"))
    forced = named.where("forced is not null").groupBy("book", F.col("target").alias("core")).agg(F.max("forced").alias("forced"))
    best = best.join(forced, ["book", "core"], "full").select("book", F.col("core").alias("target"), F.coalesce("forced", "shown").alias("canonical"))
    first = F.substring_index("core", " ", 1)
    only = named.where(F.contains("core", F.lit(" "))).groupBy("book", first.alias("core")).agg(F.min("core").alias("full"), F.count_distinct("core").alias("n")).where("n = 1").drop("n")
    named = named.join(only, ["book", "core"], "left").withColumn("target", F.when(F.col("forced").isNull() & ~F.contains("core", F.lit(" ")), F.coalesce("full", "core")).otherwise(F.col("target")))
    named = named.join(best, ["book", "target"])
    return _last_named(named)


def place_aliases(subjects: DataFrame) -> DataFrame:
    """(book, key, canonical): the name for each normalized subject of a place; the fullest spelling of its canonical form."""
    named = subjects.where("category = 'place'").withColumn("shown", canonical_place(F.col("subject")))
    named = named.where((F.col("shown") != "") & ~placeholder(F.col("shown"), F.col("category"), F.col("narrator"))).withColumn("core", norm_text(F.col("shown")))
    named = stored(named, "places")
    return _last_named(named.join(named.groupBy("book", "core").agg(_fuller("shown").alias("canonical")), ["book", "core"]))


def _last_named(named: DataFrame) -> DataFrame:
    keys = named.select("book", "ord", "canonical", F.explode(F.array_distinct(F.array(norm_text(F.col("subject")), norm_text(F.col("shown"))))).alias("key"))
    return keys.groupBy("book", "key").agg(F.max_by("canonical", "ord").alias("canonical"))


def _renamed(items: DataFrame, known: dict[str, str] | None, exact_only: tuple[str, ...]) -> DataFrame:
    """Items under their subjects' canonical names, facts rewritten and scopes normalized, without those too general."""
    items = items.withColumn("subject", strip_text(F.col("subject"))).withColumn("fact", strip_text(F.col("fact")))
    # read three times below, so written once
    items = stored(items.withColumn("narrator", F.coalesce("narrator", F.lit(""))).withColumn("category", F.coalesce("category", F.lit(""))), "items")
    subjects = stored(items.groupBy(*_SUBJECT).agg(F.max("ord").alias("ord")), "subjects")
    keyed = subjects.drop("ord").withColumn("key", norm_text(F.col("subject")))
    aliases = character_aliases(subjects, known, exact_only).withColumn("category", F.lit("character")).unionByName(place_aliases(subjects).withColumn("category", F.lit("place")))
    named = keyed.join(aliases, ["book", "category", "key"], "left")
    own = F.when(F.col("category") == "character", without_honorifics(F.col("subject"))).when(F.col("category") == "place", canonical_place(F.col("subject"))).otherwise(F.col("subject"))
    name = strip_text(F.coalesce("canonical", own))
    named = stored(named.select(*_SUBJECT, F.when(name != "", name).otherwise(F.col("subject")).alias("_name")), "names")
    named = stored(named.withColumn("_general", placeholder(F.col("_name"), F.col("category"), F.col("narrator"))), "names")
    met = spread(items, named, _SUBJECT).where("not _general")
    said = F.when(F.col("category") == "character", character_fact(F.col("fact"), F.col("_name"), F.col("subject"))).when(F.col("category") == "place", place_fact(F.col("fact"), F.col("_name"))).otherwise(F.col("fact"))
    scope = time_scope(F.col("time_scope"), F.col("fact"), F.col("category"))
    out = met.withColumn("time_scope", scope).withColumn("fact", said).withColumn("subject", F.col("_name"))
    return out.select(*items.columns)


def narrated(items: DataFrame) -> DataFrame:
    """Items of the narrator's books with the narrator's name for other names of theirs and in the facts about them."""
    told = F.col("narrator") == NARRATOR
    subject = narrator_subject(F.col("subject"), F.col("narrator"))
    renamed = items.withColumn("_named", F.when(told, subject).otherwise(F.col("subject")))
    renamed = renamed.withColumn("subject", F.when(F.col("_named") != "", F.col("_named")).otherwise(F.col("subject")))
    about = told & (strip_text(F.col("subject")) == F.col("narrator"))
    return renamed.withColumn("fact", F.when(about, narrator_fact(F.col("fact"), F.col("narrator"))).otherwise(F.col("fact"))).drop("_named")


def canonicalize_books(items: DataFrame, known: dict[str, str] | None = None, exact_only: tuple[str, ...] = EXACT_ONLY) -> DataFrame:
    """Items under canonical subjects within their books: the narrator first, then characters and places by their aliases.

    Null texts are empty; a null book is none and its items go. Items whose subject is too general to keep go as well.
    Repeated rows stay; an empty table gives no rows. Further columns come back as they are.
    """
    return _renamed(narrated(items.where("book is not null")), known, exact_only)


def canonicalize_all(items: DataFrame, known: dict[str, str] | None = None, exact_only: tuple[str, ...] = EXACT_ONLY) -> DataFrame:
    """Items under canonical subjects over all books at once, without regard to narrators; see ``canonicalize_books``."""
    kept = items.withColumnsRenamed({"book": "_book", "narrator": "_narrator"})
    found = _renamed(kept.withColumn("book", F.lit("")).withColumn("narrator", F.lit("")), known, exact_only)
    return found.drop("book", "narrator").withColumnsRenamed({"_book": "book", "_narrator": "narrator"}).select(*items.columns)


