"""One graph of entities and events from the resolved chapters of all books.

Every mention of an entity is a row with its place in the order of all: facts first, then each chapter's events with what takes
part in them, its entities and its relations. Nodes and edges are combining aggregates over these rows, the first mention
gives a node's label, books are united; so the result doesn't depend on how rows are dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskb.functions.facts import normalized_subject, time_scope
from corpuskb.functions.names import entity_node_id, entity_type, event_node_id
from corpuskb.functions.text import preview, strip_text
from corpuskb.operators.joins import running_total, spread
from corpuskb.operators.timeline import unique_edges
from corpuskb.sources.scratch import stored

#: What an event's lists mean: relation type and the category of names that no fact tells of.
ROLES = {"participants": ("involves", "character"), "places": ("occurs_in", "place"), "objects": ("uses", "custom")}
SCOPED = ("past", "current", "change", "ended")


def fallback_events(facts: DataFrame, most: int = 12) -> DataFrame:
    """Events (grp, pos, local_id, label, summary, time_scope, chunk_indices, participants) made of a chapter's facts
    (grp, no, category, subject, fact, time_scope, chunk_idx): those of events and history, and those that tell of a time.

    ``no`` numbers a chapter's facts from 1; only its first ``most`` events stay, which is the feature. They are found by
    a combining aggregate. Facts without a text give none.
    """
    fact, subject = strip_text(F.col("fact")), strip_text(F.col("subject"))
    scoped = facts.withColumns({"fact": fact, "subject": subject, "category": strip_text(F.col("category"))}).where("fact <> ''")
    scoped = scoped.withColumn("time_scope", time_scope(F.col("time_scope"), F.col("fact"), F.col("category")))
    told = scoped.where(F.col("category").isin("event", "history") | F.col("time_scope").isin(*SCOPED))
    none = F.array().cast("array<string>")
    row = F.struct("no", F.concat(F.lit("E"), F.col("no").cast("string")).alias("local_id"), preview(F.col("fact"), 72).alias("label"), F.col("fact").alias("summary"), "time_scope", F.array_compact(F.array("chunk_idx")).alias("chunk_indices"), F.when(F.col("subject") != "", F.array("subject")).otherwise(none).alias("participants"))
    # a chapter's numbers are dealt into ever longer stretches, so no aggregate holds more than ``most`` rows of each
    first = told.select("grp", F.floor(F.col("no") / 256).alias("part"), F.array(row).alias("xs"))
    for wider in (256, 256, None):
        first = first.groupBy("grp", "part").agg(F.slice(F.array_sort(F.flatten(F.collect_list("xs"))), 1, most).alias("xs"))
        first = first.withColumn("part", F.floor(F.col("part") / wider) if wider else F.lit(0))
    first = first.groupBy("grp").agg(F.slice(F.array_sort(F.flatten(F.collect_list("xs"))), 1, most).alias("xs"))
    return first.select("grp", F.posexplode("xs").alias("pos", "x")).select("grp", (F.col("pos") + 1).alias("pos"), "x.*").drop("no")


def _order(stage: int, *parts: Column) -> Column:
    filled = [F.lit(stage), *parts, *[F.lit(0)] * (5 - len(parts))]
    return F.struct(*(p.cast("long").alias(f"o{k}") for k, p in enumerate(filled)))


def _with_category(mentions: DataFrame, categories: DataFrame) -> DataFrame:
    """Mentions (label, hint) with their node's id and type: by the category that facts give the name, else by the hint."""
    keyed = mentions.withColumn("key", normalized_subject(F.col("label")))
    met = spread(keyed, categories, ["key"]).withColumn("category", F.coalesce("category", "hint"))
    return met.withColumns({"id": entity_node_id(F.col("label"), F.col("category")), "type": entity_type(F.col("category"))})


def build(events: DataFrame, entities: DataFrame, relations: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, label, type, source_books, book, chapter, summary, time_scope, chunk_indices) and edges of the whole graph.

    ``events``: grp, book, chapter, pos from 1, local_id, label, summary, time_scope, chunk_indices, participants, places,
    objects; ``entities``: grp, book, pos, label, type; ``relations``: grp, book, chapter, pos, source, target, type, evidence,
    confidence; ``facts``: ord, subject, category, book. grp orders the chapters, (grp, pos) is unique in each table.
    Names that a chapter's events go by stand for these, of equal ones the last. Null texts are empty, nameless mentions
    and edges without an end or to themselves go, doubles of an edge too. Empty tables give an empty graph.
    """
    named = facts.select("ord", strip_text(F.col("subject")).alias("label"), strip_text(F.col("category")).alias("category"), strip_text(F.col("book")).alias("book")).where("label <> ''")
    categories = stored(named.groupBy(normalized_subject(F.col("label")).alias("key")).agg(F.max_by("category", "ord").alias("category")), "categories")
    per_group = running_total(events.groupBy("grp").agg(F.count("*").alias("n")), "grp", "n", "before").select("grp", "before")
    texts = {c: strip_text(F.col(c)) for c in ("local_id", "label", "summary", "book", "chapter")}
    numbered = events.join(per_group, "grp").withColumns(texts)
    numbered = numbered.withColumns(
        {
            "event_id": event_node_id(F.col("book"), F.col("chapter"), F.col("before") + F.col("pos")),
            "local_id": F.when(F.col("local_id") != "", F.col("local_id")).otherwise(F.concat(F.lit("E"), F.col("pos").cast("string"))),
            "chunk_indices": F.sort_array(F.array_compact(F.coalesce("chunk_indices", F.array().cast("array<long>")))),
            "time_scope": time_scope(F.col("time_scope"), F.when(F.col("summary") != "", F.col("summary")).otherwise(F.col("label")), F.lit("event")),
        }
    )
    numbered = stored(numbered.withColumn("label", F.when(F.col("label") != "", F.col("label")).otherwise(F.concat("chapter", F.lit(": событие "), F.col("pos").cast("string")))), "events")

    roles = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(kind).alias("kind"), F.lit(hint).alias("hint"), F.coalesce(name, F.array().cast("array<string>")).alias("labels")) for k, (name, (kind, hint)) in enumerate(ROLES.items())))
    taking = numbered.select("grp", "pos", "book", "chapter", "event_id", "chunk_indices", F.explode(roles).alias("r")).select("*", F.posexplode("r.labels").alias("at", "label"))
    taking = taking.select(_order(1, F.col("grp"), F.lit(0), F.col("pos"), F.col("r.k"), F.col("at")).alias("seq"), "book", "chapter", "event_id", "chunk_indices", F.col("r.kind").alias("relation"), F.col("r.hint").alias("hint"), strip_text(F.col("label")).alias("label")).where("label <> ''")
    taking = stored(_with_category(taking, categories), "taking")

    ends = {c: strip_text(F.col(c)) for c in ("source", "target", "type", "evidence", "confidence", "book", "chapter")}
    related = relations.withColumns(ends).where("source <> '' and target <> ''")
    local = numbered.groupBy("grp", F.col("local_id").alias("label")).agg(F.max_by("event_id", "pos").alias("event_id"))
    sides = F.array(*(F.struct(F.lit(k).alias("side"), F.col(c).alias("label")) for k, c in enumerate(("source", "target"))))
    refs = related.select("grp", "pos", "book", F.inline(sides)).join(local, ["grp", "label"], "left")
    outer = _with_category(refs.where("event_id is null").drop("event_id").withColumn("hint", F.lit("")), categories)
    refs = stored(refs.where("event_id is not null").select("grp", "pos", "book", "side", "label", F.col("event_id").alias("id"), F.lit(None).cast("string").alias("type")).unionByName(outer.select("grp", "pos", "book", "side", "label", "id", "type")), "refs")

    listed = entities.select("grp", "pos", strip_text(F.col("book")).alias("book"), strip_text(F.col("label")).alias("label"), strip_text(F.col("type")).alias("category")).where("label <> ''")
    known = lambda df: df.withColumns({"id": entity_node_id(F.col("label"), F.col("category")), "type": entity_type(F.col("category"))})
    mentions = known(named).select(_order(0, F.col("ord")).alias("seq"), "id", "type", "label", "book")
    mentions = mentions.unionByName(taking.select("seq", "id", "type", "label", "book"))
    mentions = mentions.unionByName(known(listed).select(_order(1, F.col("grp"), F.lit(1), F.col("pos")).alias("seq"), "id", "type", "label", "book"))
    mentions = mentions.unionByName(refs.where("type is not null").select(_order(1, F.col("grp"), F.lit(2), F.col("pos"), F.col("side")).alias("seq"), "id", "type", "label", "book"))
    books = F.array_sort(F.collect_set(F.when(F.col("book") != "", F.col("book"))))
    nodes = mentions.groupBy("id", "type").agg(F.min_by("label", "seq").alias("label"), books.alias("source_books"))
    nodes = nodes.unionByName(numbered.select(F.col("event_id").alias("id"), F.lit("event").alias("type"), "label", "book", "chapter", "summary", "time_scope", "chunk_indices"), allowMissingColumns=True)

    edges = taking.select("seq", F.col("event_id").alias("source"), F.col("id").alias("target"), F.col("relation").alias("type"), "book", "chapter", F.lit("").alias("evidence"), F.lit("").alias("confidence"), "chunk_indices")
    ids = refs.groupBy("grp", "pos").agg(F.max(F.when(F.col("side") == 0, F.col("id"))).alias("source"), F.max(F.when(F.col("side") == 1, F.col("id"))).alias("target"))
    drawn = related.drop("source", "target").join(ids, ["grp", "pos"])
    drawn = drawn.select(_order(1, F.col("grp"), F.lit(2), F.col("pos")).alias("seq"), "source", "target", "type", "book", "chapter", "evidence", "confidence", F.array().cast("array<long>").alias("chunk_indices"))
    return nodes.select("id", "label", "type", "source_books", "book", "chapter", "summary", "time_scope", "chunk_indices"), unique_edges(edges.unionByName(drawn), "seq")
