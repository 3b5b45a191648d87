"""The review store: an append-only change log with undo, listings with search and pages, graph edges, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskb.functions.text import norm_text, strip_text


def replay(ops: DataFrame) -> DataFrame:
    """Current state of (op_id, ts, entity_id, after): the last operation of an entity by (ts, op_id) wins, a null ``after`` deletes."""
    return ops.groupBy("entity_id").agg(F.max_by(F.struct("op_id", "after"), F.struct("ts", "op_id")).alias("x"), F.count("*").alias("n_ops")).where("x.after is not null").select("entity_id", "x.op_id", "x.after", "n_ops")


def last_operation(ops: DataFrame) -> DataFrame:
    """The latest operation of all by (ts, op_id); no row for an empty log."""
    return ops.agg(F.max_by(F.struct(*ops.columns), F.struct("ts", "op_id")).alias("x")).where("x is not null").select("x.*")


def undo_last(ops: DataFrame, op_id) -> DataFrame:
    """The log (op_id, ts, entity_id, before, after) with the inverse of its latest operation appended under a new id.

    Nothing is ever removed, so undoing twice does the operation again.
    """
    inverse = last_operation(ops).select(op_id(F.col("op_id")).alias("op_id"), "ts", "entity_id", F.col("after").alias("before"), F.col("before").alias("after"))
    return ops.unionByName(inverse)


def applied(base: DataFrame, ops: DataFrame) -> DataFrame:
    """(entity_id, record) of base records (entity_id, record) after a log (op_id, ts, entity_id, after).

    The last operation by (ts, op_id) replaces the record, a null ``after`` deletes it; operations without an id or an entity count for nothing.
    """
    valid = ops.where("op_id is not null and op_id <> '' and entity_id is not null and entity_id <> ''")
    last = valid.groupBy("entity_id").agg(F.max_by(F.struct("after"), F.struct("ts", "op_id")).alias("op"))
    out = base.join(last, "entity_id", "full").select("entity_id", F.when(F.col("op").isNotNull(), F.col("op.after")).otherwise(F.col("record")).alias("record"))
    return out.where("record is not null")


def updates(state: DataFrame, patches: DataFrame, fields: list[str]) -> DataFrame:
    """(entity_id, before, after) of the records that patches (entity_id, patch map, theme_ids) change; ids without a record are left out.

    Only the named text fields are taken, without outer white space; a null list of themes keeps the old one, another is taken with each theme once.
    """
    new = patches.select("entity_id", "patch", F.col("theme_ids").alias("__themes"))
    taken = [F.when(F.map_contains_key("patch", f), strip_text(F.col("patch")[f])).otherwise(F.col(f)).alias(f) for f in fields]
    themes = F.coalesce(F.array_distinct("__themes"), "theme_ids").alias("theme_ids")
    return state.join(new, "entity_id").select("entity_id", F.struct(*fields, "theme_ids").alias("before"), F.struct(*taken, themes).alias("after"))


def relations_of(relations: DataFrame, ids: DataFrame) -> DataFrame:
    """The relations (source, target, ...) at either end of each of some ids, once where both ends are the same: two equal joins, no condition with ``or``."""
    wanted = ids.select(F.col(ids.columns[0]).alias("fact_id"))
    at = lambda end, rows: rows.join(wanted, F.col(end) == F.col("fact_id"))
    return at("source", relations).unionByName(at("target", relations.where("source <> target")))


def linked(samples: DataFrame, key: str, ids: str, rows: DataFrame, row_id: str) -> DataFrame:
    """(key, place, columns of rows) of the rows that a sample's list of ids names, in the list's order; unknown ids are left out."""
    return samples.select(key, F.posexplode(ids).alias("place", row_id)).join(rows, row_id)


def suggestions(answers: DataFrame, text: str) -> DataFrame:
    """The columns of answers but their text, with (line_no, action, fact_id, category, subject, fact, time_scope, reason) of each line that says keep or drop.

    What follows the last field belongs to the reason. Lines with too few fields or another verdict are dropped; null answers have no lines.
    """
    lines = answers.select(*(c for c in answers.columns if c != text), F.posexplode(F.split(F.col(text), r"\R")).alias("line_no", "__line"))
    parts = F.transform(F.split(strip_text(F.col("__line")), r"\|"), strip_text)
    lines = lines.where(F.contains("__line", F.lit("|"))).withColumn("__parts", parts).withColumn("action", F.lower(F.col("__parts")[0]))
    keep, n = F.col("action") == "keep", F.size("__parts")
    lines = lines.where(keep & (n >= 7) | (F.col("action") == "drop") & (n >= 3))
    fields = {name: F.when(keep, F.get("__parts", F.lit(k))) for k, name in enumerate(("category", "subject", "fact", "time_scope"), 2)}
    rest = F.slice("__parts", F.when(keep, 7).otherwise(3), n)
    return lines.withColumns({"fact_id": F.col("__parts")[1], **fields, "reason": strip_text(F.array_join(rest, "|"))}).drop("__line", "__parts")


def appended(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All existing rows, and of the new ones the first by order of each key that none of these has; null keys are equal to each other."""
    one = F.struct(*keys)
    fresh = new.withColumn("__key", one).join(existing.select(one.alias("__key")).distinct(), "__key", "left_anti")
    first = fresh.groupBy("__key").agg(F.min_by(F.struct(*new.columns), F.struct(*order)).alias("x")).select("x.*")
    return existing.unionByName(first)


def listing(rows: DataFrame, filters: dict, query: str, searched: list[str], order: list, limit: int, offset: int = 0) -> DataFrame:
    """One page of the rows that equal all given filters and match the search, each with the total before the cut."""
    for column, value in filters.items():
        if value:
            rows = rows.where(F.col(column) == value)
    rows = search(rows, query, searched)
    total = rows.agg(F.count("*").alias("total"))
    # one number
    return page(rows.crossJoin(F.broadcast(total)), order, limit, offset)


def labelled_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (source, target, ...) with the labels of their ends; an unknown end is its own label."""
    names = lambda c: nodes.select(F.col("node_id").alias(c), F.col("label").alias(f"{c}_label"))
    out = edges.join(names("source"), "source", "left").join(names("target"), "target", "left")
    return out.withColumns({f"{c}_label": F.coalesce(f"{c}_label", c) for c in ("source", "target")})


def overview(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, type, n) of a graph's nodes and edges; those without a type are unknown, or related_to."""
    typed = lambda rows, kind, other: rows.groupBy(F.coalesce(F.nullif("type", F.lit("")), F.lit(other)).alias("type")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "type", "n")
    return typed(nodes, "node", "unknown").unionByName(typed(edges, "edge", "related_to"))


def merge_theme(rows: DataFrame, source: str, target: str) -> DataFrame:
    """The rows with one theme id in place of another; ids stay in order and come once."""
    return rows.withColumn("theme_ids", F.array_distinct(F.transform("theme_ids", lambda t: F.when(t == source, target).otherwise(t))))


def search(rows: DataFrame, query: str, columns: list[str]) -> DataFrame:
    """Rows in whose joined normalized columns every normalized term of the query occurs."""
    text = norm_text(F.concat_ws(" ", *columns))
    terms = F.filter(F.split(norm_text(F.lit(query)), " "), lambda t: t != "")
    return rows.where(F.forall(terms, lambda t: F.contains(text, t)))


def page(rows: DataFrame, order: list, limit: int, offset: int = 0) -> DataFrame:
    """One page of a listing; the limit is the feature."""
    return rows.orderBy(*order).offset(offset).limit(limit)


def occurrence_ids(rows: DataFrame, kind: str, signature: str, order: list[str]) -> DataFrame:
    """Stable ids ``kind:signature:occurrence`` by order within equal signatures."""
    n = F.row_number().over(W.partitionBy(signature).orderBy(*order))
    return rows.withColumn("stable_id", F.concat_ws(":", F.lit(kind), F.col(signature), n.cast("string")))


def edges(events: DataFrame, key: str, order: list[str], label: str) -> DataFrame:
    """Edges (source, target, type ``before``) between neighbouring labels of a key, with evidence counts; no loops."""
    nxt = F.lead(label).over(W.partitionBy(key).orderBy(*order))
    pairs = events.select(F.col(label).alias("source"), nxt.alias("target")).where("target is not null and source <> target")
    return pairs.groupBy("source", "target").agg(F.count("*").alias("evidence")).withColumn("type", F.lit("before"))


def nodes(rows: DataFrame, label: str, kind: str, book: str, order: str) -> DataFrame:
    """Nodes ``kind::normalized label``: the first label by order is shown, with the sorted set of books."""
    keyed = rows.withColumn("node_id", F.concat(F.lit(kind + "::"), norm_text(F.col(label))))
    return keyed.groupBy("node_id").agg(F.min_by(label, order).alias("label"), F.array_join(F.sort_array(F.collect_set(book)), ",").alias("books"))
