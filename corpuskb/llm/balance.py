"""Mixing of sources to target weights by entropy balancing, in DataFrame expressions only.

Each row gets a rate, the number of times the mix takes it. Of all rates in [0, most] whose words add up to the sources'
targets, those nearest to 1 each, in relative entropy, are ``least(most, exp(l * size))`` with one multiplier ``l`` for
each source: an exponential tilt by size. The multipliers maximise the concave dual; its gradient and curvature are sums
over rows, so a Newton step is one aggregation, kept within a bracket that is known in advance. A rate depends on
source and size alone, so the rows' counts by source and size are all that the iterations read. There are few:
distinct sizes of a source that has w words are fewer than the root of 2 w, plus one.

Rates become whole copies class by class, a class being the rows of one source and size: along a source's sizes, longest
first, the fractions are added up and a class takes as many extra copies as the sum, rounded, grows by. What is
then amiss in words is mended by single classes, as long as that brings the source nearer to its target. Within a class
the rows with the least hashes of their ids get the extra copies, counted by buckets of hashes, so no class, however
large, is sorted in one place. Equal rows (id, source and size) are one weighted row until the end.

All sums are taken in decimals: they don't depend on the partitioning, and neither does the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskb.llm.store import materialize

#: Rows of a class that are ranked in one place, about.
BUCKET = 4096
#: Equal rows written out from one list at most.
_SPREAD = 10_000
_EXACT = "decimal(38,9)"


def sizes(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """Equal rows (key, id, size) with their number n; ``key`` is the source behind a mark, empty for null."""
    size = F.coalesce(F.expr(f"regexp_count({text_column}, '[^\\\\x20\\\\x09-\\\\x0D]+')"), F.lit(0)).cast("long")
    key = F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit(""))
    return docs.select(F.col(id_column).alias("id"), size.alias("size"), key.alias("key")).groupBy("key", "size", "id").agg(F.count("*").alias("n"))


def ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place, from 0, by code point, null last; sorted over all tasks, the driver sees a count of each partition."""
    last, order = F.col("key") == "", "key"
    placed = materialize(sources.repartitionByRange(last, order).withColumn("part", F.spark_partition_id()), "sources")
    before, base = 0, []
    for part, n in sorted(tuple(r) for r in placed.groupBy("part").count().collect()):
        base.append((part, before))
        before += n
    bases = F.broadcast(placed.sparkSession.createDataFrame(base, "part int, before long"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(last, order))
    return placed.join(bases, "part").withColumn("place", F.col("before") + within - 1).drop("part", "before")


def targets(sources: DataFrame, weights: list[int], most: int) -> DataFrame:
    """Sources (key, source_size, place) with the words that each is to have: shares by weight of all words, at most
    ``most`` times its own, what is above shared again by weight among the others."""
    pattern = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = materialize(sources.withColumn("weight", pattern).withColumn("cap", most * F.col("source_size")), "weighed")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, state = 0.0, None
    while True:
        full = F.col("cap") < F.col("weight") * level
        capped, free = weighed.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        if (capped, free) == state:
            break
        state = (capped, free)
        level = (total - (capped or 0)) / free if free else float("inf")
    share = F.col("weight") * level
    return weighed.withColumn("target", F.when(F.col("cap") < share, F.col("cap").cast("double")).otherwise(share) if total else F.lit(0.0))


def rate(most: int) -> Column:
    """Copies of a row: exponential in its size, at most ``most``; all sources that need ``most`` throughout get it."""
    return F.when(F.col("full"), F.lit(float(most))).otherwise(F.exp(F.least(F.col("tilt") * F.col("size") / F.col("longest"), F.ln(F.lit(float(most))))))


def tilts(classes: DataFrame, sources: DataFrame, most: int, near: float = 1e-9) -> DataFrame:
    """Sources with their multiplier ``tilt``, for sizes over the source's longest, by Newton's method on the dual."""
    widths = classes.where("size > 0").groupBy("key").agg(F.max("size").alias("longest"), F.min("size").alias("shortest"))
    start = sources.join(widths, "key", "left")
    own, wanted = F.col("source_size"), F.col("target")
    reach = F.col("longest") / F.col("shortest")
    start = start.select(
        "key",
        "source_size",
        "target",
        "longest",
        (wanted >= most * own).alias("full"),
        F.lit(0.0).alias("tilt"),
        F.when(wanted < own, F.ln(wanted / own) * reach).otherwise(0.0).alias("low"),
        F.when(wanted > own, F.ln(F.lit(float(most))) * reach).otherwise(0.0).alias("high"),
        ((own == 0) | (wanted >= most * own)).alias("done"),
    )
    state = materialize(start, "tilts")
    while state.where("not done").limit(1).count():
        met = classes.join(state.where("not done"), "key").withColumn("rate", rate(most))
        words = F.col("m") * F.col("size") * F.col("rate")
        bent = F.when(F.col("rate") < most * (1 - 1e-12), words * F.col("size") / F.col("longest")).otherwise(0.0)
        sums = met.groupBy("key").agg(F.sum(words.cast(_EXACT)).cast("double").alias("words"), F.sum(bent.cast(_EXACT)).cast("double").alias("bent"))
        over = F.col("words") - F.col("target")
        narrowed = state.join(sums, "key", "left").withColumn("low", F.when(over < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn("high", F.when(over > 0, F.col("tilt")).otherwise(F.col("high")))
        newton = F.col("tilt") - over / F.nullif("bent", F.lit(0.0))
        middle = (F.col("low") + F.col("high")) / 2
        step = F.when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise(middle)
        there = (F.abs(over) <= near * F.col("target") + 1e-6) | (F.col("high") - F.col("low") <= 1e-13 * F.greatest(F.abs("low"), F.abs("high")))
        narrowed = narrowed.withColumn("done", F.col("done") | there).withColumn("tilt", F.when(F.col("done"), F.col("tilt")).otherwise(step))
        state = materialize(narrowed.drop("words", "bent"), "tilts")
    return state


def copies(classes: DataFrame, tilted: DataFrame, most: int, near: float) -> DataFrame:
    """Classes (key, size, m) with their ``rate``, the copies ``base`` of all their rows and the number ``extra`` of rows that get one more."""
    exact = classes.join(tilted.select("key", "source_size", "target", "longest", "full", "tilt"), "key")
    exact = exact.withColumn("rate", F.when(F.col("size") > 0, rate(most)).otherwise(1.0)).withColumn("base", F.floor(F.col("rate") + 1e-9))
    fraction = F.greatest(F.col("rate") - F.col("base"), F.lit(0.0))
    sofar = F.sum((F.col("m") * fraction).cast(_EXACT)).over(Window.partitionBy("key").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0))
    exact = exact.withColumn("grown", F.floor(sofar + F.lit(0.5).cast("decimal(2,1)")).cast("long"))
    extra = F.col("grown") - F.coalesce(F.lag("grown").over(Window.partitionBy("key").orderBy(F.desc("size"))), F.lit(0))
    found = materialize(exact.withColumn("extra", F.least(extra, F.col("m"))).drop("grown", "longest", "full", "tilt"), "copies")
    while True:
        lack = F.col("target") - F.sum((F.col("m") * F.col("base") + F.col("extra")) * F.col("size")).over(Window.partitionBy("key"))
        amiss = found.withColumn("lack", lack).where("size > 0").where(F.abs("lack") > near * F.col("target"))
        room = F.when(F.col("lack") > 0, F.when(F.col("base") < most, F.col("m") - F.col("extra")).otherwise(0)).otherwise(F.col("extra"))
        able = amiss.withColumn("room", room).where("room > 0").where(F.col("size") < 2 * F.abs("lack"))
        # the longest that fits, else the shortest that still helps
        fits = F.col("size") <= F.abs("lack")
        best = able.groupBy("key").agg(F.max(F.when(fits, F.col("size"))).alias("long"), F.min("size").alias("short"))
        number = F.when(fits, F.least(F.col("room"), F.floor(F.abs("lack") / F.col("size")))).otherwise(1)
        mends = able.join(best, "key").where(F.col("size") == F.coalesce("long", "short")).select("key", "size", (F.signum("lack") * number).cast("long").alias("more"))
        mends = materialize(mends, "mends")
        if not mends.limit(1).count():
            return found
        found = materialize(found.join(mends, ["key", "size"], "left").withColumn("extra", F.col("extra") + F.coalesce("more", F.lit(0))).drop("more"), "copies")


def dealt(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (key, size, id, n) with their class's columns and the number ``plus`` of the n that get an extra copy.

    Classes of over a hundredth of all rows, a hundred at most, are joined as a broadcast, so none is sent to one task.
    """
    total = found.agg(F.sum("m")).first()[0] or 0
    hot = F.broadcast(found.where(F.col("m") * 100 > total))
    rest = rows.join(hot.select("key", "size"), ["key", "size"], "left_anti").join(found.where(F.col("m") * 100 <= total), ["key", "size"])
    met = rows.join(hot, ["key", "size"]).unionByName(rest)
    met = met.withColumn("hash", F.xxhash64("id")).withColumn("bucket", F.pmod("hash", F.floor(F.col("m") / BUCKET) + 1))
    several = met.where((F.col("extra") > 0) & (F.col("extra") < F.col("m")) & (F.col("m") >= BUCKET))
    buckets = several.groupBy("key", "size", "bucket").agg(F.sum("n").alias("held"))
    ahead = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("key", "size", "bucket", F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("key", "size", "bucket").orderBy("hash", "id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce("ahead", F.lit(0)) + F.coalesce(F.sum("n").over(within), F.lit(0))
    plus = F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - before))
    return met.join(buckets, ["key", "size", "bucket"], "left").withColumn("plus", plus)


def mix(docs: DataFrame, weights: list[int] | None = None, most: int = 3, near: float = 1e-4, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Every row with its size in words, its source's words and target, its rate and what the mix takes of it.

    Sources, by code point, null last, weigh 1, 2, 3, repeating, or as ``weights`` say; a target is at most ``most`` times
    a source's words, and no row is taken more than ``most`` times. ``taken`` is the row's size times its copies, whole
    copies. A source whose taken words are further than ``near`` from its target, in parts of it, has no class left that
    would bring it nearer by one more or one fewer copy.

    Null texts have no words, null sources are one source, null ids are ids like any other; rows without words are
    listed with nothing taken. Repeated rows are listed as often as they come; which of them gets an extra copy
    doesn't matter. An empty table gives no rows; other columns are ignored. Reruns and other partitionings give
    the same rows.
    """
    rows = materialize(sizes(docs, id_column, text_column, source_column), "sizes")
    classes = materialize(rows.groupBy("key", "size").agg(F.sum("n").alias("m")), "classes")
    sources = classes.groupBy("key").agg(F.sum(F.col("m") * F.col("size")).alias("source_size"))
    tilted = tilts(classes, targets(ranked(sources), weights or [1, 2, 3], most), most)
    found = dealt(rows, copies(classes, tilted, most, near))
    parts = found.withColumn("_part", F.explode(F.expr(f"sequence(0L, (n - 1) div {_SPREAD})")))
    each = parts.withColumn("_at", F.explode(F.expr(f"sequence(_part * {_SPREAD} + 1, least(n, (_part + 1) * {_SPREAD}))")))
    number = F.col("base") + F.when(F.col("_at") <= F.col("plus"), 1).otherwise(0)
    return each.select(
        F.col("id").alias(id_column),
        "size",
        "source_size",
        "target",
        (F.col("size") * number).cast("long").alias("taken"),
        F.when(F.col("key") != "", F.expr("substring(key, 2)")).alias("source"),
        "rate",
        number.cast("long").alias("copies"),
    )
