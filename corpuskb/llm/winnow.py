"""Winnowing fingerprints in DataFrame expressions only.

A fingerprint is made of the hashes of all runs of ``K`` words: of every ``W`` neighbouring runs the least hash is
kept, the rightmost of equal ones, together with its position. Two texts that share ``K + W - 1`` words in a row
so share a kept hash. A kept entry is one long, hash << 31 | (2**31 - 1 - position): the least long is the least
hash and, among equal hashes, the one furthest right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W_
from pyspark.sql import functions as F

K, W = 3, 5
_LAST = (1 << 31) - 1
#: Bound on the groups that neighbours in id order are dealt into, and so on what the driver sees of them.
GROUPS = 4096


def entries(text: str, k: int = K, w: int = W) -> Column:
    """The kept entries of a text, an SQL expression, in order of position.

    A text of fewer than ``k`` words gives one run of all of them, one without words no entry.
    """
    words = f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> '')"
    hashed = f"transform({words}, x -> hash(x))"
    run = ", ".join(f"h[i + {j}]" if j else "h[i]" for j in range(k))
    packed = "shiftleft(cast({} as bigint), 31) + ({} - {})"
    grams = f"transform(sequence(0, size(h) - {k}), i -> {packed.format(f'hash({run})', _LAST, 'i')})"
    whole = f"array({packed.format('hash(h)', _LAST, 0)})"
    least = ", ".join(f"g[i + {j}]" if j else "g[i]" for j in range(w))
    windows = f"array_distinct(transform(sequence(0, size(g) - {w}), i -> least({least})))"
    # a transform over one element names its value, so that it is computed once
    picked = f"element_at(transform(array(grams), g -> case when size(g) >= {w} then {windows} when size(g) > 0 then array(array_min(g)) else g end), 1)"
    grams = f"element_at(transform(array({hashed}), h -> case when size(h) >= {k} then {grams} when size(h) > 0 then {whole} else cast(array() as array<bigint>) end), 1)"
    return F.expr(picked.replace("array(grams)", f"array({grams})"))


def hashes(found: Column) -> Column:
    """The distinct hashes of entries."""
    return F.array_distinct(F.transform(found, lambda v: F.shiftright(v, 31).cast("int")))


def printed(found: Column) -> Column:
    """Entries as text: hash in hexadecimal, a colon, and the position in words."""
    return F.array_join(F.transform(found, lambda v: F.concat(F.hex(F.shiftright(v, 31).bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(":"), (F.lit(_LAST) - v.bitwiseAND(F.lit(_LAST))).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sets; 1 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - shared
    return F.when(every == 0, F.lit(1.0)).otherwise(shared / every)


def with_next(docs: DataFrame, carried: list[str], id_column: str = "doc_id") -> DataFrame:
    """Every row with the ``carried`` columns of the next row in descending id order as ``next_...``; the last row's next is the first.

    Rows of neighbouring ids meet in at most ``GROUPS`` groups, and the first row of each also goes, as a guest,
    to the group before; the driver sees one id per group. Null ids come last, ties are ordered by the
    ``carried`` columns.
    """
    low, high, n = docs.agg(F.min(id_column), F.max(id_column), F.count("*")).first()
    low, high = (0, 0) if low is None else (int(low), int(high))
    groups = max(1, min(GROUPS, n // 64))
    width = (high - low + 2) // groups + 1
    key = F.coalesce(F.col(id_column), F.lit(low - 1)).cast("decimal(20,0)")
    placed = docs.withColumn("_key", key).withColumn("_group", F.floor((F.col("_key") - F.lit(low - 1)) / F.lit(width)).cast("int"))
    heads = sorted(((r["_group"], r["h"]) for r in placed.select("_key", "_group").groupBy("_group").agg(F.max("_key").alias("h")).collect()), reverse=True)
    # the first row of a group follows the last one of the group above it; after the lowest comes the highest
    guests = [(heads[(k + 1) % len(heads)][1], g) for k, (g, _) in enumerate(heads)]
    spark = docs.sparkSession
    guest = F.broadcast(spark.createDataFrame(guests, "_key decimal(20,0), _guest int")) if guests else spark.createDataFrame([], "_key decimal(20,0), _guest int")
    dealt = placed.join(guest, "_key", "left").withColumn("_to", F.explode(F.filter(F.array(F.struct(F.lit(0).alias("guest"), F.col("_group").alias("g")), F.when(F.col("_guest").isNotNull(), F.struct(F.lit(1).alias("guest"), F.col("_guest").alias("g")))), lambda x: x.isNotNull())))
    order = W_.partitionBy("_to.g").orderBy(F.col("_to.guest"), F.col("_key").desc(), *carried)
    out = dealt.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in carried)).where("_to.guest = 0")
    return out.drop("_key", "_group", "_guest", "_to")


def compare(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness; see the module for what is kept.

    The edited form has its last half replaced by as much of the next document in descending id order. Null
    texts are empty: no entries, and as like another empty text as can be. Repeated rows are compared with
    each other; an empty table gives no rows; other columns are ignored.
    """
    base = docs.select(F.col(id_column), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("found", entries("text"))
    paired = with_next(base, ["text", "found"], id_column)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    paired = paired.select(id_column, n.cast("long").alias("n_chars"), "found", "next_found", edited.alias("edited"))
    paired = paired.select("*", entries("edited").alias("edited_found"))
    return paired.select(
        id_column,
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("found")).alias("fingerprint"),
        printed(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(hashes(F.col("found")), hashes(F.col("edited_found"))).alias("near_edited"),
        likeness(hashes(F.col("found")), hashes(F.col("next_found"))).alias("near_next"),
    )
