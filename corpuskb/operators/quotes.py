"""Quotations looked up in their chunks, exactly or nearly, and the checks on spoken items that build on it.

A quotation that its chunk holds neither as it is nor normalized is compared with windows of its own length, a quarter
of that apart. A window's matching blocks are a common subsequence, so the longest one bounds their ratio from above. Its
length is computed for many windows at once: every window has a lane of bits in one large integer, and a step of the
bit-parallel recurrence takes one character of each. Only windows that can reach the threshold are compared in full,
in order. At a ratio of 0.7 two texts need not share more than two characters in a row, so longer seeds would lose matches.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskb.functions.text import search_text, strip_text
from corpuskb.operators.joins import spread_wide

#: Kinds of spoken items.
KINDS = ("dialogue", "silent_speech", "monologue")
#: Windows that are compared at once; bounds memory, whatever the chunk's length.
_LANES = 4096


def subsequence_lengths(quote: str, text: str, step: int, first: int, count: int) -> np.ndarray:
    """Lengths of the longest common subsequences of a quote and ``count`` windows as long as it, ``step`` apart from window ``first`` on."""
    n = len(quote)
    width = n // 8 + 1  # a lane has at least one bit more than the quote, which takes the carry
    masks: dict[str, int] = {}
    for k, c in enumerate(quote):
        masks[c] = masks.get(c, 0) | 1 << k
    table = np.frombuffer(bytes(width) + b"".join([m.to_bytes(width, "little") for m in masks.values()]), np.uint8).reshape(-1, width)
    # every character's mask is looked up once for all windows that it lies in
    codes = np.frombuffer(text[first * step : (first + count - 1) * step + n].encode("utf-32-le", "surrogatepass"), "<u4")
    number = np.zeros(max(int(codes.max()), *map(ord, masks)) + 1, np.int32)
    number[[*map(ord, masks)]] = np.arange(1, len(masks) + 1)
    met_by = np.ascontiguousarray(table[number[codes]]).view(f"V{width}").ravel()
    full = int.from_bytes(((1 << n) - 1).to_bytes(width, "little") * count, "little")
    state = full
    for t in range(n):
        met = int.from_bytes(met_by[t : t + (count - 1) * step + 1 : step].tobytes(), "little")
        shared = state & met
        # a lane's state is all that it had beside what it shares
        state = (state + shared | state ^ shared) & full
    left = np.frombuffer(state.to_bytes(width * count, "little"), np.uint8).reshape(count, width)
    return n - np.bitwise_count(left).sum(axis=1, dtype=np.int64)


def near(quote: str, text: str, threshold: float = 0.7) -> tuple[int, float] | None:
    """Place and ratio of the first window of a normalized text that is as like a normalized quote as ``threshold``, or None.

    Quotes of fewer than ten characters, or longer than the text, are not looked for.
    """
    n, m = len(quote), len(text)
    if n < 10 or n > m:
        return None
    step = max(1, n // 4)
    total = (m - n) // step + 1
    for first in range(0, total, _LANES):
        lengths = subsequence_lengths(quote, text, step, first, min(_LANES, total - first))
        for k in np.flatnonzero(2.0 * lengths / (2 * n) >= threshold).tolist():
            at = (first + k) * step
            ratio = difflib.SequenceMatcher(None, quote, text[at : at + n]).ratio()
            if ratio >= threshold:
                return at, ratio
    return None


def _met(items: DataFrame, chunks: DataFrame, item_key: str, chunk_key: str, texts: list[str]) -> DataFrame:
    """Items with their chunk's columns, its ``texts`` also as they are looked up, and their key as ``_chunk``.

    A chunk is normalized once and not for each item, and it is shuffled once for many items.
    """
    read = chunks.withColumns({f"_t_{t}": search_text(F.col(t)) for t in texts})
    return spread_wide(items.withColumn("_chunk", F.col(item_key)), read.withColumnRenamed(chunk_key, "_chunk"), ["_chunk"])


def _found(how: str, quote: Column, text: Column) -> Column:
    return F.struct(F.lit(how).alias("how"), (F.position(quote, text) - 1).cast("long").alias("place"), F.lit(1.0).alias("ratio"))


def _searched(rows: DataFrame, searches: list[tuple[str, str, str, tuple[str, bool] | None]], kept: list[str], threshold: float) -> DataFrame:
    """The ``kept`` columns and for each search (name, quote column, text column, condition) a struct (how, place, ratio).

    It says ``exact``, ``normalized`` or, for near places, ``window``; null if the quote isn't found or null or empty. Near
    places are only looked for where an earlier search, the condition's name, has or hasn't found its quote.
    """
    out = rows
    for quote in dict.fromkeys(quote for _, quote, _, _ in searches):
        out = out.withColumn(f"_n_{quote}", search_text(F.col(quote)))
    for name, quote, text, _ in searches:
        some = F.coalesce((F.col(quote) != "") & (F.col(text) != ""), F.lit(False))
        q, t = F.col(f"_n_{quote}"), F.col(f"_t_{text}")
        at_once = F.when(some & F.contains(F.col(text), F.col(quote)), _found("exact", F.col(quote), F.col(text))).when(some & F.contains(t, q), _found("normalized", q, t))
        out = out.withColumn(name, at_once).withColumn(f"_look_{name}", some & F.col(name).isNull())
    names = [name for name, *_ in searches]
    # only what is looked at in Python goes there
    sought = {t: F.lit(False) for t in dict.fromkeys(text for _, _, text, _ in searches)}
    for name, _, text, _ in searches:
        sought[text] = sought[text] | F.col(f"_look_{name}")
    quotes = list(dict.fromkeys(f"_n_{quote}" for _, quote, _, _ in searches))
    out = out.select(*kept, *names, *quotes, *(f"_look_{name}" for name in names), *(F.when(looked, F.col(f"_t_{t}")).alias(f"_t_{t}") for t, looked in sought.items()))
    result = out.select(*kept, *names).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            found: dict[str, list] = {}
            for name, quote, text, condition in searches:
                found[name] = columns[name].to_pylist()
                for k, looked in enumerate(columns[f"_look_{name}"].to_pylist()):
                    if looked and (not condition or (found[condition[0]][k] is not None) == condition[1]):
                        met = near(columns[f"_n_{quote}"][k].as_py(), columns[f"_t_{text}"][k].as_py(), threshold)
                        found[name][k] = met and {"how": "window", "place": met[0], "ratio": met[1]}
            kind = pa.struct([("how", pa.string()), ("place", pa.int64()), ("ratio", pa.float64())])
            yield pa.RecordBatch.from_arrays([*(columns[n] for n in kept), *(pa.array(found[n], kind) for n in names)], [*kept, *names])

    return out.mapInArrow(run, result)


def locate(items: DataFrame, chunks: DataFrame, quote: str = "quote", item_key: str = "chunk_id", chunk_key: str = "chunk_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Items with ``how``, ``place`` and ``ratio`` of their quote in their chunk.

    ``how`` is ``exact`` (place in the text as it is), ``normalized`` or ``window`` (place in the normalized text, the first
    window that is like enough), null where the quote isn't found, is null or empty or its chunk is missing. A chunk's key
    is unique; items may repeat. An empty table gives no rows.
    """
    met = _met(items, chunks.select(F.col(chunk_key), F.col(text).alias("_text")), item_key, chunk_key, ["_text"])
    found = _searched(met.withColumn("_quote", F.col(quote)), [("_found", "_quote", "_text", None)], items.columns, threshold)
    return found.select(*items.columns, "_found.how", "_found.place", "_found.ratio")


def validate(items: DataFrame, chunks: DataFrame, item_key: str = "chunk_id", chunk_key: str = "chunk_id", text: str = "text", support: str | None = "support", threshold: float = 0.7) -> DataFrame:
    """Spoken items (kind, answer, asks, key of their chunk) with the first ``reason`` to reject them, null if they are valid.

    In order: ``too_short`` answers of fewer than 15 characters, ``missing_type``, ``invalid_type``, ``answer_not_found``
    in the chunk, ``asks_not_found`` where what was said before has over 15 characters and is neither in the chunk nor
    in its ``support`` text. Where a chunk's text is null or empty, or missing, nothing is looked up. Texts are
    stripped first; null is empty. Later rules are not computed for what an earlier one rejects.
    """
    texts = chunks.select(F.col(chunk_key), F.col(text).alias("_text"), (F.col(support) if support else F.lit(None).cast("string")).alias("_support"))
    answer, asks = strip_text(F.col("answer")), strip_text(F.col("asks"))
    early = F.when(F.length(answer) < 15, "too_short").when(F.col("kind").isNull(), "missing_type").when(~F.col("kind").isin(*KINDS), "invalid_type")
    met = _met(items, texts, item_key, chunk_key, ["_text", "_support"]).withColumn("_early", early)
    looked = F.col("_early").isNull() & (F.coalesce("_text", F.lit("")) != "")
    asked = looked & (F.length(asks) > 15)
    met = met.withColumn("_looked", looked).withColumn("_asked", asked).withColumn("_answer", F.when(looked, answer)).withColumn("_asks", F.when(asked, asks))
    # what was said before is only looked up if the answer is there, and in the support only if it isn't in the chunk
    searches = [("_in_text", "_answer", "_text", None), ("_asks_text", "_asks", "_text", ("_in_text", True)), ("_asks_support", "_asks", "_support", ("_asks_text", False))]
    found = _searched(met, searches, [*items.columns, "_early", "_looked", "_asked"], threshold)
    unasked = F.col("_asked") & F.col("_asks_text").isNull() & F.col("_asks_support").isNull()
    reason = F.coalesce(F.col("_early"), F.when(F.col("_looked") & F.col("_in_text").isNull(), "answer_not_found"), F.when(unasked, "asks_not_found"))
    return found.select(*items.columns, reason.alias("reason"))


def rejections(validated: DataFrame) -> DataFrame:
    """How many items each reason rejects; valid ones count under ``valid``."""
    return validated.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))
