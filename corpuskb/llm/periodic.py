"""Runs of words: maximal periodic stretches of interned word ids, by Main and Lorentz's divide and conquer.

A stretch is halved; the repetitions that cross its middle are found for all periods at once from two Z-functions, and
both halves are searched likewise. A repetition that is cut at an edge of its part crosses a middle further up and is
found there whole, so it is left out below. The same stretch is found with multiples of its period too: intervals are
deduplicated, the smallest period stays.

A run of ``exponent`` times its period has each of its words that often. So before a part is searched, and each time
anew, it is cut at its words that are rarer within it; no run crosses them, and in ordinary text little is left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Parts of at most so many words are searched without being cut again; only speed depends on it.
_SMALL = 16


def z_function(s: list[int]) -> list[int]:
    """For each place the length of the longest common prefix of what begins there and the whole; 0 at place 0."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def _crossing(w: np.ndarray, exponent: int, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of the repetitions across the middle of ``w``, maximal within it."""
    n, mid = len(w), len(w) // 2
    u, v = w[:mid].tolist(), w[mid:].tolist()
    most = n // exponent
    q = np.arange(1, most + 1)
    # ahead: common prefixes with v, of v's own later places and of u's last ones; back: the same from behind
    ahead = np.array(z_function([*v, -1, *u, *v]))
    u.reverse()
    v.reverse()
    back = np.array(z_function([*u, -1, *v, *u]))
    found = []
    right = q[q < n - mid]  # a word left of the middle agrees with one a period later
    first = ahead[right]
    last = back[mid + 1 + (n - mid) - right]
    found.append((mid - last, mid + first + right, right))
    left = q[q <= mid]  # a word right of the middle agrees with one a period earlier
    first = ahead[(n - mid) + 1 + mid - left]
    last = np.where(left < mid, back[np.minimum(left, mid - 1)], 0)
    found.append((mid - left - last, mid - left + first + left, left))
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    length = end - start
    kept = (length >= np.maximum(shortest, exponent * period)) & (start < mid) & (end > mid)
    return start[kept], end[kept], period[kept]


def _frequent_parts(w: np.ndarray, low: int, high: int, exponent: int, shortest: int) -> Iterator[tuple[int, int]]:
    """The stretches of a part whose words occur at least ``exponent`` times in it, if long enough for a run."""
    _, where, count = np.unique(w[low:high], return_inverse=True, return_counts=True)
    common = np.concatenate(([False], count[where] >= exponent, [False]))
    edges = np.flatnonzero(common[1:] != common[:-1])
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if b - a >= shortest:
            yield low + a, low + b


def runs(ids: np.ndarray, exponent: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period: stretches with smallest period ``period`` and at least
    ``shortest`` words and ``exponent`` periods that neither neighbouring word extends."""
    found: dict[tuple[int, int], int] = {}
    n, todo = len(ids), [(0, len(ids))]
    while todo:
        low, high = todo.pop()
        for a, b in _frequent_parts(ids, low, high, exponent, shortest):
            if b - a < high - low and b - a > _SMALL:
                todo.append((a, b))
                continue
            mid = a + (b - a) // 2
            for s, e, q in zip(*(x.tolist() for x in _crossing(ids[a:b], exponent, shortest)), strict=True):
                s, e = a + s, a + e
                # goes on behind an edge of the part: found there whole
                if (s == a and s > 0 and ids[s - 1] == ids[s - 1 + q]) or (e == b and e < n and ids[e] == ids[e - q]):
                    continue
                found[s, e] = min(q, found.get((s, e), q))
            todo += [(x, y) for x, y in ((a, mid), (mid, b)) if y - x >= shortest]
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when each run is cut down to its first period."""
    cover = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:n]) == 0


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", exponent: int = 4, shortest: int = 6) -> DataFrame:
    """Every row's number of words, its runs (start, length and period in words) and its text without repetitions.

    ``collapsed`` is the words that stay, with one space between. Null and empty texts have no words and no runs.
    Rows are independent: repeated rows give repeated results, an empty table an empty one, other columns are ignored.
    Texts are searched whole, in memory that grows with the row's own text. There is no shuffle.
    """
    if exponent < 2 or shortest < 2:
        raise ValueError("a run has at least two periods and two words")
    kind = dict(docs.dtypes)[id_column]
    fields = f"key {kind}, n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sizes, flat, texts = [], [0], [], []
            for text in batch.column(1):
                words = WORDS.findall(text.as_py() or "")
                interned: dict[str, int] = {}
                ids = np.array([interned.setdefault(x, len(interned)) for x in words], np.int64)
                found = runs(ids, exponent, shortest) if len(words) >= shortest else []
                if found:
                    words = [x for x, stays in zip(words, collapse(len(words), found).tolist(), strict=True) if stays]
                counts.append(len(ids))
                flat += found
                sizes.append(len(flat))
                texts.append(" ".join(words))
            offsets = pa.array(sizes, pa.int32())
            columns = np.array(flat, np.int64).reshape(-1, 3)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(columns[:, k])) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), *lists, pa.array(texts, pa.string())], ["key", "n_words", "starts", "lengths", "periods", "collapsed"])

    chosen = docs.select(F.col(id_column).alias("key"), F.col(text_column).cast("string").alias("text"))
    out = chosen.mapInArrow(run, fields)
    listed = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return out.select(F.col("key").alias(id_column), "n_words", listed.alias("runs"), "collapsed")


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Of every row's runs their number, the longest one (ties: least start, then period) and digests; see ``find``."""
    longest = F.expr("element_at(array_sort(transform(runs, r -> struct(-r.length as n, r.start as start, r.period as period, r.length as length))), 1)")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    with_longest = found.withColumn("longest", F.when(F.size("runs") > 0, longest))
    return with_longest.select(
        id_column,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def planted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows with a periodic tail in about each tenth text, by the CRC of the id's digits (null ids: none).

    With h that CRC, g = h div 10 and n words, texts with h mod 10 = 0 repeat from word g mod n on with period
    1 + (n - g mod n) div (3 + g mod 8); their words are then joined by single spaces. Other texts stay as they are.
    """
    words = f"filter(split({text_column}, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> '')"
    tail = "transform(sequence(0, size(v) - 1), i -> if(i < g % size(v), v[i], v[int(g % size(v) + (i - g % size(v)) % (1 + (size(v) - g % size(v)) div (3 + g % 8)))]))"
    changed = F.expr(f"element_at(transform(array({words}), v -> if(size(v) = 0, '', array_join({tail}, ' '))), 1)")
    h = F.crc32(F.col(id_column).cast("string"))
    rows = docs.select(F.col(id_column), F.col(text_column), F.floor(h / 10).alias("g"), (h % 10 == 0).alias("chosen"))
    return rows.select(id_column, F.when(F.col("chosen"), changed).otherwise(F.col(text_column)).alias(text_column))
