"""Quality rules: statistics of each text, and an isolation forest that finds texts whose statistics stand apart.

The forest is grown on statistics of labelled good documents; a document's score is its mean path length
over the trees' random splits. The threshold comes from labelled rows: the highest cut that still keeps
nearly all good ones, moved down to the widest gap between the labelled classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskb.llm import words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_EXTRA = ("upper", "letters", "marks", "digits", "distinct_words")


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int32)  # blocks are far below two billion bytes
    np.cumsum(flags, dtype=np.int32, out=total[1:])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.int64)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def repeat_words(hashes: np.ndarray, row: np.ndarray, n_rows: int, window: int = 8) -> np.ndarray:
    """For each row, its words that lie in runs of ``window`` words found twice or more in it."""
    covered = np.zeros(len(hashes) + window, np.int32)
    n = len(hashes) - window + 1
    if n > 0:
        row_key = words.mix(np.arange(1, n_rows + 1, dtype=np.uint64))
        grams = np.zeros(n, np.uint64)
        for k in range(window):
            grams = grams * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n]
        whole = np.flatnonzero(row[:n] == row[window - 1 :])
        again = whole[_repeated(words.mix(grams[whole]) + row_key[row[whole]])]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + window, -1)
    hit = np.cumsum(covered)[: len(hashes)] > 0
    return np.bincount(row[hit], minlength=n_rows)


def statistics(raw: np.ndarray, offsets: np.ndarray, window: int = 8) -> dict[str, np.ndarray]:
    """The rules' counts for each row of a block of texts."""
    n_rows = len(offsets) - 1
    start, end, row = words.spans(raw, offsets)
    inside = np.zeros(len(raw) + 1, np.int8)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    lead = (raw & 0xC0) != 0x80
    out = {"n_words": np.bincount(row, minlength=n_rows), "word_chars": _per_row(lead & inside, offsets)}
    table = np.zeros(256, bool)
    table[list(SYMBOLS.encode())] = True
    out["n_symbols"] = _per_row(table[raw], offsets)

    row_key = words.mix(np.arange(1, n_rows + 1, dtype=np.uint64))
    breaks = np.flatnonzero(raw == 10)
    line_start = np.union1d(offsets[:-1], breaks + 1)
    line_start = line_start[line_start < len(raw)]
    line_end = np.minimum(np.append(line_start[1:], len(raw)), len(raw))
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    line_end = np.where((line_end > line_start) & (raw[np.maximum(line_end - 1, 0)] == 10), line_end - 1, line_end) if len(raw) else line_end
    seen = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    has_word = seen[line_end] > seen[line_start]
    line_start, line_end, line_row = line_start[has_word], line_end[has_word], line_row[has_word]
    keys = words.span_hashes(raw, line_start, line_end) + row_key[line_row]
    distinct, first = np.unique(keys, return_index=True)
    out["n_dup_lines"] = np.bincount(line_row, minlength=n_rows) - np.bincount(line_row[first], minlength=n_rows)

    hashes = words.span_hashes(raw, start, end)
    out["n_repeat_words"] = repeat_words(hashes, row, n_rows, window)

    distinct, first = np.unique(hashes + row_key[row], return_index=True)
    out["distinct_words"] = np.bincount(row[first], minlength=n_rows)
    upper = (raw >= 65) & (raw <= 90)
    lower = (raw >= 97) & (raw <= 122)
    out["upper"], out["letters"] = _per_row(upper, offsets), _per_row(upper | lower, offsets)
    out["marks"] = _per_row((raw == 33) | (raw == 63), offsets)
    out["digits"] = _per_row((raw >= 48) & (raw <= 57), offsets)
    return out


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """The forest's inputs: rates that hardly depend on the length of a text."""
    n = np.maximum(s["n_words"], 1)
    return np.stack(
        [
            s["word_chars"] / n,
            s["n_symbols"] / n,
            np.minimum(s["n_dup_lines"], 20) / np.sqrt(n),
            s["n_repeat_words"] / n,
            s["upper"] / np.maximum(s["letters"], 1),
            s["marks"] / n,
            s["digits"] / n,
            1 - (s["distinct_words"] / n) ** (1 / np.log2(n + 2)),
        ],
        axis=1,
    ).astype(np.float32)


@dataclass
class Forest:
    """Isolation trees in flat arrays; node k's children are 2k+1 and 2k+2, a leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray
    depth: int
    threshold: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Mean path length over the trees: short for anomalies."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, path in zip(self.feature, self.cut, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                go = 2 * node + 1 + (x[rows, np.maximum(f, 0)] >= cut[node])
                node = np.where(f < 0, node, go)
            total += path[node]
        return total / len(self.feature)


def _expected(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a tree of n points."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 7) -> Forest:
    """Isolation trees over random samples, each split at a random value of a random feature."""
    rng, depth = np.random.default_rng(seed), int(np.ceil(np.log2(sample))) + 2
    size = (1 << (depth + 1)) - 1
    feature, cut, path = np.full((trees, size), -1, np.int64), np.zeros((trees, size), np.float32), np.zeros((trees, size))
    low, high = (x.min(0), x.max(0)) if len(x) else (np.zeros(1), np.zeros(1))
    margin = np.maximum((high - low) * 0.25, 1e-3)
    for t in range(trees if len(x) else 0):
        chosen = x[rng.choice(len(x), min(sample, len(x)), replace=False)]
        todo = [(0, chosen, low - margin, high + margin, 0)]
        while todo:
            node, here, a, b, level = todo.pop()
            if level >= depth or len(here) <= 1:
                path[t, node] = level + _expected(len(here))
                continue
            f = int(rng.integers(x.shape[1]))
            # the node's box is split, not the sample's range: space beyond all good rows is cut off early
            c = rng.uniform(a[f], b[f])
            feature[t, node], cut[t, node] = f, c
            right = here[:, f] >= c
            for child, part, side in ((2 * node + 1, here[~right], 0), (2 * node + 2, here[right], 1)):
                a2, b2 = a.copy(), b.copy()
                (b2 if side == 0 else a2)[f] = c
                todo.append((child, part, a2, b2, level + 1))
    return Forest(feature, cut, path, depth)


def calibrate(forest: Forest, good: np.ndarray, bad: np.ndarray, keep: float = 0.998) -> Forest:
    """Threshold under which a path length is an anomaly: no more than 1 - ``keep`` of good rows fall below it."""
    if not len(good):
        forest.threshold = -np.inf
        return forest
    a = np.sort(forest.score(good))
    limit = a[int(len(a) * (1 - keep))]
    forest.threshold = float(limit)
    if len(bad):
        b = np.sort(forest.score(bad))
        below = b[b < limit]
        if len(below):
            forest.threshold = float((limit + np.quantile(below, 0.995)) / 2)
    return forest


def _measure(batch: pa.RecordBatch, column: int) -> dict[str, np.ndarray]:
    raw, offsets = words.column_bytes(batch.column(column))
    parts = [statistics(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in words.blocks(offsets)]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (*BASE, *_EXTRA)}


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """At most ``rows`` labelled documents, the same whatever the order of rows: those first by a hash of their id."""
    first = labels.where(F.col(id_column).isNotNull() & F.col("quality").isNotNull()).dropDuplicates([id_column])
    first = first.orderBy(F.xxhash64(F.lit(3), id_column), id_column).limit(rows)
    # the broadcast side has at most ``rows`` rows of two numbers
    return docs.select(id_column, F.col(text_column).cast("string").alias(text_column)).join(F.broadcast(first.select(id_column, "quality")), id_column)


def fit(docs: DataFrame, labels: DataFrame, rows: int = 6000, trees: int = 100, id_column: str = "doc_id", text_column: str = "text") -> Forest:
    """A calibrated forest from at most ``rows`` labelled documents; without any it keeps all.

    Null ids and labels without a quality are left out, null and empty texts fail the base rules and don't count; of
    repeated ids no more than ``rows`` rows are used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _measure(batch, 0)
            ok = (s["n_words"] >= 20) & (100 * s["n_repeat_words"] <= 30 * s["n_words"])
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(ok), pa.array(list(features(s)), pa.list_(pa.float32()))], ["quality", "h", "ok", "x"])

    got = labelled_sample(docs, labels, rows, id_column, text_column).select(text_column, F.col("quality").cast("int").alias("quality"), F.xxhash64(id_column, text_column).alias("h"))
    found = got.select(text_column, "quality", "h").mapInArrow(run, "quality int, h long, ok boolean, x array<float>").orderBy("h").limit(rows).collect()
    found.sort(key=lambda r: (r["quality"], r["x"]))
    pick = lambda q: np.array([r["x"] for r in found if r["quality"] == q and r["ok"]], np.float32).reshape(-1, 8)
    good, bad = pick(1), pick(0)
    order = np.random.default_rng(5).permutation(len(good))
    half = len(good) * 2 // 3
    return calibrate(grow(good[order[:half]], trees), good[order[half:]], bad)


def judge(docs: DataFrame, forest: Forest, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The base counts of every document, whether the base rules fail it, its path length and whether it is kept.

    Null and empty texts have no words and fail. Rows are independent: repeated rows give repeated results,
    an empty table none; other columns are ignored. There is no shuffle.
    """
    kind = dict(docs.dtypes)[id_column]
    fields = f"{id_column} {kind}, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, path_length double"
    names = [x.split()[0] for x in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _measure(batch, 1)
            failed = (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])
            path = forest.score(features(s))
            columns = [batch.column(0), *(pa.array(s[c].astype(np.int64)) for c in BASE), pa.array(failed), pa.array(~failed & (path >= forest.threshold)), pa.array(path)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_column, F.col(text_column).cast("string").alias(text_column)).mapInArrow(run, fields)
