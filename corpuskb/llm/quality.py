"""Quality classifier by a weak-label model.

Overlapping heuristic labellers vote good, bad or abstain on every document. Expectation-maximisation over
the counts of vote patterns in the whole corpus estimates each labeller's accuracy and gives each pattern a
posterior; posteriors of a bounded sample train a hashed linear scorer, which judges every document.
One labeller counts abuse: words and word beginnings that labelled toxic documents hold and others don't. Where it
votes bad the document goes, whatever the scorer says, since few such words make a text toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskb.llm import rules, words

#: Each labeller's statistic, up to where it votes good and from where it votes bad.
LABELLERS = (
    ("symbols per word", 0.10, 0.35),
    ("share of words with a symbol", 0.10, 0.30),
    ("share of words that end in a mark other than those of sentences", 0.10, 0.30),
    ("share of upper case", 0.25, 0.60),
    ("exclamation and question marks per word", 0.10, 0.40),
    ("share of words in repeated 8-word runs", 0.10, 0.30),
    ("share of words equal to the word before", 0.05, 0.30),
    ("words longer than 40 characters per word", 0.01, 0.20),
    ("words without a letter per word", 0.15, 0.45),
)
#: The abuse labeller's place in a pattern: good without hits, bad from the calibrated weight on.
ABUSE = len(LABELLERS)
N_LABELLERS = ABUSE + 1
SLOTS = 1 << 15
_SYMBOL, _PLAIN_END = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOL[list(rules.SYMBOLS.encode())] = True
_PLAIN_END[list(b".,;:!?)]\"'0123456789-")] = True
PREFIX = 7


@dataclass
class Model:
    """What scoring needs: a few fixed-size arrays."""

    posterior: dict[int, float] = field(default_factory=dict)
    accuracy: list[tuple[float, float]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS, np.float32))
    bias: float = 5.0
    threshold: float = 0.5
    abuse: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    #: 2 for words that no labelled clean document holds, 1 for the others
    abuse_weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    abuse_hits: int = 2


class Block:
    """Words of a block of texts with what the labellers and the scorer read."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.n = len(offsets) - 1
        self.raw, self.offsets = raw, offsets
        self.start, self.end, self.row = words.spans(raw, offsets)
        self.count = np.bincount(self.row, minlength=self.n)
        self.hash = words.span_hashes(raw, self.start, self.end)
        self.again = np.zeros(len(self.hash), bool)
        self.again[1:] = (self.hash[1:] == self.hash[:-1]) & (self.row[1:] == self.row[:-1])

    def _in_word(self, flags: np.ndarray, dense: bool = False) -> np.ndarray:
        """How many flagged bytes each word has; flagged bytes lie in words."""
        if dense:
            total = np.zeros(len(flags) + 1, np.int32)  # a block is far below two billion bytes
            np.cumsum(flags, dtype=np.int32, out=total[1:])
            return total[self.end] - total[self.start]
        return np.bincount(np.searchsorted(self.start, np.flatnonzero(flags), "right") - 1, minlength=len(self.start))

    def shapes(self) -> dict[str, np.ndarray]:
        raw = self.raw
        upper = (raw >= 65) & (raw <= 90)
        letter = upper | ((raw >= 97) & (raw <= 122)) | (raw >= 0x80)
        mark = (raw == 33) | (raw == 63)
        last = raw[self.end - 1] if len(self.end) else raw[:0]
        odd = (last < 0x80) & ~letter[self.end - 1] & ~_PLAIN_END[last] if len(self.end) else np.zeros(0, bool)
        # only words of over 40 bytes can have over 40 characters
        length = self.end - self.start
        for k in np.flatnonzero(length > 40).tolist():
            length[k] = np.count_nonzero((raw[self.start[k] : self.end[k]] & 0xC0) != 0x80)
        return {"odd_end": odd, "upper": self._in_word(upper), "letter": self._in_word(letter, True), "symbol": self._in_word(_SYMBOL[raw]), "mark": self._in_word(mark), "digit": self._in_word((raw >= 48) & (raw <= 57)), "length": length}

    def votes(self, shapes: dict[str, np.ndarray], model: Model, abuse: np.ndarray) -> np.ndarray:
        """A pattern number of every row: two bits a labeller, 0 abstains, 1 good, 2 bad."""
        n = np.maximum(self.count, 1)
        total = lambda x: np.bincount(self.row, weights=x, minlength=self.n)
        upper = total(shapes["upper"])
        lower = rules._per_row((self.raw >= 97) & (self.raw <= 122), self.offsets)
        rates = (
            total(shapes["symbol"]) / n,
            total(shapes["symbol"] > 0) / n,
            total(shapes["odd_end"]) / n,
            upper / np.maximum(upper + lower, 1),
            total(shapes["mark"]) / n,
            rules.repeat_words(self.hash, self.row, self.n) / n,
            total(self.again) / n,
            total(shapes["length"] > 40) / n,
            total(shapes["letter"] == 0) / n,
        )
        pattern = np.zeros(self.n, np.int64)
        for k, (rate, (_, good, bad)) in enumerate(zip(rates, LABELLERS, strict=True)):
            vote = np.where(rate >= bad, 2, np.where(rate <= good, 1, 0))
            pattern |= np.where(self.count > 0, vote, 2) << (2 * k)
        if len(model.abuse):
            pattern |= np.where(abuse >= model.abuse_hits, 2, np.where(abuse == 0, 1, 0)) << (2 * ABUSE)
        return pattern

    def slots(self, shapes: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Hashed features of every word: itself, its shape, and whether it repeats the word before."""
        cap = lambda x, most: np.minimum(x, most).astype(np.uint64)
        last = self.raw[self.end - 1].astype(np.uint64) if len(self.end) else np.zeros(0, np.uint64)
        ascii_end = np.where(last < 0x30, last, np.uint64(0))
        all_upper = ((shapes["upper"] > 1) & (shapes["upper"] * 2 > shapes["letter"])).astype(np.uint64)
        shape = cap(shapes["symbol"], 3) + np.uint64(4) * cap(shapes["mark"], 2) + np.uint64(12) * all_upper + np.uint64(24) * cap(shapes["letter"], 1) + np.uint64(48) * cap(shapes["digit"], 1) + np.uint64(96) * self.again.astype(np.uint64)
        mask = np.uint64(SLOTS // 2 - 1)
        rich = np.uint64(SLOTS // 2) + (words.mix(shape * np.uint64(64) + ascii_end) & mask)
        return (self.hash & mask).astype(np.int64), rich.astype(np.int64)

    def score(self, model: Model, shapes: dict[str, np.ndarray]) -> np.ndarray:
        """The scorer's probability that a row is good."""
        a, b = self.slots(shapes)
        z = np.bincount(self.row, weights=model.weights[a] + model.weights[b], minlength=self.n) / np.maximum(self.count, 1) + model.bias
        return np.where(self.count > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)

    def stems(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the lower-case words without marks at their ends, and of their first bytes."""
        low = np.where((self.raw >= 65) & (self.raw <= 90), self.raw + 32, self.raw).astype(np.uint8)
        # C3 80-9E are Latin capitals; their small letters lie 0x20 above
        two = np.zeros(len(low), bool)
        two[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E)
        low[two] += 32
        plain = ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)) | (low >= 0x80)
        start, end = self.start.copy(), self.end.copy()
        for _ in range(4):
            start += (start < end) & ~plain[np.minimum(start, len(plain) - 1)] if len(plain) else 0
        for _ in range(4):
            end -= (end > start) & ~plain[np.maximum(end - 1, 0)] if len(plain) else 0
        whole = words.span_hashes(low, start, end)
        head = np.where(end - start > PREFIX, start + PREFIX, end)
        return whole, words.mix(words.span_hashes(low, start, head) + np.uint64(1))

    def abuse_hits(self, model: Model) -> np.ndarray:
        """The weight of each row's abuse words."""
        if not len(model.abuse):
            return np.zeros(self.n, np.int64)
        hit = np.zeros(len(self.hash), np.int64)
        for h in self.stems():
            at = np.minimum(np.searchsorted(model.abuse, h), len(model.abuse) - 1)
            hit = np.maximum(hit, np.where(model.abuse[at] == h, model.abuse_weight[at], 0))
        return np.bincount(self.row, weights=hit, minlength=self.n).astype(np.int64)


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, Block]]:
    raw, offsets = words.column_bytes(batch.column(column))
    for a, b in words.blocks(offsets):
        yield a, b, Block(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def vote_counts(docs: DataFrame, model: Model, text_column: str = "text") -> dict[int, int]:
    """How many documents have each vote pattern: at most 3 ** N_LABELLERS numbers, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            for _, _, block in _blocks(batch, 0):
                for pattern, n in zip(*np.unique(block.votes(block.shapes(), model, block.abuse_hits(model)), return_counts=True), strict=True):
                    seen[int(pattern)] = seen.get(int(pattern), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["pattern", "n"])

    found = docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(run, "pattern long, n long")
    return {r["pattern"]: r["n"] for r in found.groupBy("pattern").agg(F.sum("n").alias("n")).collect()}


def expectation_maximisation(counts: dict[int, int], rounds: int = 50) -> tuple[dict[int, float], list[tuple[float, float]]]:
    """Posterior of being good for every pattern, and each labeller's accuracy on good and on bad documents.

    Starts from the view that any bad vote is right; abstentions carry no evidence.
    """
    if not counts:
        return {}, [(0.5, 0.5)] * N_LABELLERS
    patterns = np.array(sorted(counts))
    n = np.array([counts[int(p)] for p in patterns], float)
    votes = np.stack([(patterns >> (2 * k)) & 3 for k in range(N_LABELLERS)], 1)
    good = np.where((votes == 2).any(1), 0.1, 0.95)
    right = np.full((2, N_LABELLERS), 0.8)
    for _ in range(rounds):
        for side, p in ((0, good), (1, 1 - good)):
            said = (votes != 0) * (n * p)[:, None]
            agreed = (votes == (1 if side == 0 else 2)) * (n * p)[:, None]
            # labellers seldom speak against a good document; each may know only one kind of bad ones
            right[side] = np.clip((agreed.sum(0) + 4) / (said.sum(0) + 5), 0.15 if side else 0.9, 0.9995)
        prior = np.clip((n * good).sum() / n.sum(), 0.05, 0.98)
        logit = np.full(len(patterns), np.log(prior / (1 - prior)))
        for k in range(N_LABELLERS):
            logit += np.where(votes[:, k] == 1, np.log(right[0, k] / (1 - right[1, k])), np.where(votes[:, k] == 2, np.log((1 - right[0, k]) / right[1, k]), 0))
        good = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return dict(zip(map(int, patterns), map(float, good), strict=True)), list(zip(right[0], right[1], strict=True))


def fit(docs: DataFrame, labels: DataFrame | None, rows: int = 6000, id_column: str = "doc_id", text_column: str = "text", keep: float = 0.9995, seed: int = 11) -> Model:
    """The model: patterns and accuracies from all documents, the scorer from at most ``rows`` with posterior labels.

    Labelled rows, at most ``rows``, give the abuse words and set the scorer's threshold (at least ``keep`` of the
    good ones stay); without labels the threshold is one half and the abuse labeller abstains. Repeated ids count
    as rows, of which no more than ``rows`` are used; null ids are in neither sample. An empty table gives a model that keeps
    all texts with words.
    """
    model = Model()
    known = None if labels is None else _labelled(docs, labels, rows, id_column, text_column)
    if known is not None:
        _find_abuse(model, known, rows)
    model.posterior, model.accuracy = expectation_maximisation(vote_counts(docs, model, text_column))
    chosen = docs.select(id_column).where(F.col(id_column).isNotNull()).orderBy(F.xxhash64(F.lit(seed), id_column)).limit(rows).distinct()
    posterior = model.posterior

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, index, value = [], [], []
            for _, _, block in _blocks(batch, 0):
                shapes = block.shapes()
                p += [posterior.get(int(x), 0.5) for x in block.votes(shapes, model, block.abuse_hits(model))]
                a, b = block.slots(shapes)
                key = np.concatenate([block.row, block.row]) * SLOTS + np.concatenate([a, b])
                found, n = np.unique(key, return_counts=True)
                cuts = np.searchsorted(found // SLOTS, np.arange(1, block.n))
                share = (n / np.maximum(block.count, 1)[found // SLOTS]).astype(np.float32)
                index += np.split((found % SLOTS).astype(np.int32), cuts)
                value += np.split(share, cuts)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(p, pa.float64()), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))], ["h", "p", "i", "v"])

    text = F.col(text_column).cast("string").alias("text")
    sample = docs.select(id_column, text).join(F.broadcast(chosen), id_column).select("text", F.xxhash64(id_column, "text").alias("h"))
    # an id may name many rows: no more than ``rows`` come to the driver
    sample = sample.mapInArrow(gather, "h long, p double, i array<int>, v array<float>").orderBy("h").limit(rows).drop("h").toArrow()
    _descend(model, sample, seed)
    if known is not None:
        _set_threshold(model, known, rows, keep)
    return model


def _descend(model: Model, sample: pa.Table, seed: int, epochs: int = 12, rate: float = 4.0) -> None:
    """Logistic regression on posterior labels by averaged-gradient steps over mini-batches."""
    if not sample.num_rows:
        return
    index, value = sample.column("i").combine_chunks(), sample.column("v").combine_chunks()
    ends = np.asarray(index.offsets)
    ind, val = np.asarray(index.values), np.asarray(value.values)
    p = sample.column("p").to_numpy()
    order = np.lexsort((ends[1:] - ends[:-1], p))  # the same order whatever the order of rows
    row = np.repeat(np.arange(len(p)), ends[1:] - ends[:-1])
    weight = np.where(p < 0.5, max(1.0, min(8.0, (p >= 0.5).sum() / max(1, (p < 0.5).sum()))), 1.0)
    w, b, g2 = np.zeros(SLOTS), 1.0, np.full(SLOTS, 1e-4)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for part in np.array_split(order[rng.permutation(len(order))], max(1, len(order) // 256)):
            inside = np.zeros(len(p), bool)
            inside[part] = True
            at = inside[row]
            z = np.bincount(row[at], weights=w[ind[at]] * val[at], minlength=len(p))[part] + b
            e = np.zeros(len(p))
            e[part] = weight[part] * (p[part] - 1 / (1 + np.exp(-np.clip(z, -30, 30))))
            g = np.bincount(ind[at], weights=e[row[at]] * val[at], minlength=SLOTS) / len(part)
            g2 += g * g
            w += rate * 0.1 * g / np.sqrt(g2) - 1e-5 * w
            b += 0.2 * e[part].mean()
    model.weights, model.bias = w.astype(np.float32), float(b)


def _labelled(docs: DataFrame, labels: DataFrame, rows: int, id_column: str, text_column: str) -> DataFrame:
    """(text, quality, toxic, h) of the documents of at most ``rows`` labels."""
    first = labels.where(F.col(id_column).isNotNull()).dropDuplicates([id_column]).orderBy(F.xxhash64(F.lit(3), id_column), id_column).limit(rows)
    first = first.select(id_column, F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))
    known = docs.select(id_column, F.col(text_column).cast("string").alias("text")).join(F.broadcast(first), id_column)
    return known.select("text", "quality", "toxic", F.xxhash64(id_column, "text").alias("h"))


def _find_abuse(model: Model, known: DataFrame, rows: int) -> None:
    def stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.asarray(batch.column(2).fill_null(0))
            for a, _, block in _blocks(batch, 0):
                key, flag = [], []
                for h in block.stems():
                    pair = np.unique(np.stack([h, block.row.astype(np.uint64)], 1), axis=0)
                    key.append(pair[:, 0])
                    flag.append(toxic[a + pair[:, 1].astype(np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(key).view(np.int64)), pa.array(np.concatenate(flag).astype(np.int32))], ["h", "t"])

    found = known.select("text", "quality", "toxic").mapInArrow(stems, "h long, t int").groupBy("h").agg(F.sum("t").alias("t"), F.count("*").alias("n"))
    # eight toxic documents for each such word, of at most ``rows``: no more words than they hold
    found = found.where("t >= 8 and t >= 0.85 * n").orderBy("h").collect()
    h = np.array([r["h"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(h)
    model.abuse = h[order]
    model.abuse_weight = np.array([2 if r["t"] == r["n"] else 1 for r in found], np.int64)[order]

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [block.abuse_hits(model) for _, _, block in _blocks(batch, 0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(np.concatenate(n) if n else np.zeros(0, np.int64))], ["t", "k"])

    # how many clean documents have each weight: the least weight that nearly none has is bad
    clean = known.where("toxic = 0").select("text", "toxic").mapInArrow(hits, "t int, k long").groupBy(F.least("k", F.lit(9)).alias("k")).count().collect()
    total = sum(r["count"] for r in clean)
    model.abuse_hits = next((k for k in range(1, 9) if sum(r["count"] for r in clean if r["k"] >= k) <= 0.002 * total), 9) if total else 2


def _set_threshold(model: Model, known: DataFrame, rows: int, keep: float) -> None:
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [block.score(model, block.shapes()) for _, _, block in _blocks(batch, 0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(np.concatenate(score) if score else np.zeros(0))], ["h", "q", "s"])

    seen = known.select("text", "h", "quality").mapInArrow(judge, "h long, q int, s double").orderBy("h").limit(rows).collect()
    good, bad = np.sort([r["s"] for r in seen if r["q"] == 1]), np.sort([r["s"] for r in seen if r["q"] == 0])
    if len(good):
        limit = min(0.5, float(good[int(len(good) * (1 - keep))]))
        below = bad[bad < limit]
        model.threshold = (limit + float(below[int(0.995 * (len(below) - 1))])) / 2 if len(below) else limit


def judge(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row with the posterior of its votes, the scorer's probability, its abuse words' weight, and whether it is kept.

    Null and empty texts have no words and are rejected. Rows are independent: repeated rows give repeated
    results, an empty table none, other columns are ignored. There is no shuffle.
    """
    kind = dict(docs.dtypes)[id_column]
    names = [id_column, "n_words", "posterior", "score", "abuse_hits", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for _, _, block in _blocks(batch, 1):
                shapes = block.shapes()
                abuse = block.abuse_hits(model)
                found = (block.count, np.array([model.posterior.get(int(x), 0.5) for x in block.votes(shapes, model, abuse)]), block.score(model, shapes), abuse)
                for column, x in zip(out, found, strict=True):
                    column.append(x)
            n, posterior, score, hits = (np.concatenate(x) if x else np.zeros(0) for x in out)
            kept = (score >= model.threshold) & (hits < model.abuse_hits)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n.astype(np.int64)), pa.array(posterior), pa.array(score), pa.array(hits.astype(np.int64)), pa.array(kept)], names)

    fields = f"{id_column} {kind}, n_words long, posterior double, score double, abuse_hits long, kept boolean"
    return docs.select(id_column, F.col(text_column).cast("string").alias(text_column)).mapInArrow(run, fields)


def keep_good(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, that the classifier keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, block in _blocks(batch, batch.schema.get_field_index(text_column)):
                kept = (block.score(model, block.shapes()) >= model.threshold) & (block.abuse_hits(model) < model.abuse_hits)
                yield batch.slice(a, b - a).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
