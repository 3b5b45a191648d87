"""Training pairs from conversations and speech: pairing, last-wins fields, exact and fuzzy first-wins deduplication."""

from __future__ import annotations

import difflib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskb.functions.text import norm_text, strip_text, text_hash12
from corpuskb.sources.scratch import stored


def lag_pairs(turns: DataFrame) -> DataFrame:
    """Assistant turns with the turn before them as the prompt; a conversation's first turn has none."""
    order = W.partitionBy("conv_id").orderBy("turn")
    out = turns.select("conv_id", "turn", "role", "text", F.lag("role").over(order).alias("asked_by"), F.lag("text").over(order).alias("prompt"))
    return out.where("role = 'assistant'").select("conv_id", "turn", "asked_by", "prompt", F.col("text").alias("answer"))


def message_fields(turns: DataFrame) -> DataFrame:
    """System, user and assistant text of every conversation; the last turn of a role wins."""
    last = lambda role: F.max_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn"))).alias(role)
    return turns.groupBy("conv_id").agg(last("system"), last("user"), last("assistant"))


def neighbour_window(turns: DataFrame, n: int = 1) -> DataFrame:
    """Every turn's text with ``n`` turns on either side, joined by blank lines."""
    near = W.partitionBy("conv_id").orderBy("turn").rowsBetween(-n, n)
    return turns.select("conv_id", "turn", F.array_join(F.collect_list("text").over(near), "\n\n").alias("context"))


def exact_first(pairs: DataFrame) -> DataFrame:
    """The first pair of each (prompt, answer) hash in order of conversation and turn, by a combining aggregate.

    The whole digest tells pairs apart, its first digits are shown.
    """
    both = F.concat(F.coalesce("prompt", F.lit("")), F.coalesce("answer", F.lit("")))
    keyed = pairs.select("*", text_hash12(both).alias("pair_hash"), F.md5(F.lower(strip_text(both))).alias("_digest"))
    columns = [c for c in pairs.columns if c not in ("conv_id", "turn")]
    return keyed.groupBy("_digest", "pair_hash").agg(F.min(F.struct("conv_id", "turn", *columns)).alias("x"), F.count("*").alias("n_copies")).select("x.*", "pair_hash", "n_copies")


class Kept:
    """The last ``window`` texts kept, and whether another one is too like one of them.

    Matching blocks that make up more than ``ratio`` of two texts share characters and runs of neighbouring characters:
    of M matched ones in k blocks, M - (q - 1) k runs of q. Blocks are at most one more than the characters left over, and,
    as the matcher begins them at characters that are rare in a text of 200 or more, at most as many as rare characters
    are shared. Shared runs are counted against all kept texts at once, hashed into columns, which can only raise
    them; blocks are only sought in texts that get through.
    """

    #: Run lengths, and the columns that each is hashed into.
    _RUNS = {1: 256, 2: 1024, 4: 4096}

    def __init__(self, window: int, ratio: float):
        self.window, self.ratio, self.texts, self._next = window, ratio, [], 0
        self._counts = {q: np.zeros((window, columns), np.int32) for q, columns in self._RUNS.items()}
        self._lengths = np.zeros(window, np.int64)

    def _counted(self, text: str) -> dict[int, np.ndarray]:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        out = {}
        for q, columns in self._RUNS.items():
            runs = np.zeros(max(len(codes) - q + 1, 0), np.int64)
            for k in range(q if len(runs) else 0):
                runs = runs * 31 + codes[k : len(codes) - q + 1 + k]
            out[q] = np.bincount(runs % columns, minlength=columns)
        return out

    def _begins(self, text: str) -> np.ndarray:
        """The columns of characters that a block can begin at: for long texts those that make up a hundredth at most."""
        seen = Counter(text)
        most = len(text) // 100 + 1 if len(text) >= 200 else len(text)
        mask = np.zeros(self._RUNS[1], bool)
        mask[[ord(c) % self._RUNS[1] for c, n in seen.items() if n <= most]] = True
        return mask

    def takes(self, text: str) -> bool:
        """Whether a text is unlike all kept ones; then it is kept."""
        counts = self._counted(text)
        open_ = np.flatnonzero(np.abs(len(text) - self._lengths[: len(self.texts)]) <= 0.3 * len(text))
        both = self._lengths[open_] + len(text)
        shared = np.minimum(self._counts[1][open_], counts[1])
        needed = self.ratio * both / 2
        blocks = np.minimum(both - 2 * needed + 1, shared[:, self._begins(text)].sum(axis=1))
        alike = shared.sum(axis=1) >= needed
        for q in [q for q in self._RUNS if q > 1]:
            open_, needed, blocks = open_[alike], needed[alike], blocks[alike]
            alike = np.minimum(self._counts[q][open_], counts[q]).sum(axis=1) >= needed - (q - 1) * blocks
        match = difflib.SequenceMatcher(None, "", text)
        for k in open_[alike].tolist():
            # difflib's ratio depends on the order, the kept text comes first
            match.set_seq1(self.texts[k])
            if match.ratio() > self.ratio:
                return False
        self.keep(text, counts)
        return True

    def keep(self, text: str, counts: dict[int, np.ndarray] | None = None) -> None:
        if len(self.texts) < self.window:
            self.texts.append(text)
        else:
            self.texts[self._next] = text
        for q, found in (counts or self._counted(text)).items():
            self._counts[q][self._next] = found
        self._lengths[self._next] = len(text)
        self._next = (self._next + 1) % self.window

    def last(self) -> list[str]:
        """The kept texts in order."""
        return self.texts[self._next :] + self.texts[: self._next] if len(self.texts) == self.window else list(self.texts)


def fuzzy_first(pairs: DataFrame, group: str, text: str, order: list[str], window: int = 200, ratio: float = 0.85) -> DataFrame:
    """Greedy first-wins near deduplication within each group, in order: a text goes if it is too like one of the last ``window`` kept.

    Lengths that differ by over 30 % are not compared. A group's rows stream through one task in order, and
    only the window is held, whatever the group's size. Null texts are empty.
    """
    ordered = pairs.repartition(group).sortWithinPartitions(group, *order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, kept = None, Kept(window, ratio)
        for frame in batches:
            keep = []
            for key, value in zip(frame[group], frame[text].fillna(""), strict=True):
                if here is None or key != here:
                    here, kept = key, Kept(window, ratio)
                keep.append(kept.takes(value))
            yield frame[keep]

    return ordered.mapInPandas(run, ordered.schema)


def fuzzy_first_overall(pairs: DataFrame, text: str, order: list[str], window: int = 200, ratio: float = 0.85, parts: int | None = None) -> DataFrame:
    """Greedy first-wins near deduplication over all rows in order: a text goes if it is too like one of the last ``window`` kept.

    Ranges of the order are judged apart, each after the texts that its predecessor last kept. Those are not known
    at first, so ranges whose predecessor's last texts have changed are judged again until none has: the result
    is that of one pass. Only a range's window is held. Null texts are empty.
    """
    ranged = pairs.repartitionByRange(parts, *order) if parts else pairs.repartitionByRange(*order)
    dealt = stored(ranged.select("*", F.spark_partition_id().alias("_part")), "dealt")
    lasts = pairs.sparkSession.createDataFrame([], f"_part int, _pos int, {text} string")
    # rows of last texts have no other columns
    fields = T.StructType([*(T.StructField(f.name, f.dataType) for f in dealt.schema.fields), T.StructField("_pos", T.IntegerType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, kept = None, Kept(window, ratio)

        def last() -> pd.DataFrame:
            texts = kept.last()
            return pd.DataFrame({"_part": here, "_pos": range(len(texts)), text: texts}).reindex(columns=fields.names).astype({c: object for c in fields.names if c not in ("_part", "_pos", text)})

        for frame in batches:
            keep = []
            for part, guest, value in zip(frame["_part"], frame["_pos"] >= 0, frame[text].fillna(""), strict=True):
                if part != here:
                    if here is not None:
                        yield last()
                    here, kept = part, Kept(window, ratio)
                if guest:
                    kept.keep(value)
                    keep.append(False)
                else:
                    keep.append(kept.takes(value))
            yield frame[keep].assign(_pos=-1)
        if here is not None:
            yield last()

    filled = sorted(r["_part"] for r in dealt.select("_part").distinct().collect())
    after = dict(zip(filled, filled[1:], strict=False))
    stale, judged, ends = set(filled), {}, {}
    while stale:
        # a range's last texts are the next one's guests
        own = dealt.where(F.col("_part").isin(*stale)).withColumn("_pos", F.lit(-1))
        rows = own.unionByName(lasts.where(F.col("_part").isin(*stale)), allowMissingColumns=True).withColumn("_own", F.col("_pos") < 0)
        found = rows.repartition("_part").sortWithinPartitions("_part", "_own", "_pos", *order).select(*fields.names).mapInPandas(run, fields)
        found = stored(found, "judged")
        judged |= {p: found for p in stale}
        ended = {r["_part"]: r["h"] for r in found.where("_pos >= 0").groupBy("_part").agg(F.md5(F.to_json(F.sort_array(F.collect_list(F.struct("_pos", text))))).alias("h")).collect()}
        changed = {p for p in ended if ended[p] != ends.get(p)}
        ends |= ended
        stale = {after[p] for p in changed if p in after}
        # at most ``window`` texts of each range
        for p in changed & after.keys():
            mine = found.where((F.col("_pos") >= 0) & (F.col("_part") == p)).select(F.lit(after[p]).alias("_part"), "_pos", text)
            lasts = lasts.where(F.col("_part") != after[p]).unionByName(mine)
        lasts = stored(lasts, "lasts")
    out = dealt.where("false").drop("_part")
    for found in {id(f): f for f in judged.values()}.values():
        mine = [p for p, f in judged.items() if f is found]
        out = out.unionByName(found.where((F.col("_pos") < 0) & F.col("_part").isin(*mine)).select(*out.columns))
    return out


def linked_samples(samples: DataFrame, index: DataFrame) -> DataFrame:
    """Samples (prompt, answer) with the chunk of their exact key, else of their answer alone; the first chunk of a key wins."""
    keyed = lambda df: df.select("*", norm_text(F.col("prompt")).alias("kp"), norm_text(F.col("answer")).alias("ka"))
    chunks = keyed(index)
    exact = chunks.groupBy("kp", "ka").agg(F.min("chunk_id").alias("exact_id"))
    loose = chunks.groupBy("ka").agg(F.min("chunk_id").alias("loose_id"))
    return keyed(samples).join(exact, ["kp", "ka"], "left").join(loose, "ka", "left").drop("kp", "ka").withColumn("chunk_id", F.coalesce("exact_id", "loose_id"))
