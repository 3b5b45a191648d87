"""Alignment of two tokenizers' tokens by a dangling-suffix transducer.

Both sides spell the same bytes. While tokens are read, one side leads by a suffix that the other has not spelled yet:
the state is that side and that suffix. The lagging side's next token either spells a part of the suffix, or all of it
and so takes the lead. Where nothing dangles, both sides end at the same byte and a group closes. A state is an entry
of a table by side and suffix and remembers where each next token leads, so text costs one lookup a token.

States and transitions are bounded by the vocabularies, whatever the corpus: a suffix is one of a token's, and a token
that meets a suffix is a prefix of it or begins with it. So are linked pairs: two tokens that end together are one a
suffix of the other, so each token takes part, as the longer one, in at most as many pairs as it has bytes (twice
that for the side whose bytes have two spellings).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskb.llm.bpe import WHITE, tokenizer
from corpuskb.llm.store import materialize

#: Characters of one block: what a task holds of a text's tokens.
BLOCK = 1 << 16
_CUT = re.compile(f"(?<=[^{WHITE}])(?= )")


class State(dict):
    """What dangles: the leading side (0: none, 1: A, 2: B) and its bytes; entries lead from a next token to a state."""

    __slots__ = ("machine", "rest", "side")

    def __init__(self, machine: Transducer, side: int, rest: bytes):
        super().__init__()
        self.machine, self.side, self.rest = machine, side, rest

    def __missing__(self, token: int) -> State:
        spelled = self.machine.spelled[1 if self.side == 1 else 0][token]
        if self.rest.startswith(spelled):
            found = self.machine.state(self.side, self.rest[len(spelled) :])
        elif spelled.startswith(self.rest):
            found = self.machine.state(2 if self.side == 1 else 1, spelled[len(self.rest) :])
        else:
            raise ValueError("the two sides spell different bytes")
        self[token] = found
        return found


class Transducer:
    """Groups of A and B tokens; ``spelled`` holds the bytes of each side's tokens by id."""

    def __init__(self, spelled_a: list[bytes], spelled_b: list[bytes]):
        self.spelled = (spelled_a, spelled_b)
        self._states: dict[tuple[int, bytes], State] = {}
        self.empty = self.state(0, b"")

    def state(self, side: int, rest: bytes) -> State:
        key = (side if rest else 0, rest)
        if key not in self._states:
            self._states[key] = State(self, *key)
        return self._states[key]

    def ends(self, a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
        """How many tokens of A and of B lie before the end of each group."""
        i, j, n, empty = 0, 0, len(a), self.empty
        ends_a, ends_b = [], []
        try:
            while i < n:
                state = empty[a[i]][b[j]]
                i += 1
                j += 1
                while state is not empty:
                    if state.side == 1:
                        state = state[b[j]]
                        j += 1
                    else:
                        state = state[a[i]]
                        i += 1
                ends_a.append(i)
                ends_b.append(j)
        except IndexError:
            raise ValueError("one side is longer") from None
        if j < len(b):
            raise ValueError("one side is longer")
        return ends_a, ends_b


class _Pairs(dict):
    """Groups of one token each as text, by A id << 32 | B id; as many as there can be linked pairs."""

    def __missing__(self, code: int) -> str:
        self[code] = found = f"{code >> 32}|{code & 0xFFFFFFFF}"
        return found


class Aligner:
    """Two vocabularies, their encoders and their transducer."""

    def __init__(self, path_a: str, path_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        t = tokenizer(path_a)
        self.spelled_a = t.token_bytes
        plain = {token: i for i, token in enumerate(t.token_bytes) if i not in t.specials.values() and token}
        if t.ranked and len(plain) == t.size - len(t.specials):
            self.encode_a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=plain, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer as Library

            library = Library.from_file(path_a)
            library.no_truncation()
            library.no_padding()
            library.encode_special_tokens = True
            self.encode_a = lambda text: library.encode(text, add_special_tokens=False).ids
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.spelled_b = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        #: Whether no piece goes on with a space behind another character, so that texts can be cut before spaces.
        self.cuts = not any(" " in s.lstrip(b" ").decode() for i, s in enumerate(self.spelled_b) if not self._b.is_byte(i))
        self.machine = Transducer(self.spelled_a, self.spelled_b)
        self._single = _Pairs()
        self._names = list(map(str, range(max(len(self.spelled_a), len(pieces)))))

    def blocks(self, text: str) -> Iterator[str]:
        """A space and the text, in blocks of about ``BLOCK`` characters that no token of either side crosses."""
        text, start = " " + text, 0
        while start < len(text):
            cut = _CUT.search(text, start + BLOCK) if self.cuts else None
            stop = cut.start() if cut else len(text)
            yield text[start:stop]
            start = stop

    def align(self, text: str) -> Iterator[tuple[int, int, list[str], np.ndarray]]:
        """For every block its token counts, its groups as text and its linked pairs, A id << 32 | B id.

        Raises ValueError where the two sides don't spell the text.
        """
        names = self._names
        for block in self.blocks(text):
            a, b = self.encode_a(block), self._b.encode(block[1:], num_threads=1)
            # what A spells is the text; that B spells the same is what the transducer holds to
            if b"".join([self.spelled_a[i] for i in a]) != block.encode():
                raise ValueError("the tokens don't spell the text")
            ends_a, ends_b = self.machine.ends(a, b)
            to_a, to_b = np.array(ends_a), np.array(ends_b)
            linked = np.array(a, np.int64)[to_a - 1] << 32 | np.array(b, np.int64)[to_b - 1]
            texts = list(map(self._single.__getitem__, linked.tolist()))
            from_a, from_b = np.concatenate(([0], to_a[:-1])), np.concatenate(([0], to_b[:-1]))
            longer = np.flatnonzero((to_a - from_a > 1) | (to_b - from_b > 1))
            for g, i, k, j, m in zip(longer.tolist(), from_a[longer].tolist(), to_a[longer].tolist(), from_b[longer].tolist(), to_b[longer].tolist(), strict=True):
                texts[g] = f"{','.join([names[x] for x in a[i:k]])}|{','.join([names[x] for x in b[j:m]])}"
            yield len(a), len(b), texts, linked


_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of two vocabulary files, made once in each Python process."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Aligner(path_a, path_b)
    return _loaded[path_a, path_b]


def groups(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text", keep_groups: bool = False) -> DataFrame:
    """Every row's token counts, groups and linked pairs with how often each occurs in it.

    ``path_a`` is a byte-level BPE file, ``path_b`` a piece model that adds a space; strings of special tokens are plain
    text. With ``keep_groups`` the groups' text is kept too. Null and empty texts, and those that one side
    can't spell, have no tokens. Texts pass in blocks; one without any space between words is one block. Repeated
    rows give repeated results, an empty table an empty one; other columns are ignored. There is no shuffle.
    """
    kind = dict(docs.dtypes)[id_column]
    fields = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, n array<long>" + ", groups string" * keep_groups
    names = re.findall(r"(\w+) (?:\S+)", fields.replace(f"key {kind}", "key x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in batches:
            counts, digests, kept, sizes, pairs, times = [], [], [], [0], [], []
            for text in batch.column(1):
                digest, n_a, n_b, n_groups, found, shown = hashlib.sha256(), 0, 0, 0, [], []
                try:
                    for more_a, more_b, texts, linked in both.align(text.as_py()) if text.as_py() else ():
                        digest.update((";" * (n_groups > 0) + ";".join(texts)).encode())
                        n_a, n_b, n_groups = n_a + more_a, n_b + more_b, n_groups + len(texts)
                        found.append(np.unique(linked, return_counts=True))
                        if keep_groups:
                            shown.extend(texts)
                except ValueError:
                    n_a, n_b, n_groups, found, shown = 0, 0, 0, [], []
                if len(found) > 1:
                    codes, where = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                    found = [(codes, np.bincount(where, np.concatenate([m for _, m in found])).astype(np.int64))]
                for codes, many in found:
                    pairs.append(codes)
                    times.append(many)
                sizes.append(sizes[-1] + sum(len(c) for c, _ in found))
                counts.append((n_a, n_b, n_groups, n_groups))
                digests.append(digest.hexdigest() if n_groups else "")
                kept.append(";".join(shown))
            codes = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
            many = np.concatenate(times) if times else np.zeros(0, np.int64)
            offsets = pa.array(sizes, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in ((codes >> 32, pa.int32()), (codes & 0xFFFFFFFF, pa.int32()), (many, pa.int64()))]
            numbers = [pa.array(x, pa.int64()) for x in zip(*counts)] if counts else [pa.array([], pa.int64())] * 4
            columns = [batch.column(0), *numbers, pa.array(digests, pa.string()), *lists]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.string())] * keep_groups, names)

    chosen = docs.select(F.col(id_column).alias("key"), F.col(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(run, fields).withColumnRenamed("key", id_column)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How many links of all rows hold each id pair (a, b), and whether none of its B id's pairs has more."""
    pairs = aligned.select(F.explode(F.arrays_zip("a", "b", "n")).alias("x")).groupBy("x.a", "x.b").agg(F.sum("x.n").alias("links"))
    return pairs.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))


def summarize(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row's counts and digest of groups, and what its links weigh among those of all rows.

    ``n_best`` counts links whose pair is as frequent as any of its B id, ``count_sum`` adds their pairs' counts.
    Rows are aligned once, into a table of the shared folder. The table of pairs is bounded by the vocabularies
    (see the module), so it goes to every task. See ``groups`` for nulls, empty tables and repeated rows.
    """
    spark = docs.sparkSession
    aligned = materialize(groups(docs, path_a, path_b, id_column, text_column), "aligned")
    found = pair_counts(aligned).select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("code"), "links", "best").toArrow()
    codes, links, best = (found.column(k).to_numpy(zero_copy_only=False) for k in range(3))
    order = np.argsort(codes)
    shared = spark.sparkContext.broadcast((codes[order], links[order], best[order]))
    kind = dict(docs.dtypes)[id_column]
    fields = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, links, best = shared.value
        for batch in batches:
            a, b, n = (batch.column(k) for k in range(6, 9))
            sizes = np.diff(a.offsets.to_numpy())
            flat_n = n.flatten().to_numpy()
            at = np.searchsorted(codes, a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy())
            row = np.repeat(np.arange(len(sizes)), sizes)
            sums = []
            for weight in (flat_n * best[at], flat_n * links[at]):
                out = np.zeros(len(sizes), np.int64)
                np.add.at(out, row, weight)
                sums.append(pa.array(out))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(batch.column(k) for k in range(1, 5)), *sums, batch.column(5)], [x.split()[0] for x in fields.split(", ")])

    names = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n"]
    return aligned.toDF(*names).mapInArrow(weigh, fields).withColumnRenamed("key", id_column)
