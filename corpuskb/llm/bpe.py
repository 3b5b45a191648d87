"""Byte-level BPE as a bounded-lookahead streaming transducer, and an incremental decoder.

A merge rule joins the symbols left and right of its *split*. Whether a rule fires at a split can
depend on text to the right only while its right symbol, or a symbol on that one's right edge, can be
taken first by an earlier rule; that rule again depends on what lies behind *its* right symbol, and so
on along rules of ever earlier rank. The longest such chain, in bytes, is the merge list's sufficient
lookahead: a split with that many bytes behind it is settled, whatever follows. The transducer so keeps
one window of text, emits the tokens whose ends are settled and slides on; tokens already emitted never
change, as no merge crossed their ends.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters with Unicode's White_Space property.
WHITE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Fixed value: the public pattern that splits text before byte-level merges.
PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
#: Coarser units that the pattern above never crosses: a word with one space before it, or white space.
UNITS = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 is itself, the rest follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


_NEVER = 1 << 62


class Tokenizer:
    """Ids of whole texts by a byte-level BPE vocabulary file; memory does not grow with the text."""

    #: Entries kept in each memo of units before it starts anew.
    MEMO = 800_000
    #: Pieces over this many bytes go through the sliding window.
    WINDOW = 1 << 12

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.token_bytes: list[bytes] = [b""] * self.size
        for text, i in vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in text)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.specials.items():
            self.token_bytes[i] = text.encode()
        self.of_byte = [vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
        #: rank << 24 | made, by left * size + right
        self.merges: dict[int, int] = {}
        rules = []
        for rank, rule in enumerate(spec["model"]["merges"]):
            a, b = rule.split(" ") if isinstance(rule, str) else rule
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.merges.setdefault(left * self.size + right, rank << 24 | made)
            rules.append((left, right, made))
        #: Whether ids stand in the order of the merges, behind those of single bytes.
        self.ranked = sorted(self.of_byte) == list(range(256)) and [made for _, _, made in rules] == list(range(256, 256 + len(rules)))
        self.lookahead = sufficient_lookahead(rules, self.token_bytes)
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self._units = _Memo(self._unit, self.MEMO)
        self._pieces = _Memo(lambda piece: b"".join([self._id_bytes[i] for i in self.merge(piece.encode())]), self.MEMO // 4)
        self._id_bytes = [i.to_bytes(4, "little") for i in range(self.size)]

    def _unit(self, unit: str) -> bytes:
        if len(unit) > self.WINDOW:
            return b"".join(b"".join(self._emit(m.group().encode())) for m in PIECES.finditer(unit))
        pieces = PIECES.findall(unit)
        if len(pieces) == 1:
            return b"".join([self._id_bytes[i] for i in self.merge(unit.encode())])
        return b"".join([self._pieces[p] for p in pieces])

    def _emit(self, piece: bytes) -> Iterator[bytes]:
        """Little-endian ids of one piece, as soon as they are settled."""
        if len(piece) <= self.WINDOW:
            yield np.array(self.merge(piece), "<u4").tobytes()
            return
        view, start, keep = memoryview(piece), 0, max(self.WINDOW, 4 * self.lookahead)
        while start < len(piece):
            window = bytes(view[start : start + keep])
            ids, settled = self.merge(window), len(window) - self.lookahead
            if start + keep >= len(piece):
                settled = len(window)
            out, at = [], 0
            for i in ids:
                if at + len(self.token_bytes[i]) > settled:
                    break
                at += len(self.token_bytes[i])
                out.append(i)
            yield np.array(out, "<u4").tobytes()
            start += at

    def merge(self, piece: bytes) -> list[int]:
        """The ids of a piece: always the earliest rule, and the leftmost of its places."""
        ids = [self.of_byte[b] for b in piece]
        get, size = self.merges.get, self.size
        if len(ids) > 64:
            return self._merge_long(ids)
        found = [get(a * size + b, _NEVER) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) < _NEVER:
            at = found.index(best)
            ids[at : at + 2] = [best & 0xFFFFFF]
            del found[at]
            if at:
                found[at - 1] = get(ids[at - 1] * size + ids[at], _NEVER)
            if at < len(found):
                found[at] = get(ids[at] * size + ids[at + 1], _NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        get, size, n = self.merges.get, self.size, len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(found, k, ids[k], ids[k + 1]) for k in range(n - 1) if (found := get(ids[k] * size + ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            found, k, left, right = heapq.heappop(heap)
            nxt = after[k]
            if ids[k] != left or nxt < 0 or ids[nxt] != right:
                continue
            ids[k], ids[nxt] = found & 0xFFFFFF, -1
            after[k] = after[nxt]
            if after[k] >= 0:
                before[after[k]] = k
            for a in (before[k], k):
                if a >= 0 and after[a] >= 0 and (found := get(ids[a] * size + ids[after[a]])) is not None:
                    heapq.heappush(heap, (found, a, ids[a], ids[after[a]]))
        return [i for i in ids if i >= 0]

    def split_specials(self, text: str) -> list[str]:
        """Ordinary parts of a text, and between them its special strings."""
        return self._split.split(text) if self._split and any(s in text for s in self.specials) else [text]

    def encode(self, text: str) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of a text, block by block; special strings are their own ids."""
        parts = self.split_specials(text)
        for k, part in enumerate(parts):
            if k % 2:
                yield np.array([self.specials[part]], "<u4").tobytes()
                continue
            start = 0
            while start < len(part):
                stop = start + (1 << 17)
                if stop < len(part):
                    while stop < len(part) and not (part[stop] == " " and part[stop - 1] not in _white_set):
                        stop += 1
                yield b"".join(map(self._units.__getitem__, UNITS.findall(part, start, stop) if stop >= len(part) else UNITS.findall(part[start:stop])))
                start = stop

    def decode(self, blocks: Iterator[bytes]) -> Iterator[str]:
        """Text of id blocks: the state carried between blocks is the bytes of an unfinished character."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        table = self.token_bytes
        for block in blocks:
            yield state.decode(b"".join([table[i] for i in np.frombuffer(block, "<u4").tolist()]))
        yield state.decode(b"", True)


_white_set = frozenset(WHITE)


class _Memo(dict):
    """Remembers results up to a number of entries, then starts anew."""

    def __init__(self, make, limit: int):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, key: str) -> bytes:
        out = self._make(key)
        if len(key) <= 64:
            if len(self) >= self._limit:
                self.clear()
            self[key] = out
        return out


def sufficient_lookahead(rules: list[tuple[int, int, int]], token_bytes: list[bytes]) -> int:
    """Bytes behind a split after which no later text changes whether a rule fires there."""
    right_child = {made: right for _, right, made in reversed(rules)}
    reach_of_left: dict[int, int] = {}
    most = 0
    for left, right, _ in rules:
        beyond, edge = 0, right
        while edge is not None:
            beyond = max(beyond, reach_of_left.get(edge, 0))
            edge = right_child.get(edge)
        reach = len(token_bytes[right]) + beyond
        reach_of_left[left] = max(reach_of_left.get(left, 0), reach)
        most = max(most, reach)
    return most


_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, read once in each Python process."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", keep_output: bool = False) -> DataFrame:
    """Token count and digests of ids and decoded text for every row; with ``keep_output`` also ids and text.

    Null text counts as empty: no tokens, the digests of nothing. Rows are independent, so repeated rows
    give repeated results, an empty table an empty one, and other columns are ignored. There is no shuffle.
    """
    schema = "key string, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * keep_output

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            out: list[list] = [[], [], []]
            kept: list[list] = [[], []]
            for text in batch.column(1):
                ids, spelled, n, whole = hashlib.sha256(), hashlib.sha256(), 0, []

                def counted(text=text, ids=ids, whole=whole) -> Iterator[bytes]:
                    nonlocal n
                    for block in t.encode(text.as_py() or ""):
                        ids.update(block)
                        n += len(block) // 4
                        if keep_output:
                            whole.append(block)
                        yield block

                pieces = []
                for piece in t.decode(counted()):
                    spelled.update(piece.encode())
                    if keep_output:
                        pieces.append(piece)
                for column, value in zip(out, (n, ids.hexdigest(), spelled.hexdigest()), strict=True):
                    column.append(value)
                if keep_output:
                    kept[0].append(b"".join(whole))
                    kept[1].append("".join(pieces))
            columns = [batch.column(0), pa.array(out[0], pa.int64()), *(pa.array(x, pa.string()) for x in out[1:])]
            if keep_output:
                columns += [pa.array(kept[0], pa.binary()), pa.array(kept[1], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    kind = dict(docs.dtypes)[id_column]
    chosen = docs.select(F.col(id_column).alias("key"), F.col(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(run, schema.replace("key string", f"key {kind}")).withColumnRenamed("key", id_column)
