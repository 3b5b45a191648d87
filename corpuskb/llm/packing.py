"""Concatenate and cut: two-pass prefix sums over partition token totals, then fixed windows with boundary records."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskb.llm.bpe import UNITS, tokenizer
from corpuskb.llm.store import materialize

#: Rows of one output batch: bounds the memory of a task, whatever the length of a text.
_FLUSH = 4096


class _Units(dict):
    """Ids of units as bytes of a given width, remembered up to ``LIMIT`` units."""

    LIMIT = 700_000

    def __init__(self, encode, width: str):
        super().__init__()
        self._encode, self._width = encode, width

    def __missing__(self, unit: str) -> bytes:
        out = np.array(self._encode(unit), self._width).tobytes()
        if len(unit) <= 64:
            if len(self) >= self.LIMIT:
                self.clear()
            self[unit] = out
        return out


_encoders: dict = {}


def id_bytes(path: str, width: str):
    """A function from a text to its ids as bytes.

    Words and white space that no merge crosses are encoded once each by a compiled encoder that holds the
    same vocabulary as ranks; that needs ids in the order of the merges, else the library encodes whole texts.
    """
    if (path, width) in _encoders:
        return _encoders[path, width]
    t = tokenizer(path)
    plain = {token: i for i, token in enumerate(t.token_bytes) if i not in t.specials.values() and token}
    if t.ranked and len(plain) == t.size - len(t.specials):
        import public_tokenizers
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=plain, special_tokens={})
        units = _Units(encoding.encode_ordinary, width)

        def encode(text: str) -> bytes:
            if not any(s in text for s in t.specials):
                return b"".join(map(units.__getitem__, UNITS.findall(text)))
            parts = t.split_specials(text)
            return b"".join(np.array([t.specials[p]], width).tobytes() if k % 2 else b"".join(map(units.__getitem__, UNITS.findall(p))) for k, p in enumerate(parts))

    else:
        from tokenizers import Tokenizer as Library

        library = Library.from_file(path)
        library.no_truncation()
        library.no_padding()

        def encode(text: str) -> bytes:
            return np.array(library.encode(text, add_special_tokens=False).ids, width).tobytes()

    _encoders[path, width] = encode
    return encode


def tokenize(docs: DataFrame, path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """First pass: each document's ids with ``end_id`` behind them, its place in its partition and the tokens before it there."""
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, part, before = tokenizer(path), TaskContext.get().partitionId(), 0
        width = "<u2" if max(t.size, end_id + 1) <= 1 << 16 else "<u4"
        encode = id_bytes(path, width)
        tail = np.array([end_id], width).tobytes()
        for batch in batches:
            ids, counts, starts = [], [], []
            for text in batch.column(1):
                blob = encode(text.as_py() or "") + tail
                n = len(blob) // int(width[2])
                ids.append(blob)
                counts.append(n)
                starts.append(before)
                before += n
            columns = [batch.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array([int(width[2])] * len(ids), pa.int32()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "part", "before", "n", "width", "ids"])

    chosen = docs.select(F.col(id_column).alias("key"), F.col(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"key {kind}, part int, before long, n long, width int, ids binary")


def pack(docs: DataFrame, path: str, length: int = 2048, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """All documents' tokens as one stream cut into windows of ``length``; one row per piece of a document in a window.

    A piece has its document, ``start`` (its document's tokens before it), ``length``, the CRC of its ids,
    the document's token count, its ``sequence_id`` and ``offset`` there. Only the last window can be partly
    filled: ``padded_to`` is ``length``, or the filled size itself where that is a power of two.

    The ids are written once to the shared folder, so a lost task repeats against the same places. The
    driver sees one token total per partition; all else stays in tasks without any shuffle of ids.
    Null and empty texts give one piece, the end token. Repeated rows are packed as often as they come,
    in the order of the input's partitions. An empty table gives no rows; other columns are ignored.
    """
    kind = dict(docs.dtypes)[id_column]
    stored = materialize(tokenize(docs, path, end_id, id_column, text_column), "tokens")
    totals = sorted((r["part"], r["total"]) for r in stored.groupBy("part").agg(F.sum("n").alias("total")).collect())
    base, tokens = {}, 0
    for part, total in totals:
        base[part] = tokens
        tokens += total
    last, rest = tokens // length, tokens % length
    last_padded = rest if rest & (rest - 1) == 0 else length
    fields = f"{id_column} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_to long" + ", ids binary" * keep_ids
    names = [x.split()[0] for x in fields.split(", ")]
    types = [pa.int64()] * 7 + [pa.binary()] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []

            def flush(batch=batch):
                nonlocal keys, rows
                columns = [batch.column(0).take(pa.array(keys, pa.int64())), *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True))]
                keys, rows = [], []
                return pa.RecordBatch.from_arrays(columns, names)

            part, before, n, width = (batch.column(k).to_numpy() for k in range(1, 5))
            for k in range(len(n)):
                at, start, ids = base[part[k]] + int(before[k]), 0, batch.column(5)[k].as_py()
                while start < n[k]:
                    sequence, offset = divmod(at + start, length)
                    size = min(length - offset, int(n[k]) - start)
                    blob = np.frombuffer(ids, f"<u{width[k]}", size, start * int(width[k])).astype("<u4").tobytes()
                    keys.append(k)
                    rows.append((start, size, zlib.crc32(blob), int(n[k]), sequence, offset, last_padded if sequence == last else length, *[blob] * keep_ids))
                    start += size
                    if len(rows) >= _FLUSH:
                        yield flush()
            if rows:
                yield flush()

    return stored.select("key", "part", "before", "n", "width", "ids").mapInArrow(cut, fields)
