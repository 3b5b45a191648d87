"""Books cut into chunks of whole paragraphs, and chunks with their neighbours as context.

A book's paragraphs go once, in order, through three small machines that know lengths and marks only and give ranges:
sections end at breaks and before headings; a section too large is grouped by size, a heading held back for what follows
it; units are packed, and a chunk takes the last ones of its predecessor along, as far as the overlap allows. A row is one
book, so there is no shuffle, and memory grows with the row's own text. Tokens are a third of the characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskb.functions.text import is_scene_break, looks_like_heading, strip_text
from corpuskb.operators.chunks import SECTION_BREAK

Range = tuple[int, int]
#: Rows of one batch that a task gives.
_FLUSH = 256


def tokens(characters: int) -> int:
    return max(1, characters // 3)


def _joined(lengths: list[int], a: int, b: int) -> int:
    """Tokens of paragraphs a to b with blank lines between them."""
    return tokens(sum(lengths[a:b]) + 2 * (b - a - 1))


def section_ranges(heads: list[bool], broken: list[bool]) -> Iterator[Range]:
    """Stretches of paragraphs without breaks; a heading begins one."""
    start = 0
    for i, (head, ends) in enumerate(zip(heads, broken, strict=True)):
        if (ends or head) and i > start:
            yield start, i
        if ends or head:
            start = i + ends
    if start < len(heads):
        yield start, len(heads)


def unit_ranges(lengths: list[int], heads: list[bool], section: Range, limit: int) -> Iterator[Range]:
    """A section whole if it fits or is one paragraph; else its paragraphs by size, those too large alone or with a heading before them."""
    start, end = section
    if end - start == 1 or _joined(lengths, start, end) <= limit:
        yield section
        return
    held = 0
    for i in range(start, end):
        size = tokens(lengths[i])
        after_heading = i == start + 1 and heads[start]
        if i > start and not after_heading and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
        if size > limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < end:
        yield start, end


def chunk_ranges(sizes: list[int], limit: int, overlap: int) -> Iterator[Range]:
    """Ranges of units: packed up to ``limit``, those too large alone; each after a full one begins with what ``overlap`` holds of its end."""
    start = held = 0
    for k, size in enumerate(sizes):
        if k > start and held + size > limit:
            yield start, k
            first, start, held = start, k, 0
            while size <= limit and start > first and held + sizes[start - 1] <= overlap:
                start -= 1
                held += sizes[start]
        held += size
        if size > limit:
            yield k, k + 1
            start, held = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def split(paragraphs: list[str], heads: list[bool], broken: list[bool], limit: int, overlap: int) -> list[tuple[str, int, int]]:
    """A book's chunks with their first and last paragraph."""
    lengths = list(map(len, paragraphs))
    units = [u for s in section_ranges(heads, broken) for u in unit_ranges(lengths, heads, s, limit)]
    sizes = [_joined(lengths, a, b) for a, b in units]
    return [("\n\n".join("\n\n".join(paragraphs[a:b]) for a, b in units[k:m]), units[k][0], units[m - 1][1] - 1) for k, m in chunk_ranges(sizes, limit, overlap)]


def excerpt(paragraphs: list[str], limit: int, from_end: bool) -> str:
    """The paragraphs at a chunk's end, or beginning, that fit the limit; the first one in any case."""
    taken = used = 0
    for p in reversed(paragraphs) if from_end else paragraphs:
        if taken and used + tokens(len(p)) > limit:
            break
        taken += 1
        used += tokens(len(p))
        if used >= limit:
            break
    return "\n\n".join(paragraphs[len(paragraphs) - taken :] if from_end else paragraphs[:taken])


def payload(chunks: list[str], at: int, budget: int, neighbours: int, excerpt_tokens: int) -> tuple[str, int, int]:
    """A chunk marked as the primary one, with what the budget leaves of its neighbours, nearest first, one before and one behind;
    the number of these and their tokens."""
    left, blocks, used = max(budget - tokens(len(chunks[at])), 0), [], 0
    for k in [at + side * d for d in range(1, neighbours + 1) for side in (-1, 1)]:
        if left <= 0 or not 0 <= k < len(chunks):
            continue
        text, how = chunks[k], "full"
        if tokens(len(text)) > left:
            text, how = excerpt(text.split("\n\n"), min(excerpt_tokens, left), k < at), "excerpt"
        blocks.append(f"[SUPPORTING {'PREV' if k < at else 'NEXT'} CHUNK #{k + 1} | {how}]\n{text}")
        used += tokens(len(text))
        left = max(left - tokens(len(text)), 0)
    support = ["[SUPPORTING CONTEXT]\n" + "\n\n".join(blocks)] if blocks else []
    return "\n\n".join([f"[PRIMARY CHUNK #{at + 1}]\n{chunks[at]}", *support]), len(blocks), used


def chunked(docs: DataFrame, limit: int = 2500, overlap: int = 150, context: tuple[int, int, int] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, idx, chunk, n_tokens, first, last) of every text's chunks, in order; first and last number its paragraphs.

    With ``context``, a budget of tokens, a number of neighbours on each side and the tokens of an excerpt, also
    ``payload``, ``support_chunks`` and ``support_tokens``. Null and empty texts, and those of breaks only, have no
    chunks. Rows are independent: repeated rows give repeated chunks, an empty table none; other columns are ignored.
    """
    if limit < 1 or overlap < 0:
        raise ValueError("chunks need a positive limit and an overlap of nothing or more")
    kind = dict(docs.dtypes)[id_column]
    fields = f"key {kind}, idx int, chunk string, n_tokens long, first int, last int" + ", payload string, support_chunks int, support_tokens long" * bool(context)
    names = ["key", "idx", "chunk", "n_tokens", "first", "last"] + ["payload", "support_chunks", "support_tokens"] * bool(context)
    types = [pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int32()] + [pa.string(), pa.int32(), pa.int64()] * bool(context)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []

            def flush(batch=batch):
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)]
                return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int64())), *columns], names)

            for row in range(batch.num_rows):
                found = split(*(batch.column(k)[row].as_py() for k in (1, 2, 3)), limit, overlap)
                texts = [text for text, *_ in found]
                for idx, (text, first, last) in enumerate(found):
                    keys.append(row)
                    rows.append((idx, text, tokens(len(text)), first, last, *(payload(texts, idx, *context) if context else ())))
                    if len(rows) >= _FLUSH:
                        yield flush()
                        keys, rows = [], []
            if rows:
                yield flush()

    parts = F.filter(F.transform(F.split(F.coalesce(F.col(text_column), F.lit("")), r"(?U)\n\s*\n+"), strip_text), lambda p: p != "")
    marked = docs.select(F.col(id_column).alias("key"), parts.alias("parts"))
    broken = F.transform("parts", lambda p: (p == SECTION_BREAK) | is_scene_break(p))
    return marked.select("key", "parts", F.transform("parts", looks_like_heading).alias("heads"), broken.alias("broken")).mapInArrow(run, fields).withColumnRenamed("key", id_column)
