"""Removal of repeated byte strings: suffixes that start near equal anchors are sorted, neighbours in order compared.

1. Every document is cut into anchors, each with the windows of ``LENGTH`` bytes that it owns (see ``anchors``).
   Equal windows have equal anchors at equal places, so only anchors with equal hashes need to meet.
2. Anchors meet by hash. Those whose whole strips (the bytes of all their windows) are equal are repeats at once;
   hashes with several different strips are open.
3. Strips of open anchors are fetched from their documents. Deep-shallow sorting orders the suffixes that start
   at an anchor; the suffixes that start one byte further left follow from that order by a stable sort on that
   byte, and so on through all windows. A window is a repeat if it agrees with a neighbour in full length.
4. Spans of repeats come back to the documents.

A hash that a large part of the anchors share is dealt out by ever narrower ranges of windows, whose common
bytes are part of the key, until no key is hot; strips that are equal throughout are settled by counting.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from corpuskb.llm import anchors, words
from corpuskb.llm.store import materialize
from corpuskb.llm.suffix import deep_shallow_sort

LENGTH = 200
#: Offsets of a window's start before its anchor: 0 to WIDTH.
WIDTH = LENGTH - anchors.GRAM
#: Strips that one key may bring into one place, some 7 MB; the bound is fixed, whatever the corpus.
PART = 20_000
#: Hot keys that come to the driver; more of them are met by a join.
HOT_KEYS = 500_000
#: Rows that a task remembers, so as not to send equal ones again.
SEEN = 200_000
#: Bytes of texts whose anchors are looked for at a time.
BLOCK = 1 << 19
_SPAN = (1 << 32) - 1


def _row_ids(key: Column, text: Column) -> list[Column]:
    """Two independent hashes name a row; rows equal in both are repeats of each other anyway."""
    return [F.xxhash64(key, text).alias("r1"), F.xxhash64(F.lit("row"), text, key).alias("r2")]


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of spans that overlap or touch."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(start)) - 1]


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors as (h, c, r1, r2, at), c the hash of the strip; strips that are equal within a block are settled here.

    ``at`` of an anchor is place << 17 | whether other copies are known << 16 | most << 8 | least offset of its
    windows' starts before it. Settled spans have a null h, and at is start << 32 | end.
    """
    for batch in batches:
        raw, offsets = words.column_bytes(batch.column(2))
        ids = [np.asarray(batch.column(k)) for k in (0, 1)]
        for x, y in words.blocks(offsets, BLOCK):
            piece, off = raw[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x]
            h, place, a, b = anchors.find(piece, off, LENGTH)
            if not len(h):
                continue
            c = words.span_hashes(piece, a, b - 1 + LENGTH)
            row = np.searchsorted(off, place, "right") - 1
            base = off[row]
            order = np.lexsort((place, c, h))
            new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])])
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(h)))
            lead = order[first]
            at = ((place - base)[lead] << 17) | ((n > 1).astype(np.int64) << 16) | ((place - a)[lead] << 8) | (place - b + 1)[lead]
            signed = lambda v: v.view(np.int64)
            columns = [signed(h[lead]), signed(c[lead]), ids[0][x:y][row[lead]], ids[1][x:y][row[lead]], at]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], ["h", "c", "r1", "r2", "at"])
            several = order[np.repeat(n > 1, n)]
            if len(several):
                start, end = _merged_in_rows(a[several], b[several] - 1 + LENGTH, off)
                row = np.searchsorted(off, start, "right") - 1
                m = len(start)
                yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(ids[0][x:y][row]), pa.array(ids[1][x:y][row]), pa.array((start - off[row]) << 32 | (end - off[row]))], ["h", "c", "r1", "r2", "at"])


def _merged_in_rows(start: np.ndarray, end: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_merged``, but spans of different rows stay apart though they touch."""
    row = np.searchsorted(offsets, start, "right") - 1
    start, end = _merged(start + row, end + row)
    row = np.searchsorted(offsets + np.arange(len(offsets)), start, "right") - 1
    return start - row, end - row


def heavy(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(k, v): values v of the k-th column that may have over PART rows; all that have are among them.

    Tasks report what they see often. A value of over PART rows is missed in all tasks together at most PART / 2
    times, so those reported over PART / 2 times hold it.
    """
    least = max(1, PART // (2 * max(1, rows.rdd.getNumPartitions())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list] = [[] for _ in columns]
        for batch in batches:
            for part, column in zip(parts, batch.columns, strict=True):
                part.append(np.asarray(column))
        for k, part in enumerate(parts):
            value, count = np.unique(np.concatenate(part), return_counts=True) if part else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            often = count >= least
            yield pa.RecordBatch.from_arrays([pa.array(np.full(often.sum(), k)), pa.array(value[often]), pa.array(count[often])], ["k", "v", "n"])

    found = rows.select(*columns).mapInArrow(run, "k long, v long, n long").groupBy("k", "v").agg(F.sum("n").alias("n")).where(F.col("n") > PART // 2)
    return materialize(found.select("k", "v"), "heavy")


def _flagged(rows: DataFrame, hot: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with a flag hot_<column> for each of the columns: whether its value is hot."""
    n = hot.count()
    if not n:
        return rows.select("*", *(F.lit(False).alias(f"hot_{c}") for c in columns))
    if n > HOT_KEYS:
        for k, c in enumerate(columns):
            named = hot.where(F.col("k") == k).select(F.col("v").alias(c), F.lit(True).alias(f"hot_{c}"))
            rows = rows.join(named, c, "left").withColumn(f"hot_{c}", F.coalesce(f"hot_{c}", F.lit(False)))
        return rows
    found = hot.collect()
    shared = rows.sparkSession.sparkContext.broadcast({c: np.array([r["v"] for r in found if r["k"] == k], np.int64) for k, c in enumerate(columns)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = [pa.array(np.isin(np.asarray(batch.column(batch.schema.get_field_index(c))), shared.value[c])) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], [*batch.schema.names, *(f"hot_{c}" for c in columns)])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *(StructField(f"hot_{c}", BooleanType()) for c in columns)]))


def _by_group(solve, column: str = "h"):
    """Apply ``solve`` to whole groups of a partition sorted by ``column``, many groups at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < 20_000:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column(column).to_numpy()
            # the last group may go on in the next batch
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from solve(table.slice(0, cut).combine_chunks())
                held = table.slice(cut).combine_chunks().to_batches()
                n = sum(x.num_rows for x in held)
        if n:
            yield from solve(pa.Table.from_batches(held).combine_chunks())

    return run


def _met(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Settled spans (null h) and requests for open strips from anchors sorted by hash and strip."""
    h, c, r1, r2, at = (table.column(k).to_numpy() for k in ("h", "c", "r1", "r2", "at"))
    new_h = np.concatenate([[True], h[1:] != h[:-1]])
    new_c = new_h | np.concatenate([[True], c[1:] != c[:-1]])
    first_h, first_c = np.flatnonzero(new_h), np.flatnonzero(new_c)
    strips = np.add.reduceat(new_c.astype(np.int64), first_h)
    open_ = (strips > 1)[np.cumsum(new_h) - 1]
    n = np.diff(np.append(first_c, len(h)))
    many = (n > 1) | (np.maximum.reduceat(at >> 16 & 1, first_c) > 0)
    settled = np.repeat(many, n)
    lead = first_c[open_[first_c]]
    ask = (at | settled.astype(np.int64) << 16)[lead]
    place, most, least = at >> 17, at >> 8 & 255, at & 255
    span = np.flatnonzero(settled & np.repeat(n > 1, n))
    spans = (place - most)[span] << 32 | (place - least)[span] + LENGTH
    yield pa.RecordBatch.from_arrays([pa.array(h[lead]), pa.array(r1[lead]), pa.array(r2[lead]), pa.array(ask)], ["h", "r1", "r2", "at"])
    yield pa.RecordBatch.from_arrays([pa.nulls(len(span), pa.int64()), pa.array(r1[span]), pa.array(r2[span]), pa.array(spans)], ["h", "r1", "r2", "at"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, for the way to other executors; rows that are equal to one just seen add nothing."""
    pack, seen = zstandard.ZstdCompressor(1), set()
    for batch in batches:
        names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        new = []
        for k, name in enumerate(names):
            if name not in seen:
                new.append(k)
                if len(seen) < SEEN:
                    seen.add(name)
        if len(new) < len(names):
            batch = batch.take(pa.array(new, pa.int64()))
        texts = batch.column(2).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([pack.compress(t.as_buffer()) for t in texts], pa.binary())], ["r1", "r2", "blob"])


def _strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each request's windows."""
    unpack = zstandard.ZstdDecompressor()
    names = ["h", "r1", "r2", "at", "strip"]
    for batch in batches:
        r1, r2 = (np.asarray(batch.column(k)) for k in (0, 1))
        hs, ats = (np.asarray(batch.column(k).flatten()) for k in (3, 4))
        n = np.diff(np.asarray(batch.column(3).offsets))
        row, strips, begun = np.repeat(np.arange(len(n)), n), [], 0
        place, most, least = (ats >> 17).tolist(), (ats >> 8 & 255).tolist(), (ats & 255).tolist()
        for k, stop in enumerate(np.cumsum(n).tolist()):
            text = unpack.decompress(batch.column(2)[k].as_buffer())
            strips += [text[place[j] - most[j] : place[j] - least[j] + LENGTH] for j in range(begun, stop)]
            begun = stop
        for a in range(0, len(row), 10_000):
            part = slice(a, a + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(hs[part]), pa.array(r1[row[part]]), pa.array(r2[row[part]]), pa.array(ats[part]), pa.array(strips[part], pa.binary())], names)


def _sorted_groups(strips: list[bytes], low: np.ndarray, most: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that start at offset ``low``, group by group, and each one's common prefix with the one before it."""
    order, common = [], []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        o, p = deep_shallow_sort([strips[k][int(most[k] - low[k]) :] for k in range(a, b)])
        order += [a + k for k in o]
        common += p
    return np.array(order, np.int64), np.array(common, np.int64)


def repeated(strips: list[bytes], group: np.ndarray, low: np.ndarray, most: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(strips, WIDTH + 1) flags: whether the window that starts so many bytes before the anchor agrees with another strip's.

    A strip starts ``most`` bytes before its anchor; ``low`` and ``high`` bound the offsets of its group's windows.
    Groups are contiguous and strips of a group that are equal throughout are each other's repeats.
    """
    out = np.zeros((len(strips), WIDTH + 1), bool)
    edges = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]])
    order, common = _sorted_groups(strips, low, most, edges)
    raw = np.frombuffer(b"".join(strips), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in strips])])[:-1]
    kind = group[order]
    for step in range(WIDTH + 1):
        if len(order) < 2:
            break
        offset = low[order] + step
        if step:
            # one byte further left: a stable sort by that byte keeps the order of what follows it
            byte = np.where(offset <= most[order], raw[begin[order] + np.maximum(most[order] - offset, 0)].astype(np.int64), -1)
            sure = byte >= 0
            level = np.concatenate([[0], np.cumsum(kind[1:] != kind[:-1])])
            moved = np.lexsort((byte, level))
            moved = moved[sure[moved]]
            kind_then, byte_then = level[moved], byte[moved]
            same = np.concatenate([[False], (kind_then[1:] == kind_then[:-1]) & (byte_then[1:] == byte_then[:-1])])
            before = np.concatenate([[0], moved[:-1]])
            common = np.where(same, _least(common, before + 1, moved, same), 0)
            order, kind = order[moved], np.cumsum(~same)
            offset = low[order] + step
        joined = np.concatenate([kind[1:] == kind[:-1], [False]])
        after = np.append(common[1:], 0) * joined
        own = common * np.concatenate([[False], joined[:-1]])
        longest = np.maximum(own, after)
        hit = (longest + step >= LENGTH) & (offset <= high[order])
        out[order[hit], offset[hit]] = True
        # what agrees with no neighbour by the least that any window further left needs, stays without repeats
        alive = longest + (high - low)[order] >= LENGTH
        if not alive.all():
            order, kind, common = _drop(order, kind, common, alive)
    return out


def _least(common: np.ndarray, a: np.ndarray, b: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Least of common[a..b] where wanted, by doubling."""
    out = np.zeros(len(a), np.int64)
    at = np.flatnonzero(wanted)
    if not len(at):
        return out
    a, length = a[at], b[at] - a[at] + 1
    table, span = common, 1
    power = 1 << (np.frexp(length.astype(np.float64))[1] - 1).astype(np.int64)
    while True:
        now = power == span
        out[at[now]] = np.minimum(table[a[now]], table[a[now] + length[now] - span])
        if span * 2 > power.max():
            return out
        table = np.minimum(table[: len(table) - span], table[span:])
        span *= 2


def _drop(order: np.ndarray, kind: np.ndarray, common: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kept = np.flatnonzero(alive)
    if not len(kept):
        return order[:0], kind[:0], common[:0]
    same = np.concatenate([[False], kind[kept][1:] == kind[kept][:-1]])
    before = np.concatenate([[0], kept[:-1]])
    return order[kept], kind[kept], np.where(same, _least(common, before + 1, kept, same), 0)


def _solved(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Spans of repeats from strips sorted by their group."""
    key, r1, r2, at, low, high = (table.column(k).to_numpy() for k in ("key", "r1", "r2", "at", "low", "high"))
    strips = table.column("strip").combine_chunks().to_pylist()
    alone = np.ones(len(key), bool)
    alone[1:] &= key[1:] != key[:-1]
    alone[:-1] &= key[1:] != key[:-1]
    keep = np.flatnonzero(~alone)
    if not len(keep):
        return
    place, most = at >> 17, at >> 8 & 255
    found = repeated([strips[k] for k in keep], key[keep], low[keep], most[keep], np.minimum(high, most)[keep])
    # strips with copies elsewhere are settled already; a run of offsets is one span
    known = (at >> 16 & 1)[keep] > 0
    found[known] = False
    edge = np.diff(found.astype(np.int8), axis=1, prepend=0, append=0)
    row, first = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    k = keep[row]
    yield pa.RecordBatch.from_arrays([pa.array(r1[k]), pa.array(r2[k]), pa.array((place[k] - stop + 1) << 32 | place[k] - first + LENGTH)], ["r1", "r2", "at"])


def _narrowed(low: Column, high: Column) -> Column:
    """The part of a strip row that holds the windows of offsets low to high, as a struct; null if there are none."""
    most, least = F.shiftright("at", 8).bitwiseAND(F.lit(255)), F.col("at").bitwiseAND(F.lit(255))
    top, bottom = F.least(most, high), F.greatest(least, low)
    strip = F.substring(F.col("strip"), (most - top + 1).cast("int"), (top - bottom + LENGTH).cast("int"))
    at = F.shiftleft(F.shiftright("at", 16), 16).bitwiseOR(F.shiftleft(top, 8)).bitwiseOR(bottom)
    return F.when(top >= bottom, F.struct(at.alias("at"), strip.alias("strip"), low.alias("low"), high.alias("high")))


def _dealt(rows: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Rows with the key under which they are to be sorted, and spans that counting has settled; halves ranges up to eight times."""
    ready, settled, more = [], [], True
    while more:
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("long")
        halves = F.array(_narrowed(F.col("low"), middle), _narrowed(middle + 1, F.col("high")))
        split = rows.select("h", "r1", "r2", F.explode(F.filter(halves, lambda x: x.isNotNull())).alias("x")).select("h", "r1", "r2", "x.*")
        # bytes that all windows of the range share, whatever part of the range a strip has
        shared = F.expr(f"substring(strip, cast((shiftright(at, 8) & 255) - low + 1 as int), cast({LENGTH} - (high - low) as int))")
        split = split.withColumn("key", F.xxhash64("h", "low", "high", shared)).withColumn("whole", F.xxhash64("key", F.col("at").bitwiseAND(F.lit(0xFFFF)), "strip"))
        split = materialize(split, "split")
        hot = heavy(split, ["key", "whole"])
        # three readers: the flags are computed once
        split = _flagged(split, hot, ["key", "whole"]) if hot.isEmpty() else materialize(_flagged(split, hot, ["key", "whole"]), "flagged")
        split = split.withColumn("same", F.expr("hot_whole or hot_key and low = high"))
        settled.append(split.where("same").select("r1", "r2", F.expr(f"shiftleft(shiftright(at, 17) - (shiftright(at, 8) & 255), 32) | (shiftright(at, 17) - (at & 255) + {LENGTH})").alias("at")))
        ready.append(split.where("not hot_key and not same").select("key", "r1", "r2", "at", "low", "high", "strip"))
        # one of each settled strip goes on, marked as settled, for others to be compared with
        columns = ["h", "r1", "r2", "at", "low", "high", "strip"]
        one = split.where("same and low < high").groupBy("whole").agg(F.first(F.struct(*columns)).alias("x")).select("x.*")
        rows = split.where("hot_key and not same").select(*columns).unionByName(one.withColumn("at", F.col("at").bitwiseOR(F.lit(1 << 16))))
        more = not hot.where("k = 0").isEmpty()
    return ready, settled


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Spans of repeats as (r1, r2, at): a row's two hashes, and start << 32 | end in bytes; spans may overlap."""
    key, text = F.col(id_column), F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    texts = docs.select(*_row_ids(key, text), text.alias("text")).where(F.octet_length("text") >= LENGTH)
    stored = materialize(texts.mapInArrow(_anchored, "h long, c long, r1 long, r2 long, at long"), "anchors")
    hot = heavy(stored.where("h is not null"), ["h"])
    marked = _flagged(stored.where("h is not null"), hot, ["h"])
    rest = marked.where("not hot_h").select("h", "c", "r1", "r2", "at").repartition("h").sortWithinPartitions("h", "c")
    met = materialize(rest.mapInArrow(_by_group(_met), "h long, r1 long, r2 long, at long"), "met")
    spans = [stored.where("h is null").select("r1", "r2", "at"), met.where("h is null").select("r1", "r2", "at")]
    asked = met.where("h is not null")
    any_hot = not hot.isEmpty()
    if any_hot:
        # equal rows ask once, with the mark that there are others
        every = marked.where("hot_h").groupBy("h", "r1", "r2", "at").agg(F.count("*").alias("n"))
        asked = asked.unionByName(every.select("h", "r1", "r2", F.when(F.col("n") > 1, F.col("at").bitwiseOR(F.lit(1 << 16))).otherwise(F.col("at")).alias("at")))
        spans.append(every.where("n > 1").select("r1", "r2", F.expr(f"shiftleft(shiftright(at, 17) - (shiftright(at, 8) & 255), 32) | (shiftright(at, 17) - (at & 255) + {LENGTH})").alias("at")))
    grouped = asked.groupBy("r1", "r2").agg(F.collect_list(F.struct("h", "at")).alias("x")).select("r1", "r2", F.col("x.h").alias("hs"), F.col("x.at").alias("ats"))
    packed = texts.mapInArrow(_packed, "r1 long, r2 long, blob binary")
    joined = packed.join(grouped.hint("shuffle_hash"), ["r1", "r2"]).select("r1", "r2", "blob", "hs", "ats")
    strips = materialize(joined.mapInArrow(_strips, "h long, r1 long, r2 long, at long, strip binary"), "strips")
    strips = _flagged(strips.select("*", F.lit(0).cast("long").alias("low"), F.lit(WIDTH).cast("long").alias("high")), hot, ["h"])
    ready = [strips.where("not hot_h").select(F.col("h").alias("key"), "r1", "r2", "at", "low", "high", "strip")]
    if any_hot:
        more, settled = _dealt(strips.where("hot_h").drop("hot_h"))
        ready += more
        spans += settled
    for rows in ready:
        rows = rows.repartition("key").sortWithinPartitions("key").select("key", "r1", "r2", "at", "low", "high", "strip")
        spans.append(rows.mapInArrow(_by_group(_solved, "key"), "r1 long, r2 long, at long"))
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def _cut(text: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the number of removed runs."""
    start, end = _merged(spans >> 32, spans & _SPAN)
    kept, at = [], 0
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), int((end - start).sum()), len(start)


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row with its bytes, the bytes and runs removed, and the digest of what is left.

    A byte is removed if a string of LENGTH bytes that covers it also starts anywhere else, in the same text or
    another. Null and empty texts, and those under LENGTH bytes, keep all they have. Repeated rows are copies of
    each other. An empty table gives no rows; other columns are ignored.
    """
    kind = dict(docs.dtypes)[id_column]
    key, text = F.col(id_column), F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    names = [id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for blob, spans in zip(batch.column(1), batch.column(2), strict=True):
                body = unpack.decompress(blob.as_buffer())
                kept, removed, runs = _cut(body, np.asarray(spans.values) if spans.is_valid else np.zeros(0, np.int64))
                rows.append((len(body), removed, runs, hashlib.sha256(kept).hexdigest()))
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)] if rows else [pa.nulls(0, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([pack.compress(t.as_buffer()) for t in batch.column(3).cast(pa.binary())], pa.binary())], ["r1", "r2", "key", "blob"])

    found = find(docs, id_column, text_column).distinct().groupBy("r1", "r2").agg(F.collect_list("at").alias("spans"))
    rows = docs.select(*_row_ids(key, text), key.alias("key"), text.alias("text")).mapInArrow(packed, f"r1 long, r2 long, key {kind}, blob binary")
    joined = rows.join(found.hint("shuffle_hash"), ["r1", "r2"], "left").select("key", "blob", "spans")
    return joined.mapInArrow(run, f"{id_column} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows with all their columns, repeats cut out of the text as in ``digests``.

    Characters of which a cut leaves only some bytes go as well. No row goes, though its text may become empty; null stays null.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = names.index(text_column)
            body = pa.RecordBatch.from_arrays(batch.columns[: len(names)], names)
            column, spans = body.column(k), batch.column(len(names))
            texts = [t if not s.is_valid or t is None else _cut(t.encode(), np.asarray(s.values))[0].decode(errors="ignore") for t, s in zip(column.to_pylist(), spans, strict=True)]
            yield body.set_column(k, body.schema.field(k), pa.array(texts, column.type))

    # columns go by number, so that none of the rows' own names can clash with these
    renamed = docs.toDF(*(f"c{k}" for k in range(len(names))))
    own = {name: f"c{k}" for k, name in enumerate(names)}
    key, text = F.col(own[id_column]), F.coalesce(F.col(own[text_column]).cast("string"), F.lit(""))
    found = find(docs, id_column, text_column).distinct().groupBy("r1", "r2").agg(F.collect_list("at").alias("spans"))
    joined = renamed.select("*", *_row_ids(key, text)).join(found.hint("shuffle_hash"), ["r1", "r2"], "left")
    return joined.select(*own.values(), "spans").mapInArrow(run, docs.schema)
