"""Near-duplicate classes by DartMinHash signatures and banded joins.

An element is a five-word shingle with the number of its earlier occurrences in the text, so a shingle that
occurs m times is a region of weight m. Every element throws hashed darts at an even rate along the rank
axis (gaps are exponential); a dart falls on one of the signature's coordinates, and each coordinate keeps
its earliest dart. Only ranks below about k ln k over the text's weight are thrown, so a long text throws
no more darts than a short one. Two texts' coordinates agree with their weighted Jaccard similarity.

Equal word sequences are one node. Nodes that agree in all rows of a band meet in a bucket. There a part of their
signatures is compared, and a spanning forest of all that look alike comes out, so no bucket gives more rows than it has
nodes. The forests' components are clouds: whoever might be alike is in one cloud. Each node's shingles go to its cloud
once, where all pairs are compared exactly. Large buckets and clouds are dealt into parts: first the nodes of a part meet,
then those outside the largest group so found meet all others, in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskb.llm import words
from corpuskb.llm.components import components
from corpuskb.llm.store import materialize

SHINGLE = 5
ROWS, BANDS = 6, 36
K = ROWS * BANDS
#: Coordinates that are compared within buckets, and the standard deviations below ``least`` up to which nodes look alike.
GLANCE, DEVIATIONS = 72, 4
#: Nodes, and shingles of nodes, that are compared in one place.
PART, SHINGLES = 1000, 1 << 21
#: Digests that a task remembers, so as not to sign or send copies again.
SEEN = 200_000
#: Ids that may be broadcast, a few megabytes; beyond it the same join is shuffled.
BROADCAST_IDS = 300_000


def _elements(grams: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Each shingle with its occurrence number mixed in."""
    order = np.lexsort((grams, row))
    g, r = grams[order], row[order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (r[1:] != r[:-1])]) if len(g) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    occurrence = np.empty(len(g), np.uint64)
    occurrence[order] = np.arange(len(g)) - begin[np.cumsum(new) - 1] if len(g) else 0
    return words.mix(grams + occurrence * np.uint64(0x9E3779B97F4A7C15))


def signatures(elements: np.ndarray, row: np.ndarray, n_rows: int, k: int = K) -> np.ndarray:
    """(rows, k) 16-bit names of the earliest dart on each coordinate; rows without elements are zero."""
    weight = np.bincount(row, minlength=n_rows)
    best = np.full(n_rows * k, np.iinfo(np.uint64).max, np.uint64)
    reach = (k * np.log(k) + 2 * k) / np.maximum(weight, 1)
    active = weight > 0
    while active.any():
        at = np.flatnonzero(active[row])
        e, r = elements[at], row[at]
        rank, throw = np.zeros(len(at)), 0
        while len(e):
            throw += 1
            h = words.mix(e + np.uint64(throw * 0xBF58476D1CE4E5B9 % (1 << 64)))
            rank = rank - np.log(((h >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53))
            near = rank < reach[r]
            e, r, rank, h = e[near], r[near], rank[near], h[near]
            if len(e):
                name = words.mix(h)
                key = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (name >> np.uint64(32))
                np.minimum.at(best, r * k + (name & np.uint64(0xFFFFFFFF)).astype(np.int64) % k, key)
        missing = (best.reshape(n_rows, k) == np.iinfo(np.uint64).max).any(1)
        active &= missing
        reach = reach * 2
    out = (best.reshape(n_rows, k) & np.uint64(0xFFFF)).astype("<u2")
    out[weight == 0] = 0
    return out


def _digests(hashes: np.ndarray, cut: np.ndarray) -> list[bytes]:
    """A name of each row's words from their hashes; ``cut`` are the rows' ends among them."""
    return [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _with_digest(rows: DataFrame, text_column: str) -> DataFrame:
    """The rows with a last column ``_digest``."""
    schema = T.StructType([*rows.schema.fields, T.StructField("_digest", T.BinaryType())])
    place = rows.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = words.column_bytes(batch.column(place))
            found = []
            for a, b in words.blocks(offsets):
                piece, off = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                start, end, row = words.spans(piece, off)
                found += _digests(words.span_hashes(piece, start, end), np.searchsorted(row, np.arange(b - a + 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "_digest"])

    return rows.mapInArrow(run, schema)


def sign(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Every row's number, id and digest of its words; the first of each digest in a task also has a signature and its number of shingles."""
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        number_of_row = TaskContext.get().partitionId() << 40
        for batch in batches:
            raw, offsets = words.column_bytes(batch.column(1))
            for a, b in words.blocks(offsets):
                piece, off = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                start, end, row = words.spans(piece, off)
                hashes = words.span_hashes(piece, start, end)
                cut = np.searchsorted(row, np.arange(b - a + 1))
                digests = _digests(hashes, cut)
                fresh = np.zeros(b - a, bool)
                for j, d in enumerate(digests):
                    if d not in seen and cut[j + 1] > cut[j]:
                        fresh[j] = True
                        if len(seen) < SEEN:
                            seen.add(d)
                number = np.cumsum(fresh) - 1
                keep = fresh[row]
                grams, r = words.shingles(hashes[keep], number[row[keep]], int(fresh.sum()), SHINGLE)
                signed = signatures(_elements(grams, r), r, int(fresh.sum()))
                blobs = [signed[number[j]].tobytes() if fresh[j] else None for j in range(b - a)]
                sizes = np.bincount(r, minlength=int(fresh.sum()))
                weights = [int(sizes[number[j]]) if fresh[j] else None for j in range(b - a)]
                numbers = np.arange(number_of_row, number_of_row + b - a)
                number_of_row += b - a
                yield pa.RecordBatch.from_arrays([pa.array(numbers), batch.column(0).slice(a, b - a), pa.array(digests, pa.binary()), pa.array(blobs, pa.binary()), pa.array(weights, pa.int64())], ["row", "key", "digest", "signature", "shingles"])

    chosen = docs.select(F.col(id_column).alias("key"), F.col(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"row long, key {kind}, digest binary, signature binary, shingles long")


def _values(table: pa.Table) -> list[np.ndarray]:
    """Each row's shingles."""
    return [np.frombuffer(x, "<u8") for x in table.column("payload").to_pylist()]


def _glances(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("payload").to_pylist()), "<u2").reshape(table.num_rows, -1)


def _places(table: pa.Table) -> list[tuple[int, int]]:
    """Ranges of rows that share a bucket and a part."""
    bucket, part = table.column("bucket").to_numpy(), table.column("part").to_numpy()
    edge = np.flatnonzero((bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])) + 1
    return list(zip([0, *edge.tolist()], [*edge.tolist(), len(bucket)], strict=True))


def _forest(near, n: int) -> list[tuple[int, int]]:
    """A spanning forest (parent, child) of n nodes; ``near(some, others)`` tells which of the others are near which of some."""
    left, out = np.arange(n), []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            some, front = front[:64], front[64:]
            met = near(some, left)
            hit = met.any(0)
            out += zip(some[met[:, hit].argmax(0)].tolist(), left[hit].tolist(), strict=True)
            front, left = np.concatenate([front, left[hit]]), left[~hit]
    return out


def _glance_least(least: float) -> float:
    return least - DEVIATIONS * math.sqrt(least * (1 - least) / GLANCE)


def _look(least: float):
    """Forests of each place's nodes that look alike at a glance."""
    least = _glance_least(least)

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        node, glance, places = table.column("node").to_numpy(), _glances(table), _places(table)
        begin = np.array([x for x, _ in places])
        size = np.array([y - x for x, y in places])
        first = np.repeat(begin, size)
        # all that look like their place's first node are done; only places with others go on one by one
        plain = (glance == glance[first]).mean(1) >= least
        whole = np.repeat(np.logical_and.reduceat(plain, begin), size)
        at = np.flatnonzero(whole & (first != np.arange(len(node))))
        a, b = [node[at]], [node[first[at]]]
        for x, y in places:
            if not whole[x]:
                g, head = glance[x:y], np.arange(y - x)
                for parent, child in _forest(lambda some, left, g=g: (g[some][:, None] == g[left][None]).mean(2) >= least, y - x):
                    head[child] = head[parent]
                child = np.flatnonzero(head != np.arange(y - x))
                a.append(node[x + child])
                b.append(node[x + head[child]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return settle


def shared_counts(some: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """How many shingles each of some has in common with each of the others (with each other, if None)."""
    every = some + (others or [])
    owner = np.repeat(np.arange(len(every)), [len(e) for e in every])
    distinct, column, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(some), len(others or some)), np.float32)
    width = max(64, (1 << 22) // len(every))
    for a in range(0, int((count > 1).sum()), width):
        x, y = np.searchsorted(column, [a, a + width])
        dense = np.zeros((len(every), width), np.float32)
        dense[owner[x:y], column[x:y] - a] = 1
        out += dense[: len(some)] @ (dense[len(some) :] if others is not None else dense).T
    return out


def jaccard(a: str, b: str) -> float:
    """Weighted Jaccard similarity of two texts' shingles."""
    found = []
    for text in (a, b):
        raw = np.frombuffer(text.encode(), np.uint8)
        start, end, row = words.spans(raw, np.array([0, len(raw)]))
        found.append(_elements(*words.shingles(words.span_hashes(raw, start, end), row, 1, SHINGLE)))
    shared = int(shared_counts(found)[0, 1])
    return shared / max(1, sum(map(len, found)) - shared)


def _similar(some: list[np.ndarray], others: list[np.ndarray] | None, least: float) -> np.ndarray:
    shared = shared_counts(some, others).astype(np.float64)
    size = lambda v: np.array([len(e) for e in v], np.float64)
    return shared / np.maximum(size(some)[:, None] + size(some if others is None else others)[None] - shared, 1) >= least


def _compare(least: float):
    """Forests of each place's nodes whose shingles are alike enough; every node comes out, alone with itself."""

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        node, values, a, b = table.column("node").to_numpy(), _values(table), [], []
        for x, y in _places(table):
            # a node may come more than once
            at = x + np.unique(node[x:y], return_index=True)[1]
            alike = _similar([values[k] for k in at], None, least) if len(at) > 1 else np.ones((1, 1), bool)
            head = np.arange(len(at))
            for parent, child in _forest(lambda some, left, alike=alike: alike[np.ix_(some, left)], len(at)):
                head[child] = head[parent]
            a += node[at].tolist()
            b += node[at[head]].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return settle


def _cross(near, payloads):
    """Links of nodes that lead in a place to those that follow there, of other groups: no more than connect the groups."""

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        node, group = table.column("node").to_numpy(), table.column("grp").to_numpy()
        lead, follow = (table.column(c).to_numpy(zero_copy_only=False) for c in ("lead", "follow"))
        payload = payloads(table)
        a, b = [], []
        for x, y in _places(table):
            ahead, behind = np.flatnonzero(lead[x:y]), np.flatnonzero(follow[x:y])
            if not len(ahead) or not len(behind):
                continue
            _, first, number = np.unique(group[x:y], return_index=True, return_inverse=True)
            met = np.zeros((len(first), len(first)), bool)
            i, j = np.nonzero(near([payload[x + k] for k in ahead], [payload[x + k] for k in behind]))
            met[number[ahead[i]], number[behind[j]]] = True
            met |= met.T
            for p, q in _forest(lambda some, left, met=met: met[np.ix_(some, left)], len(first)):
                a.append(node[x + first[p]])
                b.append(node[x + first[q]])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return settle


def _in_places(settle):
    """``settle`` on a sorted partition's rows, whole places at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) < 20_000 and sum(x.nbytes for x in held) < 8 << 20:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            bucket, part = table.column("bucket").to_numpy(), table.column("part").to_numpy()
            # the last place may go on in the next batch
            last = np.flatnonzero((bucket != bucket[-1]) | (part != part[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from settle(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield from settle(pa.Table.from_batches(held).combine_chunks())

    return run


def _settled(rows: DataFrame, settle) -> DataFrame:
    """Links (a, b) from rows dealt by bucket and part."""
    dealt = rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "node")
    return dealt.mapInArrow(_in_places(settle), "a long, b long")


def buckets(nodes: DataFrame) -> DataFrame:
    """Nodes that share a bucket with others, one row for each such bucket; large buckets are split into parts."""
    bands = F.array(*(F.xxhash64(F.lit(b), F.substring("signature", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(BANDS)))
    members = nodes.where(F.col("signature").isNotNull()).select("node", F.explode(bands).alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    glances = nodes.select("node", F.substring("signature", 1, 2 * GLANCE).alias("payload"))
    # nodes fall into other parts in every bucket, so what parts of one bucket separate others join
    part = F.when(F.col("n") > PART, F.pmod(F.xxhash64("bucket", "node"), F.ceil(F.col("n") / PART))).otherwise(0).cast("int")
    shared = members.join(sizes, "bucket").select("bucket", "node", part.alias("part"), (F.col("n") > PART).alias("split"))
    return shared.join(glances, "node").select("bucket", "part", "node", "payload", "split", F.lit(1 / PART).alias("weight"))


def between_groups(met: DataFrame) -> DataFrame:
    """Rows (bucket, node, grp, payload, weight) dealt to places where any two nodes of a bucket that differ in ``grp`` meet.

    Nodes outside a bucket's largest group lead, so any two of different groups have a leader among them. Followers and
    leaders are dealt by hashes into places of a weight of about one each; every leader comes to every part of the followers.
    """
    sizes = met.groupBy("bucket", "grp").agg(F.sum("weight").alias("n"))
    whole = sizes.groupBy("bucket").agg(F.max(F.struct("n", "grp")).alias("most"), F.sum("n").alias("n"), F.count("*").alias("groups"))
    parts = lambda n: F.greatest(F.lit(1), F.ceil(n)).cast("int")
    mixed = whole.where("groups > 1").select("bucket", F.col("most.grp").alias("largest"), parts(F.col("n")).alias("p"), parts(F.col("n") - F.col("most.n")).alias("q"))
    dealt = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(n)).cast("int")
    rows = met.join(mixed, "bucket").select("bucket", "node", "payload", "grp", (F.col("grp") != F.col("largest")).alias("minor"), "p", "q", dealt(5, "p").alias("i"), dealt(7, "q").alias("j"))
    place = (F.col("x") * F.col("q")).cast("int")
    followers = rows.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("q") - 1)))
    followers = followers.select("bucket", (F.col("i") * F.col("q") + F.col("x")).alias("part"), "node", "payload", "grp", (F.col("minor") & (F.col("x") == F.col("j"))).alias("lead"), F.lit(True).alias("follow"))
    leaders = rows.where("minor and p > 1").withColumn("x", F.explode(F.sequence(F.lit(0), F.col("p") - 1))).where("x <> i")
    leaders = leaders.select("bucket", (place + F.col("j")).alias("part"), "node", "payload", "grp", F.lit(True).alias("lead"), F.lit(False).alias("follow"))
    return followers.unionByName(leaders)


def _grouped(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows with ``grp``, their node's component."""
    return rows.join(found, "node", "left").withColumn("grp", F.coalesce("component", "node")).drop("component")


def _thinned(links: DataFrame) -> DataFrame:
    """Links that connect the same nodes: one from each node, the others from its other ends to that one's.

    A node has no more links than buckets, so what is gathered of it is bounded.
    """
    ends = links.groupBy("a").agg(F.collect_set("b").alias("ends")).withColumn("least", F.array_min("ends"))
    others = ends.select(F.explode("ends").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
    return ends.select("a", F.col("least").alias("b")).unionByName(others)


def clouds(nodes: DataFrame, least: float) -> DataFrame:
    """(node, component) of nodes that look alike, through others or directly; nodes that look like none are left out."""
    met = materialize(buckets(nodes), "buckets")
    links = materialize(_thinned(_settled(met, _look(least))), "looks")
    split = met.where("split")
    if not split.isEmpty():
        split = _grouped(split, components(links))
        glance_least = _glance_least(least)
        near = lambda some, others: np.concatenate([(np.array(others) == x).mean(1)[None] >= glance_least for x in some])
        links = links.unionByName(_settled(between_groups(split), _cross(near, _glances)))
    return components(links)


def _few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def _with_keys(docs: DataFrame, keys: DataFrame, id_column: str) -> DataFrame:
    """The rows whose id is one of ``keys``, null among them."""
    keys = keys.select(F.col("key").alias("_key")).distinct()
    return docs.join(_few(keys), docs[id_column].eqNullSafe(F.col("_key")), "left_semi")


def _shingled(rows: DataFrame) -> DataFrame:
    """(digest, payload): the shingles of the rows' last column, once for each digest that a task has not just seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            raw, offsets = words.column_bytes(batch.column(1))
            for a, b in words.blocks(offsets):
                piece, off = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                start, end, row = words.spans(piece, off)
                hashes = words.span_hashes(piece, start, end)
                digests = _digests(hashes, np.searchsorted(row, np.arange(b - a + 1)))
                grams, r = words.shingles(hashes, row, b - a, SHINGLE)
                elements, cut = _elements(grams, r), np.searchsorted(r, np.arange(b - a + 1))
                new = [j for j, d in enumerate(digests) if d not in seen]
                if len(seen) < SEEN:
                    seen.update(digests)
                for k in range(0, len(new), 500):
                    some = new[k : k + 500]
                    yield pa.RecordBatch.from_arrays([pa.array([digests[j] for j in some], pa.binary()), pa.array([elements[cut[j] : cut[j + 1]].tobytes() for j in some], pa.binary())], ["digest", "payload"])

    return rows.mapInArrow(run, "digest binary, payload binary")


def _classified(docs: DataFrame, id_column: str, text_column: str, least: float) -> DataFrame:
    """(key, digest, class_id, kept) of every row; rows are told apart by number, texts by digest, never by id."""
    signed = materialize(sign(docs, id_column, text_column), "signatures")
    nodes = signed.groupBy("digest").agg(F.xxhash64("digest").alias("node"), F.min("key").alias("key"), F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "digest", "row")).alias("first"), F.first("signature", ignorenulls=True).alias("signature"), F.max("shingles").alias("shingles"))
    nodes = materialize(nodes, "nodes")
    met = clouds(nodes, least).withColumnRenamed("component", "bucket")
    met = nodes.select("node", "key", "digest", F.greatest(F.lit(1 / PART), F.col("shingles") / SHINGLES).alias("weight")).join(met, "node")
    met = materialize(met, "clouds")
    sizes = met.groupBy("bucket").agg(F.ceil(F.sum("weight")).cast("int").alias("parts"))
    wanted = met.join(sizes, "bucket").select("bucket", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), "node", "weight", "digest", (F.col("parts") > 1).alias("split"))
    rows = docs.select(F.col(id_column).alias("key"), F.col(text_column).cast("string").alias("text"))
    wanted = materialize(_shingled(_with_keys(rows, met, "key")).join(wanted.hint("shuffle_hash"), "digest"), "shingles")
    linked = materialize(_settled(wanted, _compare(least)), "alike")
    found = linked.select(F.col("a").alias("node"), F.col("b").alias("component"))
    split = wanted.where("split")
    if not split.isEmpty():
        # copies that several tasks have sent count once
        split = _grouped(split.dropDuplicates(["node"]), components(linked))
        near = lambda some, others: _similar(some, others, least)
        found = components(linked.unionByName(_settled(between_groups(split), _cross(near, _values))))
    owned = nodes.join(found, "node", "left").select("digest", "first", F.coalesce("component", "node").alias("cls"))
    named = owned.groupBy("cls").agg(F.min("first").alias("head"))
    headed = owned.join(named, "cls").select("digest", F.coalesce(F.col("head.key").cast("long"), "cls").alias("class_id"), F.col("head.row").alias("head"))
    return signed.select("row", "key", "digest").join(headed, "digest").select("key", "digest", "class_id", (F.col("row") == F.col("head")).alias("kept"))


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.8) -> DataFrame:
    """One row per input row: its id, ``class_id`` (the least id of its class) and whether it is the one row kept of it.

    Classes are the components of links between texts whose shingles have a weighted Jaccard similarity of
    ``least`` or more. Texts of fewer than five words have one shingle of all of them, so they are alike only if
    equal; texts without words, null among them, are one class. Texts are told apart by
    their words, whatever their ids; a class whose ids are all null is named by a hash. An empty table gives no rows; other columns are ignored.
    """
    return _classified(docs, id_column, text_column, least).select(F.col("key").alias(id_column), "class_id", "kept")


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.8) -> DataFrame:
    """One row of each class, all columns kept: one with the least id.

    An id of one row is enough to drop it; rows with null or repeated ids are told apart by their words as well.
    """
    rows = materialize(_classified(docs, id_column, text_column, least), "classified")
    doubtful = materialize(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1 or key is null").select("key"), "doubtful")
    gone = rows.where("not kept and key is not null").select(F.col("key").alias(id_column)).unionByName(doubtful.where("key is not null").select(F.col("key").alias(id_column))).distinct()
    gone = materialize(gone, "gone")
    plain = docs.where(F.col(id_column).isNotNull()).join(_few(gone), id_column, "left_anti").select(*docs.columns)
    if doubtful.isEmpty():
        return plain
    stay = _with_keys(rows.where("kept"), doubtful, "key").select(F.col("key").alias("_key"), F.col("digest").alias("_named"))
    text = F.col(text_column).cast("string")
    named = _with_digest(_with_keys(docs, doubtful, id_column).withColumn("_text", text), "_text")
    held = named.join(_few(stay), F.col(id_column).eqNullSafe(F.col("_key")) & (F.col("_digest") == F.col("_named")), "left_semi")
    return plain.unionByName(held.dropDuplicates([id_column, "_digest"]).select(*docs.columns))
