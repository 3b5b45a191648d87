"""The timeline's graph against one put together node by node."""

import hashlib
import random

from corpuskb.functions import names
from corpuskb.operators import joins, timeline_graph
from test_same_facts import norm, scope_of, subject_of


def short_hash(text):
    return hashlib.md5(text.strip().lower().encode()).hexdigest()[:12]


def kind_of(category):
    return names.ENTITY_TYPES.get((category or "").strip(), "unknown")


def plain_graph(events, entities, relations, facts):
    nodes, edges, category = {}, {}, {}

    def mention(label, cat, book):
        label = (label or "").strip()
        if not label:
            return None
        key = f"{kind_of(cat)}::{subject_of(label) or short_hash(label)}"
        node = nodes.setdefault(key, (label, kind_of(cat), set()))
        node[2].update({book} if book else ())
        return key

    def edge(a, b, kind, book, chapter, chunks=(), evidence="", confidence=""):
        kind = norm(kind).replace(" ", "_")
        kind = kind if kind in names.RELATION_TYPES else "related_to"
        if a and b and a != b:
            edges.setdefault((a, b, kind, book, chapter, tuple(sorted(chunks))), ((evidence or "").strip(), (confidence or "").strip() or "explicit"))

    for _, subject, cat, book in sorted(facts, key=lambda f: f[0]):
        if (subject or "").strip():
            category[subject_of(subject)] = (cat or "").strip()
            mention(subject, cat, (book or "").strip())
    count, found = 0, {}
    for g in sorted({r[0] for t in (events, entities, relations) for r in t}):
        own, local = sorted(e for e in events if e[0] == g), {}
        for _, book, chapter, pos, local_id, label, summary, scope, chunks, *lists in own:
            stem = book.rsplit(".", 1)[0] if "." in book else book
            key = f"event::{stem}::{short_hash(chapter)}::{count + pos:03d}"
            local[(local_id or "").strip() or f"E{pos}"] = key
            text, told = (label or "").strip(), (summary or "").strip()
            found[key] = (text or f"{chapter}: событие {pos}", told, scope_of(scope, told or text, "event"), sorted(c for c in chunks or () if c is not None), book, chapter)
            for labels, (kind, hint) in zip(lists, timeline_graph.ROLES.values(), strict=True):
                for x in labels or ():
                    edge(key, mention(x, category.get(subject_of(x or ""), hint), book), kind, book, chapter, found[key][3])
        count += len(own)
        for _, book, _, label, kind in sorted(e for e in entities if e[0] == g):
            mention(label, kind, book)
        for _, book, chapter, _, a, b, kind, evidence, confidence in sorted(r for r in relations if r[0] == g):
            a, b = (a or "").strip(), (b or "").strip()
            if a and b:
                ends = [local.get(x) or mention(x, category.get(subject_of(x), ""), book) for x in (a, b)]
                edge(*ends, kind or "", book, chapter, (), evidence, confidence)
    return {k: (label, kind, sorted(books)) for k, (label, kind, books) in nodes.items()}, found, edges


def made(seed):
    pick = random.Random(seed)
    name = lambda: pick.choice(["Ирма", "сэр Ирма", "Ирма Таль", "Дом у Моста", "Камра", "!!", "", None, "E2", "Ехо"])
    listed = lambda: pick.choice([None, [], [name()], [name(), name(), name()]])
    place = lambda g: (f"b{g % 2}.fb2", f"Глава {g}")
    events = [(g, *place(g), pos, pick.choice(["E1", "x", "", None, "E2"]), pick.choice(["label", "", None]), pick.choice(["теперь он стал другим", "", None]), pick.choice(["past", None, "no"]), pick.choice([None, [], [3, 1], [2, None]]), listed(), listed(), listed()) for g in range(6) for pos in range(1, pick.randrange(1, 6))]
    entities = [(g, place(g)[0], pos, name(), pick.choice(["character", "place", "", None, "odd"])) for g in range(6) for pos in range(2)]
    relations = [(g, *place(g), pos, pick.choice([name(), "E1", "x"]), pick.choice([name(), "E2", "E1"]), pick.choice(["before", "Occurs in", "", "odd", None]), pick.choice([" so ", None]), pick.choice(["", "likely"])) for g in range(6) for pos in range(5)]
    facts = [(k, name(), pick.choice(["character", "place", "magic", "", None]), pick.choice(["b0.fb2", "b9.fb2", "", None])) for k in range(8)]
    return events, entities, relations, facts


SCHEMAS = (
    "grp long, book string, chapter string, pos int, local_id string, label string, summary string, time_scope string, chunk_indices array<long>, participants array<string>, places array<string>, objects array<string>",
    "grp long, book string, pos int, label string, type string",
    "grp long, book string, chapter string, pos int, source string, target string, type string, evidence string, confidence string",
    "ord long, subject string, category string, book string",
)


def test_graph_equals_one_put_together_in_order(spark):
    for seed in (1, 2):
        tables = made(seed)
        nodes, edges = timeline_graph.build(*(spark.createDataFrame(t, s).repartition(3) for t, s in zip(tables, SCHEMAS, strict=True)))
        want_nodes, want_events, want_edges = plain_graph(*tables)
        rows = nodes.collect()
        assert {r.id: (r.label, r.type, r.source_books) for r in rows if r.type != "event"} == want_nodes
        assert {r.id: (r.label, r.summary, r.time_scope, r.chunk_indices, r.book, r.chapter) for r in rows if r.type == "event"} == want_events
        got = edges.collect()
        assert {(r.source, r.target, r.type, r.book, r.chapter, tuple(r.chunk_indices)): (r.evidence, r.confidence) for r in got} == want_edges and len(got) == len(want_edges)
    empty = timeline_graph.build(*(spark.createDataFrame([], s) for s in SCHEMAS))
    assert [df.count() for df in empty] == [0, 0]


def test_first_facts_of_chapters_become_events(spark):
    rows = [(g, no, c, s, f, t, no % 3 or None) for g in (1, 2) for no, (c, s, f, t) in enumerate([("event", "Ирма", "пришла", ""), ("place", "Ехо", "город стоит", ""), ("place", "", "Ехо раньше был мал", None), ("history", None, " ", ""), ("custom", "x", "сейчас в ходу " + "очень " * 20, "odd")] * 130, 1)]
    got = timeline_graph.fallback_events(spark.createDataFrame(rows, "grp long, no long, category string, subject string, fact string, time_scope string, chunk_idx long").repartition(4)).orderBy("grp", "pos").collect()
    assert [(r.grp, r.pos) for r in got] == [(g, p) for g in (1, 2) for p in range(1, 13)]
    assert [r.local_id for r in got[:5]] == ["E1", "E3", "E5", "E6", "E8"] and [r.time_scope for r in got[:3]] == ["unclear", "past", "current"]
    assert got[0].chunk_indices == [1] and got[1].chunk_indices == [] and got[1].participants == [] and len(got[2].label) == 72 and got[2].summary.endswith("очень")


def test_running_total(spark):
    rows = [(k, (k * 7) % 5) for k in range(1, 300)]
    got = {r.k: r.t for r in joins.running_total(spark.createDataFrame(rows, "k long, v long").repartition(5), "k", "v", "t").collect()}
    assert got == {k: sum(v for j, v in rows if j < k) for k, _ in rows}


def test_query_over_documents(spark):
    import zlib

    from corpuskb.plans import registry
    from corpuskb.plans.validated import _chapters

    data = "/root/testdata/sf0.001"
    tables = [[tuple(r) for r in t.collect()] for t in _chapters(spark, data)]
    nodes, events, edges = plain_graph(*tables)
    want = {}

    def add(part, kind, *columns):
        n, digest = want.get((part, kind), (0, 0))
        want[part, kind] = (n + 1, digest + zlib.crc32("|".join(columns).encode()))

    for key, (label, kind, books) in nodes.items():
        add("node", kind, key, label, ",".join(books))
    for key, (label, *_rest) in events.items():
        add("node", "event", key, label)
    for (a, b, kind, book, chapter, _), (_evidence, confidence) in edges.items():
        add("edge", kind, a, b, book, chapter, confidence)
    assert {(r.part, r.type): (r.n, r.digest) for r in registry.QUERIES["timeline_graph"](spark, data).collect()} == want
