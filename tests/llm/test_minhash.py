import random
import re
from collections import Counter

import numpy as np
import pytest

from corpuskb.llm import minhash
from corpuskb.llm.components import components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute(texts, least=0.8):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for i, s in enumerate(sets):
        near = {j for g in s for j in index.get(g, ())} if s else {j for j in range(i) if not sets[j]}
        for j in near:
            shared, every = sum((s & sets[j]).values()), sum((s | sets[j]).values())
            if not every or shared / every >= least:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for g in s:
            index.setdefault(g, []).append(i)
    return [root(i) for i in range(len(texts))]


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6)))
    texts = ["", "a", "a", "b c", " a\n", None, "x " * 400]
    for _ in range(60):
        base = [word() for _ in range(rng.choice([4, 20, 120, 900]))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(5)):
            edited = list(base)
            for _ in range(int(len(base) * rng.choice([0.0, 0.005, 0.01, 0.04, 0.3]))):
                edited[rng.randrange(len(edited))] = word()
            texts.append(" ".join(edited))
    return texts


def test_classes_equal_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' as digest", "1 as node", "2 as key").repartition(4)
    got = {r.doc_id: (r.class_id, r.kept) for r in minhash.classes(df).collect()}
    want = brute(texts)
    assert [got[i][0] for i in range(len(texts))] == want
    assert all(kept == (c == i) for i, (c, kept) in got.items())
    left = {r.doc_id for r in minhash.drop_near_copies(df).collect()}
    assert left == set(want)


def test_parts_of_large_buckets_stay_one_class(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART", 10)
    base = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(150):
        w = list(base)
        w[(7 * i) % 400] = f"own{i}"
        rows.append((i, " ".join(w)))
    got = minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_table_of_benchmark_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    want = brute([t for _, t in rows])
    got = {r.doc_id: r.class_id for r in minhash.classes(docs).collect()}
    assert [got[i] for i, _ in rows] == [rows[w][0] for w in want]


def test_edges(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (4, "q"), (4, "q")], "doc_id long, text string")
    got = minhash.classes(df).collect()
    assert len(got) == 4 and len({r.class_id for r in got}) == 2
    assert minhash.classes(df.limit(0)).count() == 0


def test_agreement_estimates_weighted_similarity():
    rng = np.random.default_rng(2)
    shared, own = rng.integers(0, 1 << 62, 300, dtype=np.uint64), rng.integers(0, 1 << 62, (2, 100), dtype=np.uint64)
    e = np.concatenate([shared, own[0], shared, own[1]])
    s = minhash.signatures(e, np.repeat([0, 1], 400), 2, 2000)
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.05


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, k) for k in range(600, 660)] + [(7, 7), (900, 901), (901, 900)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(101)} == {0} and {got[k] for k in range(600, 660)} == {500} and got[901] == 900
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6])
def test_jaccard_of_short_texts(n):
    text = " ".join("abcdefg"[:n])
    assert minhash.jaccard(text, text) == (1.0 if n else 0.0)


def test_a_text_near_its_leader_keeps_its_own_links(spark):
    # L~X 0.98 and X~Y 0.80 are links, L~Y 0.786 is none
    rng, rows = random.Random(8), []
    for k in range(80):
        texts = [[f"{rng.randrange(1 << 40):x}" for _ in range(1004)]]
        for places in ((100, 200), range(300, 740, 20)):
            edited = list(texts[-1])
            for p in places:
                edited[p] = f"own{p}"
            texts.append(edited)
        rows += [(3 * k + j, " ".join(t)) for j, t in enumerate(texts)]
    a, b, c = (t for _, t in rows[:3])
    assert minhash.jaccard(a, b) > 0.979 and 0.8 <= minhash.jaccard(b, c) < 0.81 and minhash.jaccard(a, c) < 0.79
    found = {r.doc_id: r.class_id for r in minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == i // 3 * 3 for i in found)


def test_nodes_of_all_groups_of_split_buckets_meet(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART", 3)
    rows = [(9, n, bytes([n]), n % 4 if n > 6 else 0, 1 / 3) for n in range(20)]
    places = {}
    for r in minhash.between_groups(spark.createDataFrame(rows, "bucket long, node long, payload binary, grp long, weight double")).collect():
        places.setdefault(r.part, []).append(r)
    group = {n: g for _, n, _, g, _ in rows}
    met = {(max(x.node, y.node), min(x.node, y.node)) for p in places.values() for x in p for y in p if x.lead and y.follow and x.grp != y.grp}
    assert met == {(a, b) for a in group for b in group if a > b and group[a] != group[b]}


def group_near_the_threshold(n=120, seed=5):
    """Texts made from one by edits, their similarities around 0.8, and some that are like only a few of these."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for i in range(n):
        source = base if i < n // 2 else texts[rng.randrange(i // 2)].split()
        edited = list(source)
        for _ in range(rng.choice([4, 5, 6, 7, 14])):
            edited[rng.randrange(300)] = f"own{rng.randrange(1 << 40)}"
        texts.append(" ".join(edited))
    return texts


@pytest.mark.parametrize("part", [1000, 13])
def test_hot_groups_near_the_threshold_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(minhash, "PART", part)
    texts = group_near_the_threshold()
    got = {r.doc_id: r.class_id for r in minhash.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = brute(texts)
    assert 3 < len(set(want)) < 100
    assert [got[i] for i in range(len(texts))] == want


def test_one_row_of_each_class_stays_whatever_the_ids(spark):
    text = lambda name, own="": " ".join(f"{name}{k}" for k in range(300)) + own
    rows = [(5, text("a")), (5, text("a")), (None, text("b")), (None, text("b")), (None, text("c")), (None, text("c", " end")), (1, text("d")), (7, text("d", " end")), (7, text("e")), (None, text("f")), (9, text("f", " end"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = [(r.doc_id, r.text) for r in minhash.drop_near_copies(df).collect()]
    assert sorted(t[0] for _, t in left) == list("abcdef")
    assert {(5, text("a")), (None, text("b")), (1, text("d")), (7, text("e")), (9, text("f", " end"))} < set(left)
    assert sum(r.kept for r in minhash.classes(df).collect()) == 6
