import hashlib
import random

import numpy as np
import pytest

from corpuskb.llm import repeats
from corpuskb.llm.suffix import common_prefix, deep_shallow_sort


def brute(texts, length=200):
    where = {}
    bodies = [(t or "").encode() for t in texts]
    for k, t in enumerate(bodies):
        for s in range(len(t) - length + 1):
            where.setdefault(t[s : s + length], []).append((k, s))
    gone = [np.zeros(len(t), bool) for t in bodies]
    for places in where.values():
        if len(places) > 1:
            for k, s in places:
                gone[k][s : s + length] = True
    out = []
    for t, g in zip(bodies, gone, strict=True):
        kept = bytes(np.frombuffer(t, np.uint8)[~g].tobytes())
        out.append((len(t), int(g.sum()), int((np.diff(g.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(rng.randint(40, 90)) for _ in range(3)]
    texts = [None, "", "x" * 900, "x" * 199, "ab" * 300, "short"]
    for _ in range(40):
        kind = rng.random()
        if kind < 0.3 and len(texts) > 8:
            old = rng.choice(texts[6:])
            at = rng.randint(0, len(old))
            texts.append(old[:at] + word() + old[at + rng.randint(0, 3) :])
        elif kind < 0.4 and len(texts) > 8:
            texts.append(rng.choice(texts[6:]))
        else:
            texts.append(prose(rng.randint(1, 120)) + "".join(rng.choice(shared) + prose(rng.randint(0, 60)) for _ in range(rng.randint(0, 2))))
    texts += [prose(3) + shared[0][:300] + prose(3) for _ in range(60)]
    return texts


def test_sorting_gives_order_and_common_prefixes():
    rng = random.Random(5)
    for size in (1, 2, 5, 60):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) * rng.randint(1, 6) for _ in range(size)]
        order, prefix = deep_shallow_sort(strings)
        placed = [strings[k] for k in order]
        assert placed == sorted(strings) and sorted(order) == list(range(size))
        assert prefix == [0] + [common_prefix(a, b) for a, b in zip(placed, placed[1:], strict=False)]


@pytest.mark.parametrize("part", [500, 8])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(repeats, "PART", part)
    monkeypatch.setattr(repeats, "SEEN", 1)
    texts = corpus(part)
    rows = [(k, t, "clash", 7) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, r1 long").repartition(3)
    found = {r["doc_id"]: tuple(r)[1:] for r in repeats.digests(docs).collect()}
    assert [found[k] for k in range(len(texts))] == brute(texts)
    left = {r["doc_id"]: r["text"] for r in repeats.remove(docs).collect()}
    assert left.keys() == found.keys() and left[0] is None and left[5] == "short"


def test_empty_table_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert repeats.digests(spark.createDataFrame([], schema)).count() == 0
    text = " ".join(map(str, range(100)))
    rows = repeats.digests(spark.createDataFrame([(1, text), (1, text), (None, None)], schema)).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, len(text), len(text)]


@pytest.mark.parametrize("part", [20_000, 6])
def test_spans_of_equal_rows_do_not_grow_with_their_number(spark, monkeypatch, part):
    monkeypatch.setattr(repeats, "PART", part)
    text = " ".join(map(str, range(300)))
    for n in (3, 40):
        docs = spark.createDataFrame([(1, text)] * n + [(2, text + " end")], "doc_id long, text string").repartition(2)
        found = repeats.digests(docs).collect()
        assert sorted(r["n_removed"] for r in found) == [len(text)] * (n + 1)
        spans = repeats.find(docs).distinct().groupBy("r1", "r2").count().collect()
        assert max(r["count"] for r in spans) < 60


def test_columns_named_as_the_operator_names_its_own_stay(spark):
    text = " ".join(map(str, range(100)))
    docs = spark.createDataFrame([(1, text, 5, "a", "b"), (2, text, 6, "c", "d"), (3, None, None, None, None)], "doc_id long, text string, r1 long, __spans string, spans string")
    left = sorted(map(tuple, repeats.remove(docs).collect()))
    assert left == [(1, "", 5, "a", "b"), (2, "", 6, "c", "d"), (3, None, None, None, None)]
