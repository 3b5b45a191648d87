import math
import random
import re
from collections import Counter, defaultdict

import pytest

from corpuskb.llm import balance


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(own, weights=(1, 2, 3), most=3):
    """Shares by weight, what is above ``most`` times a source's words shared again, source by source."""
    names = sorted(own, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(own.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(most * own[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > most * own[s]}
        if not above:
            return {**{s: float(most * own[s]) for s in full}, **share}
        full |= above


def plain_tilt(sizes, target, most=3):
    """The multiplier by halving."""
    longest = max(sizes)
    taken = lambda t: sum(s * math.exp(min(t * s / longest, math.log(most))) for s in sizes)
    low, high = -1e6, 1e6
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if taken(mid) < target else (low, mid)
    return low


def checked(rows, got, most=3, near=None):
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((i, words(t), s) for i, t, s in rows)
    own, by = Counter(), defaultdict(list)
    for _, t, s in rows:
        own[s] += words(t)
    for r in got:
        by[r.source].append(r)
    want = plain_targets(own)
    for s, found in by.items():
        assert {r.source_size for r in found} == {own[s]} and all(r.target == pytest.approx(want[s], rel=1e-9) for r in found)
        assert all(0 <= r.taken <= most * r.size and r.taken == r.copies * r.size for r in found)
        sized = [r for r in found if r.size]
        if not sized:
            continue
        if want[s] < most * own[s]:
            longest, tilt = max(r.size for r in sized), plain_tilt([r.size for r in sized], want[s])
            assert all(r.rate == pytest.approx(math.exp(min(tilt * r.size / longest, math.log(most))), rel=1e-5) for r in sized)
        assert all(r.copies in (math.floor(r.rate + 1e-9), math.floor(r.rate + 1e-9) + 1) for r in sized)
        lack = want[s] - sum(r.taken for r in found)
        # no single copy more or less would bring the source nearer
        for r in sized:
            base = math.floor(r.rate + 1e-9)
            if r.copies == base and base < most:
                assert abs(lack - r.size) >= abs(lack) - 1e-3 or abs(lack) <= 1e-4 * want[s]
            if r.copies == base + 1:
                assert abs(lack + r.size) >= abs(lack) - 1e-3 or abs(lack) <= 1e-4 * want[s]


def made(seed, n):
    pick = random.Random(seed)
    rows = [(k, "w " * int(pick.expovariate(1 / 80)), pick.choice(["a", "a", "a", "b", "ß", "Z", None, "", "c"])) for k in range(n)]
    rows += [(None, "x y", "a"), (None, "x y", "a"), (None, None, None), (3, "", "only empty"), (5, "few words", "tiny"), (7, "same text", "b"), (7, "same text", "b")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as key", "2 as size", "3 as n", "4 as extra")


def test_targets_rates_and_copies(spark):
    rows = made(3, 400)
    got = balance.mix(frame(spark, rows).repartition(3)).collect()
    checked(rows, got)
    again = balance.mix(frame(spark, random.Random(1).sample(rows, len(rows))).repartition(5)).collect()
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=order) == sorted(map(tuple, again), key=order)


def test_large_classes_are_ranked_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(balance, "BUCKET", 16)
    monkeypatch.setattr(balance, "_SPREAD", 7)
    rows = [(k, "one size here", "hot") for k in range(900)] + [(None, "one size here", "hot")] * 200 + [(k, "a b " * (k % 9), "cold") for k in range(200)]
    got = balance.mix(frame(spark, rows)).collect()
    checked(rows, got)
    assert len({r.copies for r in got if r.source == "hot"}) == 2


def test_nothing_to_mix(spark):
    assert balance.mix(frame(spark, [(1, "a", "s")]).limit(0)).count() == 0
    rows = [(1, None, "s"), (2, " ", None)]
    got = balance.mix(frame(spark, rows)).collect()
    assert {(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


def test_query_over_documents(spark):
    from corpuskb.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source").collect()
    checked([tuple(r) for r in docs], queries.op13_entropy_balance(spark, "/root/testdata/sf0.001").collect())
