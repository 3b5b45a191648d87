"""Quotations and spoken items against plain loops."""

import difflib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from corpuskb.operators import joins, quotes
from corpuskb.plans import registry

DATA = "/root/testdata/sf0.001"


def plain_search_text(text):
    return re.sub(r"\s+", " ", re.sub(r"[«»\"'\-—–]", "", text or "")).strip().lower()


def plain_find(quote, text, threshold=0.7):
    if not quote or not text:
        return None
    if quote in text:
        return "exact", text.index(quote), 1.0
    q, t = plain_search_text(quote), plain_search_text(text)
    if q in t:
        return "normalized", t.index(q), 1.0
    if len(q) < 10 or len(q) > len(t):
        return None
    for i in range(0, len(t) - len(q) + 1, max(1, len(q) // 4)):
        ratio = difflib.SequenceMatcher(None, q, t[i : i + len(q)]).ratio()
        if ratio >= threshold:
            return "window", i, ratio
    return None


def plain_reason(kind, answer, asks, text, support):
    answer, asks = (answer or "").strip(), (asks or "").strip()
    if len(answer) < 15:
        return "too_short"
    if kind is None:
        return "missing_type"
    if kind not in ("dialogue", "silent_speech", "monologue"):
        return "invalid_type"
    if text and not plain_find(answer, text):
        return "answer_not_found"
    if text and len(asks) > 15 and not plain_find(asks, text) and not plain_find(asks, support):
        return "asks_not_found"
    return None


def edited(text, pick, share):
    return "".join(pick.choice("abc ") if pick.random() < share else c for c in text if pick.random() >= share / 3)


def test_subsequence_lengths():
    pick = random.Random(2)
    for n, step in ((10, 1), (17, 4), (64, 16), (130, 32)):
        quote = "".join(pick.choice("abcd") for _ in range(n))
        text = "".join(pick.choice("abcde") for _ in range(n * 3))
        count = (len(text) - n) // step + 1
        want = []
        for k in range(count):
            row = [0] * (n + 1)
            for c in text[k * step : k * step + n]:
                before = row[:]
                for j in range(n):
                    row[j + 1] = before[j] + 1 if quote[j] == c else max(before[j + 1], row[j])
            want.append(row[n])
        assert quotes.subsequence_lengths(quote, text, step, 0, count).tolist() == want
        assert quotes.subsequence_lengths(quote, text, step, 1, count - 1).tolist() == want[1:]


def test_near_equals_the_loop_over_windows(monkeypatch):
    monkeypatch.setattr(quotes, "_LANES", 7)
    pick = random.Random(3)
    vocabulary = ["".join(pick.choice("abcdefghij") for _ in range(pick.randrange(2, 8))) for _ in range(60)]
    hits = 0
    for _ in range(150):
        text = " ".join(pick.choice(vocabulary) for _ in range(pick.randrange(5, 90)))
        at, n = pick.randrange(len(text)), pick.randrange(5, 260)
        quote = edited(text[at : at + n], pick, pick.choice((0.05, 0.2, 0.3, 0.5)))
        want = plain_find(quote, text)
        if quote and plain_search_text(quote) not in plain_search_text(text):
            got = quotes.near(plain_search_text(quote), plain_search_text(text))
            assert got == (want and want[1:])
            hits += got is not None
    assert hits > 20


def items(spark):
    pick = random.Random(4)
    texts = {k: "".join(pick.choice("abcdefgh   ") for _ in range(pick.randrange(40, 900))) for k in range(12)} | {90: None, 91: ""}
    chunks = [(k, t, pick.choice([None, "", "he asked - «what is it» \n and nobody knew what"])) for k, t in texts.items()]
    rows = []
    for k in range(300):
        chunk = pick.choice([0, 0, 0, 0, *texts, None, 777])
        text = texts.get(chunk) or "some words that stand nowhere"
        cut = lambda: text[(a := pick.randrange(len(text))) : a + pick.randrange(60)]  # noqa: B023, E731
        answer = pick.choice([None, "", cut(), edited(cut(), pick, 0.15), "  " + cut() + " ", "not there at all, none of it"])
        asks = pick.choice([None, "", cut(), edited(cut(), pick, 0.2), "He asked: what was it, and nobody knew"])
        rows.append((k % 280, chunk, pick.choice([None, "other", "dialogue", "monologue", "silent_speech", "dialogue"]), answer, asks))
    return rows, chunks, spark.createDataFrame(rows, "item_id long, chunk_id long, kind string, answer string, asks string").withColumn("how", F_lit(1)), spark.createDataFrame(chunks, "chunk_id long, text string, support string").withColumn("answer", F_lit(2))


def F_lit(x):
    from pyspark.sql import functions as F

    return F.lit(x)


def test_items_are_rejected_by_the_first_rule(spark):
    rows, chunks, df, texts = items(spark)
    got = quotes.validate(df.drop("how"), texts).collect()
    known = {k: (t, s) for k, t, s in chunks}
    want = [(*r, plain_reason(r[2], r[3], r[4], *known.get(r[1], (None, None)))) for r in rows]
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert {r[-1] for r in want} == {None, "too_short", "missing_type", "invalid_type", "answer_not_found", "asks_not_found"}
    counts = {r.reason: r.n for r in quotes.rejections(quotes.validate(df.drop("how"), texts)).collect()}
    assert sum(counts.values()) == len(rows) and counts["too_short"] == sum(r[-1] == "too_short" for r in want)
    assert quotes.validate(df.drop("how").limit(0), texts).count() == 0


def test_places_and_ratios(spark):
    rows, chunks, df, texts = items(spark)
    got = quotes.locate(df.drop("how"), texts, quote="answer").collect()
    known = {k: t for k, t, _ in chunks}
    want = [(*r, *(plain_find(r[3], known.get(r[1])) or (None, None, None))) for r in rows]
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert {r[5] for r in want} == {None, "exact", "normalized", "window"}


def test_query_over_documents(spark):
    got = registry.QUERIES["quoted_items"](spark, DATA).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    from corpuskb.plans.validated import spoken_items

    want = {}
    for r in spoken_items(spark, DATA).collect():
        want[r.item_id] = plain_reason(r.kind, r.answer, r.asks, texts[r.doc_id], r.support)
    assert {r.item_id: r.reason for r in got} == want
    assert len(set(want.values())) == 6
    assert np.mean([v is None for v in want.values()]) > 0.2


def test_a_chunk_is_normalized_once_for_its_items(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counted(text):
        if text and len(text) > 200:
            seen.add(1)
        return text

    normalize = quotes.search_text
    monkeypatch.setattr(quotes, "search_text", lambda value: normalize(F.udf(counted, "string")(value)))
    text = "one long chunk of words that are looked through again and again " * 5
    items = spark.createDataFrame([(k, 1 + k // 60, text[k : k + 30]) for k in range(61)] + [(61, None, "no chunk at all"), (62, 9, "a missing chunk")], "i long, chunk_id long, quote string").repartition(5)
    chunks = spark.createDataFrame([(1, text), (2, text), (3, text)], "chunk_id long, text string")
    found = {r["i"]: r["how"] for r in quotes.locate(items, chunks).collect()}
    assert found == {k: "exact" if k < 61 else None for k in range(63)}
    assert seen.value <= 6


def test_rows_meet_wide_rows_in_copies(spark):
    rows = spark.createDataFrame([(k, 1 if k < 50 else 2 if k < 53 else None if k < 55 else 9) for k in range(58)], "i long, k long")
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, t string")
    found = {r["i"]: r["t"] for r in joins.spread_wide(rows, table, ["k"], 7).collect()}
    assert found == {k: "a" if k < 50 else "b" if k < 53 else None for k in range(58)}
