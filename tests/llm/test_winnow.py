import hashlib
import re

from corpuskb.llm import winnow

ROWS = [(5, "a b c d e f g h i j k"), (3, "a b c d e f g h i j k"), (9, None), (1, ""), (2, "one"), (3, "x y"), (None, "tail of it all"), (7, "same same same same same same same same same"), (-4, "é\tñ\n\nß 🙂 w x y z" * 40)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as found", "2 as next_text", "3 as _key")


def test_edited_texts_and_neighbours(spark):
    got = winnow.compare(frame(spark)).collect()
    assert len(got) == len(ROWS)
    ordered = sorted(((i, t or "") for i, t in ROWS), key=lambda r: (-(r[0] if r[0] is not None else -10**9), r[1]))
    want = []
    for k, (i, t) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(want, key=key)
    by = {r.doc_id: r for r in got if r.doc_id != 3}
    same = [r for r in got if r.n_chars == by[5].n_chars and r.doc_id in (3, 5)]
    assert len({r.fingerprint for r in same}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert winnow.compare(frame(spark).limit(0)).count() == 0


def test_least_hash_of_every_window_rightmost(spark):
    df = frame(spark)
    hashed = {r.text: r.h for r in df.selectExpr("text", "transform(filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> ''), x -> hash(x)) as h").collect() if r.text}
    runs = spark.createDataFrame([(t, [h[i : i + 3] for i in range(len(h) - 2)]) for t, h in hashed.items() if len(h) >= 3], "text string, runs array<array<int>>")
    grams = {r.text: r.g for r in runs.selectExpr("text", "transform(runs, r -> hash(r[0], r[1], r[2])) as g").collect()}
    for r in df.select("text", winnow.entries("text").alias("e")).collect():
        if r.text not in grams:
            assert len(r.e or []) == (1 if r.text and re.findall(r"\S+", r.text) else 0)
            continue
        g, want = grams[r.text], []
        for a in range(max(1, len(g) - winnow.W + 1)):
            window = g[a : a + winnow.W]
            at = max(a + j for j, x in enumerate(window) if x == min(window))
            want.append((g[at], at))
        found = [(v >> 31, winnow._LAST - (v & winnow._LAST)) for v in r.e]
        assert found == list(dict.fromkeys(want))
