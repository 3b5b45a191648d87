import hashlib
import random
import re
import zlib

import numpy as np

from corpuskb.llm import periodic


def plain_runs(w, exponent=4, shortest=6):
    """All runs by trying every period over every place."""
    n, found = len(w), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(shortest, exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_digest(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if i is not None and n:
        h = zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    found = plain_runs(words)
    dropped = {k for s, length, q in found for k in range(s + q, s + length)}
    longest = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    return (
        i,
        len(found),
        *(longest or (None,) * 3),
        1000 * longest[1] // longest[2] if longest else None,
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in dropped).encode()).hexdigest(),
    )


def test_z_function():
    for s in ([], [1], [1, 1, 1], [1, 2, 1, 2, 3]):
        assert periodic.z_function(s) == [0 if not i else next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def test_runs_equal_all_periods_tried():
    pick = random.Random(5)
    for _ in range(1500):
        w = [pick.randrange(pick.choice((1, 2, 3, 6))) for _ in range(pick.randrange(60))]
        if pick.random() < 0.6 and w:
            at, root = pick.randrange(len(w)), [pick.randrange(3) for _ in range(pick.randrange(1, 8))]
            w[at:at] = (root * 9)[: pick.randrange(1, 50)]
        for exponent, shortest in ((4, 6), (2, 2), (3, 5)):
            assert periodic.runs(np.array(w, np.int64), exponent, shortest) == plain_runs(w, exponent, shortest), (w, exponent)


def test_longest_words_first_and_linear_memory():
    w = np.array([0, 1] * 40_000 + list(range(2, 500)) + [7] * 20_000, np.int64)
    assert periodic.runs(w) == [(0, 80_000, 2), (80_498, 20_000, 1)]


def test_digests_of_texts(spark):
    pick = random.Random(9)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b " * 30), (7, "x"), (7, "x"), (-4, "so  so\nso so so so so then é é é é é é é é"), (9, "the end " * 3000)]
    rows += [(k, " ".join(pick.choice("ab ccc dd e".split()) for _ in range(pick.randrange(1, 90)))) for k in range(20, 260)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as runs", "3 as g", "4 as collapsed").repartition(3)
    got = periodic.digests(periodic.find(periodic.planted(df))).drop("n_words").collect()
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=order) == sorted((plain_digest(i, t) for i, t in rows), key=order)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    assert periodic.digests(periodic.find(periodic.planted(df.limit(0)))).count() == 0


def test_runs_and_collapsed_text(spark):
    row = periodic.find(spark.createDataFrame([(1, "go a b a b a b a b home home home home home home")], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(1, 8, 2), (9, 6, 1)] and row.collapsed == "go a b home" and row.n_words == 15


def test_query_over_documents(spark):
    from corpuskb.llm import queries

    found = {r.doc_id: tuple(r)[:8] for r in queries.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert found == {r.doc_id: plain_digest(r.doc_id, r.text) for r in docs}
