from corpuskb.llm import quality


def test_classifier_agrees_with_labels(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit(docs, labels)
    found = {r["doc_id"]: r["kept"] for r in quality.judge(docs, model).collect()}
    rows = [r for r in labels.collect() if r["doc_id"] in found]
    clean = [found[r["doc_id"]] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    junk = [found[r["doc_id"]] for r in rows if r["quality"] == 0]
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) <= 0.3 * len(junk)
    assert {r["doc_id"] for r in quality.keep_good(docs, model).collect()} == {k for k, kept in found.items() if kept}


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (2, "x" * 100_000), (2, "x" * 100_000)], "doc_id long, text string")
    model = quality.fit(docs, None)
    found = quality.judge(docs, model).collect()
    assert len(found) == 4 and not any(r["kept"] for r in found if r["n_words"] == 0)
    empty = docs.where("false")
    assert quality.judge(empty, quality.fit(empty, None)).count() == 0


def slow_em(documents, rounds=50):
    """Document by document, labeller by labeller: 0 abstains, 1 good, 2 bad."""
    from math import exp, log

    k = len(documents[0])
    good = [0.1 if 2 in v else 0.95 for v in documents]
    right = [[0.8] * k, [0.8] * k]
    for _ in range(rounds):
        for side in (0, 1):
            for j in range(k):
                said = agreed = 0.0
                for v, p in zip(documents, good, strict=True):
                    share = p if side == 0 else 1 - p
                    said += share * (v[j] != 0)
                    agreed += share * (v[j] == (1 if side == 0 else 2))
                right[side][j] = min(max((agreed + 4) / (said + 5), 0.15 if side else 0.9), 0.9995)
        prior = min(max(sum(good) / len(good), 0.05), 0.98)
        for d, v in enumerate(documents):
            z = log(prior / (1 - prior))
            for j in range(k):
                z += log(right[0][j] / (1 - right[1][j])) if v[j] == 1 else log((1 - right[0][j]) / right[1][j]) if v[j] == 2 else 0
            good[d] = 1 / (1 + exp(-min(max(z, -30), 30)))
    return good, right


def test_expectation_maximisation_equals_a_loop_over_documents():
    import random

    rng = random.Random(4)
    documents = []
    for _ in range(300):
        bad = rng.random() < 0.2
        documents.append([0 if rng.random() < 0.3 else (2 if bad and rng.random() < 0.6 else 1) for _ in range(quality.N_LABELLERS)])
    number = [sum(vote << (2 * j) for j, vote in enumerate(v)) for v in documents]
    counts = {p: number.count(p) for p in set(number)}
    posterior, accuracy = quality.expectation_maximisation(counts)
    good, right = slow_em(documents)
    assert all(abs(posterior[p] - g) < 1e-9 for p, g in zip(number, good, strict=True))
    assert all(abs(a - b) < 1e-9 and abs(c - d) < 1e-9 for (a, c), b, d in zip(accuracy, *right, strict=True))


def test_scores_are_the_mean_weight_of_each_rows_words():
    import numpy as np

    texts = [b"one two two !!", b"", b"AB#c three"]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    block = quality.Block(raw, np.cumsum([0, *map(len, texts)]))
    model = quality.Model(weights=np.random.default_rng(1).normal(size=quality.SLOTS).astype(np.float32), bias=0.3)
    shapes = block.shapes()
    a, b = block.slots(shapes)
    for k, score in enumerate(block.score(model, shapes)):
        mine = [float(model.weights[x]) + float(model.weights[y]) for x, y, r in zip(a, b, block.row, strict=True) if r == k]
        want = 1 / (1 + np.exp(-(sum(mine) / len(mine) + 0.3))) if mine else 0.0
        assert abs(score - want) < 1e-6


def test_a_text_of_one_insult_goes_and_clashing_columns_stay(spark):
    insult = ["zorgl", "brumpf"]
    rows = [(k, f"plain words number {k} and nothing else to see here at all" + (f" you {insult[k % 2]}" if k % 4 == 0 else ""), 1, int(k % 4 == 0), None) for k in range(160)]
    both = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int, score double")
    docs = both.select("doc_id", "text", "score", both.toxic.alias("kept"))
    model = quality.fit(docs, both.select("doc_id", "quality", "toxic"))
    kept = {r["doc_id"] for r in quality.judge(docs, model).collect() if r["kept"]}
    assert kept == {k for k in range(160) if k % 4}
    assert quality.keep_good(docs, model).columns == docs.columns


def test_repeated_ids_stay_within_the_bound(spark):
    docs = spark.createDataFrame([(1, f"text {k} with some words in it") for k in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, rows=20)
    assert quality.judge(docs, model).count() == 500
