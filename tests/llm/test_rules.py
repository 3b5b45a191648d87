import re

from corpuskb.llm import queries, rules

EDGE = [None, "", " \n\t", "one", "a b c d e f g h i\na b c d e f g h i\n\na b c d e f g h i", "# é|ü\n#\n# é|ü", "w " * 3000]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs: dict = {}
    for k in range(len(words) - 7):
        runs.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {k + j for places in runs.values() if len(places) > 1 for k in places for j in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def test_base_columns_equal_brute_force(spark):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text", "source")
    extra = spark.createDataFrame([(-k, t, "x") for k, t in enumerate(EDGE, 1)], docs.schema)
    both = docs.unionByName(extra)
    model = rules.fit(both, spark.read.parquet(f"{base}/labels.parquet"))
    texts = {r["doc_id"]: r["text"] for r in both.collect()}
    found = rules.judge(both, model).collect()
    assert len(found) == len(texts)
    for r in found:
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == brute(texts[r["doc_id"]]), r["doc_id"]
        assert not (r["base_failed"] and r["kept"])


def test_most_good_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = {r["doc_id"]: r["kept"] for r in queries.op4_quality_rules(spark, "/root/testdata/sf0.01").collect()}
    good = [found[r["doc_id"]] for r in labels.where("quality = 1 and toxic = 0").collect() if r["doc_id"] in found]
    assert sum(good) >= 0.95 * len(good)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rules.judge(docs, rules.fit(docs, labels)).count() == 0
