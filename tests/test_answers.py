"""Answers that are wrapped, damaged or cut, against what they were made from."""

import json
import random
import re

import pytest

from corpuskb.operators import answers
from corpuskb.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "text,expect,value,strategy",
    [
        ('[{"a": 1}]', "array", [{"a": 1}], "raw"),
        ('{"a": [1, 2]}', "object", {"a": [1, 2]}, "raw"),
        ('Here: {"a": "}"} and more', "object", {"a": "}"}, "balanced"),
        ('so [1, "]", 2] ends', "array", [1, "]", 2], "balanced"),
        ('[{"a": 1,}, ]', "array", [{"a": 1}], "raw+fix_commas"),
        ('see [1, 2,] there', "array", [1, 2], "balanced+fix_commas"),
        ('{"a": "he said "no" twice"}', "object", {"a": 'he said "no" twice'}, "raw+repair_quotes"),
        ('{"a": "x "y" z",}', "object", {"a": 'x "y" z'}, "raw+repair_quotes+fix_commas"),
        ('[{"a": 1}, {"a": 2}, {"a": ', "array", [{"a": 1}, {"a": 2}], "partial_array"),
        ('[{"a": "x "y" z"}, {"a": "cut', "array", [{"a": 'x "y" z'}], "partial_array+repair_quotes"),
        ('{"a": "open', "object", None, "failed"),
        ("[]", "array", [], "raw"),
        ("[", "array", None, "failed"),
        ("", "array", None, "failed"),
        ("nothing here", "object", None, "failed"),
        ('{"a": 1}', "array", None, "failed"),
        ('"text \\', "array", None, "failed"),
        ("[1, , 2", "array", [1, 2], "partial_array"),
        ('{"a": "quote \\" kept", "b": "new\\nline"}', "object", {"a": 'quote " kept', "b": "new\nline"}, "raw"),
        ("[" * 100_000, "array", None, "failed"),
        ("[" * 100_000 + "]" * 100_000, "array", None, "failed"),
    ],
)
def test_cases(text, expect, value, strategy):
    assert answers.read(text, expect) == (value, strategy)


def made(seed):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice('abcяю 9{}[]:,\\"\n') for _ in range(pick.randrange(12)))
    return [{"category": word(), "subject": word(), "fact": word(), "n": pick.randrange(9)} for _ in range(pick.randrange(1, 6))]


def test_damage_is_undone():
    for k in range(300):
        items, pick = made(k), random.Random(k + 1)
        text = json.dumps(items, ensure_ascii=k % 2 == 0, indent=pick.choice([None, 2]))
        assert answers.read(text, "array") == (items, "raw")
        assert answers.read("Answer, as asked: " + text + " I hope (so)", "array")[0] == items
        # commas before closing brackets go, also within strings
        assert re.search(r",\s*[}\]]", text) or answers.read(text[:-1] + ",]", "array") == (items, "raw+fix_commas")
        cut = text[: pick.randrange(1, len(text))]
        got, name = answers.read(cut, "array")
        assert got is None or got == items[: len(got)] or name.endswith("repair_quotes")
        plain = [{"fact": "she said now"}, {"fact": "and then"}]
        assert answers.read(json.dumps(plain).replace("said", 'said "so"'), "array")[0] == [{"fact": 'she said "so" now'}, {"fact": "and then"}]


def test_tables_of_answers(spark):
    rows = [(1, '```json\n[{"category": "place", "subject": "Ka", "fact": "far"}, 7, {"subject": "x"}]\n```'), (2, None), (3, ""), (3, ""), (None, 'json: [{"fact": "\\ud800"},]'), (5, "[1"), (6, '[{"fact": "a", "time_scope": "now"}')]
    df = spark.createDataFrame(rows, "resp_id long, answer string").selectExpr("*", "1 as text")
    got = answers.parsed(df)
    assert got.columns == ["resp_id", "answer", "text", "value", "strategy"]
    assert sorted((str(r.resp_id), r.strategy) for r in got.collect()) == [("1", "raw"), ("2", "failed"), ("3", "failed"), ("3", "failed"), ("5", "partial_array"), ("6", "partial_array"), ("None", "raw+fix_commas")]
    facts = answers.fact_items(got.where("resp_id in (1, 6)")).collect()
    assert sorted((r.resp_id, r.pos, r.category, r.subject, r.fact, r.time_scope) for r in facts) == [(1, 0, "place", "Ka", "far", None), (6, 0, None, None, "a", "now")]
    assert answers.parsed(df.limit(0)).count() == 0


def test_query_over_documents(spark):
    got = {r.doc_id: r for r in registry.QUERIES["model_answers"](spark, DATA).collect()}
    docs = {r.doc_id: [x for x in (r.text or "").split("\n") if x] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    assert got.keys() == docs.keys()
    for k, lines in docs.items():
        r = got[k]
        if k % 5 < 3:
            assert r.n_items == len(lines) and not r.strategy.startswith("partial")
        elif k % 5 == 3:
            assert (r.n_items or 0) <= len(lines) and r.strategy in ("partial_array", "failed", "partial_array+repair_quotes")
    assert sum(r.strategy == "failed" for r in got.values()) < len(got) / 4
