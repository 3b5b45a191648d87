"""Documents of one file are judged over all tasks."""

import pytest

from corpuskb.operators import chunks
from corpuskb.plans import spoken, validated

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("texts", [spoken._texts, validated.named_scenes])
def test_texts_of_one_file_reach_all_tasks(spark, texts):
    found = texts(spark, SF)
    assert found.rdd.getNumPartitions() > 4
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_lines_are_judged_once_before_they_are_put_in_order(spark):
    lines = ["Глава 1", "Он ушёл.", " * * * ", "* ** * x", "ИТОГ", "", "\u2003***\u00a0", "*" * 13, "12."]
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    found = chunks.sections(chunks.paragraphs(docs, "\n"))
    assert [(r["pos"], r["section"], r["heading"]) for r in found.orderBy("pos").collect()] == [(0, 1, True), (1, 1, False), (3, 2, False), (4, 3, True), (7, 4, False), (8, 5, True)]


def test_texts_are_dealt_before_lines_of_them_are_judged(spark):
    plan = validated.told_facts(spark, SF).where("subject <> ''")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Repartition")
