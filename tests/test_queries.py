"""Every query with SQL gives the SQL's rows on the smallest tables."""

import os

import duckdb
import pytest

from corpuskb.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_rows_equal_sql(spark, tables, name):
    found = registry.QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    want = tables.execute(f"SELECT {listed} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    text = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert text(found.select(*columns).collect()) == text(want)


def test_facts_of_one_file_are_judged_in_many_tasks(spark):
    from corpuskb.plans import rules, validated

    for made in (rules._facts, validated.told_facts):
        assert made(spark, DATA).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
