"""The query of answers' texts against its SQL on texts that read like wrappers themselves."""

import duckdb

from corpuskb.plans import registry

ODD = [
    None, "", " \n\t", "\x0b", "\u2003", "json", "JSON: x", " Json:json :x", "```", "```json\nx\n```", "x\n```", "\ufeffx", "\ufeff", "\xa0x\u3000", "\x0bx\x0b", "x \u0085", "x  \n",
    "a [b] [| c", "x\n\n[SUPPORTING CONTEXT]\ny", "x\n [SCENE GLOSSARY] y", "[PRIMARY CHUNK 1]\nx", "[SUPPORTING CONTEXT]", "|x|", "|", "[", " x\ny ", ":x", "Jsonnet is a word",
]
NAMES = [("en", "src1"), (None, "src1"), ("en", None), ("", ""), (" en ", " src|1 "), ("[", "json")]


def test_rows_equal_sql_on_odd_texts(spark, tmp_path):
    rows = [(k, text, *NAMES[0]) for text in ODD for k in range(6)] + [(k, "x", *n) for n in NAMES for k in range(6)] + [(-3, "x", "en", "src1"), (-2, "", "en", "src1"), (None, "json", "en", "src1")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["answer_texts"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.ORACLE_SQL['answer_texts']})").fetchall()
    text = lambda found: sorted(tuple(map(str, r)) for r in found)
    assert text(got.collect()) == text(want)
