"""Registered queries of the engine's own operators, each with equivalent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskb.functions.text import estimate_tokens, norm_text, preview, text_hash12
from corpuskb.operators import chunks, dialogues, knowledge, review
from corpuskb.streaming import event_log

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


@query(
    "exact_dedup_by_source",
    """WITH h AS (SELECT doc_id, source, n_chars, substr(md5(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))), 1, 12) AS hash FROM documents),
    k AS (SELECT hash, min(doc_id) AS first_id FROM h GROUP BY hash)
    SELECT source, count(*) AS n_docs, count(k.hash) AS n_kept, sum(CASE WHEN k.hash IS NULL THEN 0 ELSE n_chars END)::BIGINT AS kept_chars
    FROM h LEFT JOIN k ON h.hash = k.hash AND h.doc_id = k.first_id GROUP BY source""",
)
def exact_dedup_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "n_chars", text_hash12(F.col("text")).alias("hash"))
    first = docs.groupBy("hash").agg(F.min("doc_id").alias("first_id"))
    kept = docs.alias("d").join(first.alias("k"), (F.col("d.hash") == F.col("k.hash")) & (F.col("doc_id") == F.col("first_id")), "left")
    return kept.groupBy("source").agg(
        F.count("*").alias("n_docs"),
        F.count("k.hash").alias("n_kept"),
        F.sum(F.when(F.col("k.hash").isNull(), 0).otherwise(F.col("n_chars"))).alias("kept_chars"),
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows that are little to read and much to judge over all tasks, however few parts the file has."""
    spark = rows.sparkSession
    return rows.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


#: The normalizer in the oracle's dialect.
_NORM = "trim(regexp_replace(regexp_replace(regexp_replace(replace(lower(trim({0}, ' \t\n\r')), 'ё', 'е'), '\\([^)]*\\)', ' ', 'g'), '[^0-9a-zа-я\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
_HASH = "substr(md5(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'))), 1, 12)"
_PAIRS = "SELECT * FROM (SELECT conv_id, turn, role, text AS answer, lag(role) OVER w AS asked_by, lag(text) OVER w AS prompt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'assistant'"
_PARTS = "SELECT doc_id, pos, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS paragraph FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents) WHERE regexp_replace(raw, '^\\s+|\\s+$', '', 'g') <> ''"


@query("text_keys", f"SELECT doc_id, md5({_NORM.format('text')}) AS norm_md5, {_HASH.format('text')} AS hash, greatest(length(text) // 3, 1)::BIGINT AS est_tokens FROM documents")
def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(norm_text(text)).alias("norm_md5"), text_hash12(text).alias("hash"), estimate_tokens(text).alias("est_tokens"))


@query(
    "text_preview",
    "SELECT doc_id, CASE WHEN length(t) <= 180 THEN t ELSE rtrim(substr(t, 1, 177)) || '...' END AS preview FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS t FROM documents)",
)
def text_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", preview(F.col("text")).alias("preview"))


@query("lag_pairs", f"SELECT conv_id, turn, asked_by, prompt, answer FROM ({_PAIRS})")
def lag_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.lag_pairs(_table(spark, sf_dir, "conversations"))


@query(
    "message_fields",
    "SELECT conv_id, max_by(text, turn) FILTER (role = 'system') AS system, max_by(text, turn) FILTER (role = 'user') AS \"user\", max_by(text, turn) FILTER (role = 'assistant') AS assistant FROM conversations GROUP BY conv_id",
)
def message_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.message_fields(_table(spark, sf_dir, "conversations"))


@query("neighbour_window", "SELECT conv_id, turn, string_agg(text, chr(10) || chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS context FROM conversations")
def neighbour_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.neighbour_window(_table(spark, sf_dir, "conversations"))


@query(
    "exact_pair_dedup",
    f"""WITH p AS ({_PAIRS}), h AS (SELECT *, {_HASH.format("(coalesce(prompt, '') || coalesce(answer, ''))")} AS pair_hash FROM p)
    SELECT conv_id, turn, asked_by, prompt, answer, pair_hash, n_copies FROM (SELECT *, row_number() OVER (PARTITION BY pair_hash ORDER BY conv_id, turn) AS k, count(*) OVER (PARTITION BY pair_hash) AS n_copies FROM h) WHERE k = 1""",
)
def exact_pair_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.exact_first(lag_pairs(spark, sf_dir))


@query("fuzzy_pair_dedup")
def fuzzy_pair_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all answers in order; difflib's ratio has no SQL form."""
    return dialogues.fuzzy_first_overall(exact_pair_dedup(spark, sf_dir), "answer", ["conv_id", "turn"]).select("conv_id", "turn", "pair_hash")


@query(
    "sample_chunk_links",
    f"""WITH p AS ({_PAIRS}), k AS (SELECT conv_id, turn, {_NORM.format("coalesce(prompt, '')")} AS kp, {_NORM.format('answer')} AS ka, conv_id * 1000 + turn AS chunk_id FROM p),
    e AS (SELECT kp, ka, min(chunk_id) AS exact_id FROM k GROUP BY kp, ka), l AS (SELECT ka, min(chunk_id) AS loose_id FROM k GROUP BY ka)
    SELECT conv_id, turn, exact_id, loose_id, coalesce(exact_id, loose_id) AS chunk_id FROM (SELECT conv_id, turn, kp, ka FROM k) k LEFT JOIN e USING (kp, ka) LEFT JOIN l USING (ka)""",
)
def sample_chunk_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = lag_pairs(spark, sf_dir)
    index = pairs.select("prompt", "answer", (F.col("conv_id") * 1000 + F.col("turn")).alias("chunk_id"))
    return dialogues.linked_samples(pairs, index).select("conv_id", "turn", "exact_id", "loose_id", "chunk_id")


_BLANK = "regexp_split_to_array(text, '\\n\\s*\\n+')"


@query("paragraphs", f"SELECT doc_id, pos, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS paragraph FROM (SELECT doc_id, unnest({_BLANK}) AS raw, generate_subscripts({_BLANK}, 1) - 1 AS pos FROM documents) WHERE regexp_replace(raw, '^\\s+|\\s+$', '', 'g') <> ''")
def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.paragraphs(_table(spark, sf_dir, "documents"))


@query(
    "chapter_map",
    f"""WITH p AS (SELECT *, trim(regexp_replace(paragraph, '\\s+', ' ', 'g')) AS t FROM ({_PARTS})), h AS (SELECT *, CASE WHEN length(t) BETWEEN 1 AND 120 AND (regexp_matches(t, '(?i)^(глава|часть|книга|пролог|эпилог|послесловие|предисловие)([^0-9a-zа-яё_].*)?$') OR regexp_matches(t, '(?i)^[ivxlcdm]+[.)]?$') OR regexp_matches(t, '^[0-9]+[.)]?$')
        OR (length(regexp_replace(t, '[^A-Za-zА-Яа-яЁё]', '', 'g')) >= 4 AND upper(regexp_replace(t, '[^A-Za-zА-Яа-яЁё]', '', 'g')) = regexp_replace(t, '[^A-Za-zА-Яа-яЁё]', '', 'g'))) THEN paragraph END AS heading FROM p)
    SELECT doc_id, pos, coalesce(last_value(heading IGNORE NULLS) OVER w, '-') AS chapter, count(heading) OVER w AS section FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)""",
)
def chapter_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.with_chapter(chunks.paragraphs(_table(spark, sf_dir, "documents"), "\n")).drop("paragraph")


@query("chunk_packing")
def chunk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy packing is a fold in order; tests hold it against a loop."""
    return chunks.packed(_table(spark, sf_dir, "documents")).select("doc_id", "idx", F.md5("chunk_text").alias("chunk_md5"), "est_tokens")


@query(
    "degenerate_texts",
    f"""WITH p AS (SELECT p.* FROM ({_PARTS}) p JOIN documents d USING (doc_id) WHERE length(d.text) >= 200), e AS (SELECT doc_id, paragraph, count(*) AS n FROM p GROUP BY ALL),
    l AS (SELECT doc_id, sum(n)::BIGINT AS n_lines, max(n) AS top_lines FROM e GROUP BY doc_id),
    w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents WHERE length(text) >= 200),
    r AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' '))) AS run FROM w WHERE len(w) >= 20),
    g AS (SELECT doc_id, sum(n)::BIGINT AS n_runs, max(n) AS top_runs FROM (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL) GROUP BY doc_id)
    SELECT doc_id, n_lines, top_lines, n_runs, top_runs FROM l FULL JOIN g USING (doc_id) WHERE n_lines >= 8 AND top_lines > 0.6 * n_lines OR top_runs > 0.35 * n_runs""",
)
def degenerate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.degenerate(_table(spark, sf_dir, "documents"))


#: Events as a change log: a user's settings, where an error deletes them.
_OPS = "SELECT event_id AS op_id, ts, user_id AS entity_id, CASE WHEN event_type <> 'error' THEN event_type END AS after FROM events"


def _ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(F.col("event_id").alias("op_id"), "ts", F.col("user_id").alias("entity_id"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("after"))


def _replayed(log: str) -> str:
    return f"SELECT entity_id, op_id, after, n_ops FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY ts DESC, op_id DESC) AS k, count(*) OVER (PARTITION BY entity_id) AS n_ops FROM ({log})) WHERE k = 1 AND after IS NOT NULL"


@query("oplog_replay", _replayed(_OPS))
def oplog_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.replay(_ops(spark, sf_dir))


#: The log with what each operation found.
_LOG = f"SELECT op_id::DOUBLE AS op_id, ts, entity_id, lag(after) OVER (PARTITION BY entity_id ORDER BY ts, op_id) AS before, after FROM ({_OPS})"


@query("oplog_undo", _replayed(f"WITH l AS ({_LOG}) SELECT * FROM l UNION ALL (SELECT op_id + 0.5, ts, entity_id, after, before FROM l ORDER BY ts DESC, op_id DESC LIMIT 1)"))
def oplog_undo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after the latest operation of all has been undone by its inverse."""
    before = F.lag("after").over(W.partitionBy("entity_id").orderBy("ts", "op_id"))
    log = _ops(spark, sf_dir).select(F.col("op_id").cast("double").alias("op_id"), "ts", "entity_id", before.alias("before"), "after")
    return review.replay(review.undo_last(log, lambda op: op + 0.5))


@query("event_listing", "SELECT event_id, event_type, value FROM events WHERE event_type = 'error' AND contains(props, '7') ORDER BY event_id DESC LIMIT 50 OFFSET 10")
def event_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review.search(_table(spark, sf_dir, "events").where("event_type = 'error'"), "7", ["props"])
    return review.page(rows, [F.desc("event_id")], 50, 10).select("event_id", "event_type", "value")


@query("recent_events", "SELECT user_id, event_id, n FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 80")
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = W.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return _table(spark, sf_dir, "events").select("user_id", "event_id", F.row_number().over(order).alias("n")).where("n <= 80")


@query("event_windows", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log.windowed_counts(_table(spark, sf_dir, "events")).withColumn("total", F.round("total", 2))


@query("document_ids", f"SELECT doc_id, concat_ws(':', 'doc', hash, row_number() OVER (PARTITION BY hash ORDER BY doc_id)) AS stable_id FROM (SELECT doc_id, {_HASH.format('text')} AS hash FROM documents)")
def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", text_hash12(F.col("text")).alias("hash"))
    return review.occurrence_ids(docs, "doc", "hash", ["doc_id"]).select("doc_id", "stable_id")


@query(
    "event_graph",
    "SELECT source, target, count(*) AS evidence, 'before' AS type FROM (SELECT event_type AS source, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS target FROM events) WHERE target IS NOT NULL AND source <> target GROUP BY ALL",
)
def event_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.edges(_table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type")


@query("source_nodes", f"SELECT 'source::' || {_NORM.format('source')} AS node_id, min_by(source, doc_id) AS label, array_to_string(list_sort(list(DISTINCT lang)), ',') AS books FROM documents GROUP BY 1")
def source_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.nodes(_table(spark, sf_dir, "documents"), "source", "source", "lang", "doc_id")


@query(
    "corpus_summary",
    "SELECT lang, count(*) AS n_docs, count(DISTINCT source) AS n_sources, sum(n_chars)::BIGINT AS n_chars, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality IS NULL) AS n_unlabelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang",
)
def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(_table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.groupBy("lang").agg(F.count("*").alias("n_docs"), F.countDistinct("source").alias("n_sources"), F.sum("n_chars").alias("n_chars"), F.count_if(F.col("quality") == 1).alias("n_good"), F.count_if(F.col("quality").isNull()).alias("n_unlabelled"))


@query("unreviewed", "SELECT source, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY source")
def unreviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return docs.join(_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("n"))


_FACTS = [
    (0, "history", "Марк Рейн", "Марк раньше был стражем у северных ворот"),
    (1, "history", "Марк", "Марк больше не служит стражем у северных ворот"),
    (2, "place", "Старый мост", "Старый мост стоит над рекой"),
    (3, "event", "Лина", "Лина сейчас живет в башне"),
    (4, "event", "Лина Вест", "Лина пришла в башню"),
    (5, "event", "Лина Орт", "Лина теперь целитель"),
]
_FACT_SQL = "(VALUES " + ", ".join(f"({o}, '{c}', '{s}', '{f}')" for o, c, s, f in _FACTS) + ") AS f(ord, category, subject, fact)"


def _facts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_FACTS, "ord int, category string, subject string, fact string")


@query(
    "subject_aliases",
    f"""WITH k AS (SELECT DISTINCT {_NORM.format('subject')} AS key, subject FROM {_FACT_SQL}), l AS (SELECT string_split(key, ' ')[1] AS alias, min(subject) AS canonical FROM k WHERE key LIKE '% %' GROUP BY 1 HAVING count(*) = 1)
    SELECT alias, canonical FROM l WHERE alias IN (SELECT key FROM k)""",
)
def subject_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knowledge.alias_map(_facts(spark))


@query(
    "page_text",
    "SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, len(regexp_extract_all(html, '<p[ >]')) AS n_paragraphs, length(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))) AS text_chars FROM pages",
)
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->", " "), "<[^>]*>", " ")
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.size(F.regexp_extract_all("html", F.lit("<p[ >]"), 0)).cast("long").alias("n_paragraphs"),
        F.length(F.trim(F.regexp_replace(plain, r"\s+", " "))).cast("long").alias("text_chars"),
    )


# registers the queries of rules and of speech next to these
from corpuskb.plans import rules, spoken, validated  # noqa: E402, F401
