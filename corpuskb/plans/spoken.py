"""Queries of speech, monologues, training pairs, timeline groups, reports and reviews; their SQL is written by hand.

Spoken texts are made from whole documents: every line stands between beginnings and ends that its number chooses, so
that all rules meet words they know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskb.functions import names
from corpuskb.functions.text import chunk_heading
from corpuskb.operators import dialogues, metrics, review, speech, timeline
from corpuskb.plans.registry import _PAIRS, _dealt, _table, query

_OPENS = ("— ", "– ", "", "- ", "— Ну и ночь! — сказал Джон Смит. — ", "Впрочем, я подумал: ", "Мне и моей жизни — ", "Честно говоря, мне моя камра и я. ")
_CLOSES = ("", " — спросил я.", " — кивнула Леди Анна", "... — сказал он. — И всё...", " — а потом ушла")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))
    told = F.transform(F.split("text", "\n"), lambda x, i: F.concat(pick(_OPENS, F.col("doc_id") + i), x, pick(_CLOSES, F.col("doc_id") + i)))
    # a text is little to read and much to judge, so texts are dealt over all tasks
    return _dealt(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.array_join(told, "\n").alias("text"))


_S = "[\\s\\x{00a0}]"
_LINES = f"""(SELECT doc_id, k - 1 AS line_num, regexp_replace(raw, '^{_S}+|{_S}+$', '', 'g') AS line FROM (SELECT doc_id, k,
    ['— ', '– ', '', '-' || chr(160), '— Ну и ночь! — сказал Джон Смит. — ', 'Впрочем, я подумал: ', 'Мне и моей жизни — ', 'Честно говоря, мне моя камра и я. '][(doc_id + k - 1) % 8 + 1] || l[k] || ['', ' — спросил я.', ' — кивнула Леди Анна', '... — сказал он. — И всё...', ' — а потом ушла'][(doc_id + k - 1) % 5 + 1] AS raw
    FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))))"""
_B = "[^0-9A-Za-zА-Яа-яЁё_]"
_SPEECH = f"""(SELECT doc_id, line_num, CASE WHEN regexp_matches(c, '(^|{_B})(сказал[аи]?|спросил[аи]?|ответил|вздохнул|буркнул|пробормотал|согласился|подтвердил|возразил|воскликнул|прошептал|предложил){_S}+я({_B}|$)') THEN 'Макс'
    ELSE coalesce(nullif(regexp_extract(c, '(?:сказал[аи]?|спросил[аи]?|ответил[аи]?|проворчал[аи]?|пробормотал[аи]?|буркнул[аи]?|вздохнул[аи]?|усмехнулся|усмехнулась|рассмеялся|рассмеялась|кивнул[аи]?|покачал[аи]?{_S}+головой|объяснил[аи]?|заметил[аи]?|добавил[аи]?|согласился|согласилась|обиделся|обиделась|подтвердил[аи]?|возразил[аи]?|воскликнул[аи]?|прошептал[аи]?|предложил[аи]?|попросил[аи]?|крикнул[аи]?|произнёс|произнесла){_S}+((?:сэр{_S}+|леди{_S}+|господин{_S}+)?[А-ЯЁ][а-яё]+(?:{_S}+[А-ЯЁ][а-яё\\-]+)?)', 1), ''),
        CASE regexp_extract(c, '(?:сказал[аи]?|спросил[аи]?|ответил[аи]?){_S}+(я|он|она)(?:{_B}|$)', 1) WHEN 'я' THEN 'Макс' WHEN 'он' THEN 'он' WHEN 'она' THEN 'она' END) END AS speaker,
    regexp_replace(regexp_replace(regexp_replace(array_to_string(list_filter(list_transform(string_split(regexp_replace(s, '{_S}*—{_S}*([а-яё])', chr(1) || '\\1', 'g'), chr(1)), lambda p, i: CASE WHEN i > 1 AND regexp_matches(p, '(?i)^(сказал|спросил|ответил|вздохнул|проворчал|буркнул|пробормотал|усмехнул|рассмеял|кивнул|покачал|объяснил|заметил|добавил|согласил|обидел|подтвердил|возразил|воскликнул|прошептал|предложил|попросил|крикнул|произнёс|произнесла)')
        THEN nullif(regexp_extract(p, '[.!?]{_S}*—?{_S}*([^\\n]+)', 1), '') ELSE p END), lambda p: p IS NOT NULL), ' '), '{_S}+', ' ', 'g'), '^ | $', '', 'g'), '\\.+$', '') AS text, substr(before, 1, 200) AS context_before, line
    FROM (SELECT *, s || ' ' || after AS c FROM (SELECT *, regexp_replace(regexp_replace(line, '^[—–]{_S}*', ''), '^{_S}+|{_S}+$', '', 'g') AS s, concat_ws(' ', nullif(lag(line, 2) OVER w, ''), nullif(lag(line) OVER w, '')) AS before, concat_ws(' ', nullif(lead(line) OVER w, ''), nullif(lead(line, 2) OVER w, '')) AS after
    FROM {_LINES} WINDOW w AS (PARTITION BY doc_id ORDER BY line_num))) WHERE regexp_matches(line, '^([—–]|-\\x{{00a0}})') AND length(s) >= 5)"""


@query("direct_speech", f"SELECT doc_id, line_num, speaker, md5(text) AS said, md5(context_before) AS before FROM {_SPEECH} WHERE length(text) >= 5")
def direct_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of speech with speakers, what is said, and what stood before."""
    return speech.direct_speech(_texts(spark, sf_dir), "doc_id").select("doc_id", "line_num", "speaker", F.md5("text").alias("said"), F.md5("context_before").alias("before"))


@query(
    "speech_pairs",
    f"""SELECT doc_id, line_num, md5(CASE WHEN asked_by <> 'Макс' AND asked <> '' THEN '[' || asked_by || ']: ' || asked WHEN context_before <> '' THEN '[Ситуация]: ' || context_before ELSE '[Продолжай разговор]' END) AS "user", md5(text) AS assistant
    FROM (SELECT *, lag(speaker) OVER w AS asked_by, lag(text) OVER w AS asked FROM {_SPEECH} WHERE length(text) >= 5 WINDOW w AS (PARTITION BY doc_id ORDER BY line_num)) WHERE speaker = 'Макс' AND length(text) >= 15""",
)
def speech_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrator's lines with what was said before them."""
    return speech.pairs_from_speech(speech.direct_speech(_texts(spark, sf_dir), "doc_id"), "doc_id").select("doc_id", "line_num", F.md5("user").alias("user"), F.md5("assistant").alias("assistant"))


_MARKS = (
    f"я{_S}+(подумал|решил|вздохнул|усмехнул|обрадовал|ужаснул|растерял|понял|вспомнил|представил|почувствовал)",
    f"мне{_S}+(казалось|хотелось|пришлось|стало|показалось|нравилось|было{_S}+страшно|было{_S}+стыдно|было{_S}+лень)",
    f"моя{_S}+(жизнь|судьба|голова)", f"к{_S}+счастью", f"к{_S}+сожалению", "впрочем", f"строго{_S}+говоря", f"на{_S}+самом{_S}+деле", f"честно{_S}+говоря", f"надо{_S}+же",
    f"боже{_S}+мой", f"грёбаные{_S}+магистры", f"хвала{_S}+магистрам", f"дырку({_B}|{_B}.*{_B})в{_S}+небе", "камр[уыа]",
)
_MONOLOGUES = f"""(SELECT * FROM (SELECT doc_id, line_num AS pos, line AS text, ({' + '.join(f"regexp_matches(line, '(?i)(^|{_B}){m}({_B}|$)')::INT" for m in _MARKS)})::INT AS marker_count,
    len(list_filter(regexp_split_to_array(lower(line), '{_B}+'), lambda x: x IN ('я', 'мне', 'мой', 'моя', 'моё', 'мою', 'моей', 'моих', 'меня', 'мной')))::INT AS first_person_count
    FROM {_LINES} WHERE length(line) >= 80 AND NOT regexp_matches(line, '^[—–]')) WHERE marker_count >= 1 OR first_person_count >= 3)"""


@query("monologues", f"SELECT doc_id, md5(text) AS said, marker_count, first_person_count FROM {_MONOLOGUES}")
def monologues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long paragraphs that sound like the narrator."""
    return speech.monologues(_texts(spark, sf_dir), "doc_id").select("doc_id", F.md5("text").alias("said"), "marker_count", "first_person_count")


@query(
    "monologue_pairs",
    f"""SELECT doc_id, md5('[Расскажи, что ты думаешь о: ' || substr(regexp_replace(regexp_split_to_array(text, '[.!?]')[1], '^{_S}+|{_S}+$', '', 'g'), 1, 100) || ']') AS "user", md5(text) AS assistant
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM {_MONOLOGUES}) WHERE k <= 500 AND length(text) BETWEEN 30 AND 1000""",
)
def monologue_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monologues asked about their first sentence; at most 500 of a text are used, which is the operator's own limit."""
    found = speech.pairs_from_monologues(speech.monologues(_texts(spark, sf_dir), "doc_id"), "doc_id")
    return found.select("doc_id", F.md5("user").alias("user"), F.md5("assistant").alias("assistant"))


_T = "regexp_replace(coalesce({0}, ''), '^\\s+|\\s+$', '', 'g')"


@query(
    "training_pairs",
    f"""SELECT conv_id, turn, md5(CASE WHEN kind IN ('dialogue', 'silent_speech') AND says <> '' THEN '[' || context || ']' || chr(10) || chr(10) || CASE WHEN kind = 'silent_speech' THEN '[Безмолвная речь] ' ELSE '' END || CASE WHEN other <> '' THEN other || ': ' ELSE '' END || says
        WHEN kind = 'monologue' AND context <> '' THEN '[' || context || ']' || chr(10) || chr(10) || 'Что ты об этом думаешь?' WHEN kind = 'silent_speech' AND context <> '' THEN '[' || context || ']' || chr(10) || chr(10) || '[Безмолвная речь] Что скажешь?'
        WHEN context <> '' THEN context ELSE 'Расскажи, что происходит.' END) AS "user", md5(answer) AS assistant
    FROM (SELECT conv_id, turn, coalesce([NULL, 'silent_speech', 'monologue', 'dialogue', 'scene'][conv_id % 5 + 1], 'dialogue') AS kind, CASE WHEN conv_id % 3 = 0 THEN '' ELSE {_T.format('asked_by')} END AS context, CASE WHEN conv_id % 4 = 0 THEN NULL ELSE asked_by END AS other,
        CASE WHEN conv_id % 7 = 0 THEN '' ELSE {_T.format('prompt')} END AS says, {_T.format('answer')} AS answer FROM ({_PAIRS})) WHERE length(answer) >= 10""",
)
def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as extracted dialogues of all kinds, with and without scenes and partners."""
    k, none = F.col("conv_id"), F.lit("")
    kind = F.element_at(F.array(F.lit(None).cast("string"), *map(F.lit, ("silent_speech", "monologue", "dialogue", "scene"))), (k % 5 + 1).cast("int"))
    pair = speech.training_pair(F.col("answer"), kind, F.when(k % 3 == 0, none).otherwise(F.col("asked_by")), F.when(k % 4 != 0, F.col("asked_by")), F.when(k % 7 == 0, none).otherwise(F.col("prompt")))
    rows = dialogues.lag_pairs(_table(spark, sf_dir, "conversations")).select("conv_id", "turn", pair.alias("x")).where("x is not null")
    return rows.select("conv_id", "turn", F.md5("x.user").alias("user"), F.md5("x.assistant").alias("assistant"))


@query("style_candidates", "SELECT conv_id, turn FROM conversations WHERE role = 'assistant' AND ((length(text) > 30 AND length(text) < 300) OR NOT EXISTS (SELECT 1 FROM conversations WHERE role = 'assistant' AND length(text) > 30 AND length(text) < 300))")
def style_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").where("role = 'assistant'").select("conv_id", "turn", "text")
    return speech.style_candidates(rows, "text").select("conv_id", "turn")


_HELD = "(SELECT 'b' || l_linenumber AS book, CASE WHEN l_returnflag = 'R' THEN 'main' ELSE l_returnflag END AS chapter, CASE WHEN l_quantity < 45 THEN l_suppkey * 3 END AS chunk_idx FROM lineitem WHERE l_linenumber <> 5)"


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as facts: line numbers as books, one of them nameless; numbers of suppliers as chunks."""
    book = F.when(F.col("l_linenumber") == 5, "  ").otherwise(F.concat(F.lit("b"), F.col("l_linenumber").cast("string")))
    chapter = F.when(F.col("l_returnflag") == "R", " main ").otherwise(F.col("l_returnflag"))
    return _table(spark, sf_dir, "lineitem").select(book.alias("book"), chapter.alias("chapter"), F.when(F.col("l_quantity") < 45, F.col("l_suppkey") * 3).alias("chunk_idx"))


@query("timeline_groups", f"SELECT book, chapter, count(*) AS n_facts, count(DISTINCT chunk_idx) AS n_chunks, min(chunk_idx) AS first_chunk FROM {_HELD} GROUP BY ALL")
def timeline_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.groups(_held(spark, sf_dir))


@query(
    "timeline_chunks",
    f"""SELECT book, chapter, idx, place FROM (SELECT book, chapter, idx, row_number() OVER (PARTITION BY book, chapter ORDER BY idx) AS place FROM (SELECT DISTINCT h.book, h.chapter, c.idx FROM {_HELD} h JOIN (SELECT DISTINCT 'b' || l_linenumber AS book, l_partkey AS idx FROM lineitem) c ON c.book = h.book AND c.idx IN (h.chunk_idx - 1, h.chunk_idx, h.chunk_idx + 1))) WHERE place <= 6""",
)
def timeline_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first six chunks that hold a chapter's facts or stand next to them; parts are read as a book's chunks."""
    chunks = _table(spark, sf_dir, "lineitem").select(F.concat(F.lit("b"), F.col("l_linenumber").cast("string")).alias("book"), F.col("l_partkey").alias("idx"))
    return timeline.group_chunks(_held(spark, sf_dir), chunks)


@query(
    "timeline_edges",
    """SELECT source, target, type, book, chapter, array_to_string(chunk_indices, ',') AS chunk_indices, evidence, confidence FROM (SELECT *, row_number() OVER (PARTITION BY source, target, type, book, chapter, chunk_indices ORDER BY event_id) AS k
    FROM (SELECT event_id, event_type AS source, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS target, ['before', 'occurs_in', 'related_to'][event_id % 3 + 1] AS type, 'b' || user_id % 5 AS book, '' AS chapter, list_sort([user_id % 4, 1]) AS chunk_indices, trim(props) AS evidence, CASE WHEN event_id % 2 = 0 THEN 'explicit' ELSE 'inferred' END AS confidence FROM events)
    WHERE source <> target AND source <> '' AND target <> '') WHERE k = 1""",
)
def timeline_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring events of users as edges, doubles dropped."""
    pick = lambda *values: F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % len(values) + 1).cast("int"))
    rows = _table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("source"),
        F.expr("lead(event_type) over (partition by user_id order by event_id)").alias("target"),
        pick("Before", "occurs in", "likes").alias("type"),
        F.concat(F.lit("b"), (F.col("user_id") % 5).cast("string")).alias("book"),
        F.lit("").alias("chapter"),
        F.array(F.col("user_id") % 4, F.lit(1).cast("long")).alias("chunk_indices"),
        F.concat(F.lit(" "), "props", F.lit(" ")).alias("evidence"),
        pick("", " inferred ").alias("confidence"),
    )
    return timeline.unique_edges(rows, "event_id").withColumn("chunk_indices", F.array_join("chunk_indices", ","))


@query(
    "best_models",
    """WITH r AS (SELECT o_custkey AS ord, 'm' || o_custkey AS model, round(sum(o_totalprice), 2) AS quality, round(sum(o_totalprice) / count(*), 2) AS quality_speed, CASE WHEN o_custkey % 3 = 0 THEN 0.5 ELSE 1.0 END AS offload FROM orders GROUP BY o_custkey HAVING o_custkey % 10 <> 0),
    p AS (SELECT (SELECT model FROM r WHERE offload >= 0.99 ORDER BY quality_speed DESC, ord LIMIT 1) AS fast, (SELECT model FROM r ORDER BY quality DESC, ord LIMIT 1) AS best, (SELECT model FROM r ORDER BY quality DESC, ord LIMIT 1 OFFSET 1) AS second)
    SELECT 'speed' AS pick, fast AS model FROM p UNION ALL SELECT 'quality', best FROM p UNION ALL SELECT 'second', CASE WHEN fast <> best THEN best ELSE second END FROM p""",
)
def best_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers read as models: sums of orders as quality, their means as speed; each tenth has no hits."""
    rows = _table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("ord")).agg(F.count("*").alias("n_cases"), F.round(F.sum("o_totalprice"), 2).alias("quality"), F.round(F.sum("o_totalprice") / F.count("*"), 2).alias("quality_speed"))
    rows = rows.withColumns({"model": F.concat(F.lit("m"), F.col("ord").cast("string")), "hit_rate": F.when(F.col("ord") % 10 == 0, 0.0).otherwise(1.0), "offload": F.when(F.col("ord") % 3 == 0, 0.5).when(F.col("ord") % 3 == 1, 1.0)})
    return metrics.best_models(rows)


@query("run_stats", "SELECT user_id AS run_id, count(*) AS n, max(ts) AS latest_at FROM events GROUP BY user_id")
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_stats(_table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("ts").alias("at")))


@query(
    "applied_log",
    """WITH o AS (SELECT user_id::VARCHAR AS entity_id, CASE WHEN event_type <> 'error' THEN event_type END AS after, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE event_id % 11 <> 0 AND user_id % 4 <> 0),
    b AS (SELECT DISTINCT user_id::VARCHAR AS entity_id, 'base' AS record FROM events WHERE user_id % 3 <> 0)
    SELECT entity_id, CASE WHEN o.entity_id IS NULL THEN record ELSE after END AS record FROM b FULL JOIN (SELECT * FROM o WHERE k = 1) o USING (entity_id) WHERE CASE WHEN o.entity_id IS NULL THEN record ELSE after END IS NOT NULL""",
)
def applied_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log over two thirds of the users' base records; some operations lack an id, some an entity."""
    events = _table(spark, sf_dir, "events")
    base = events.where("user_id % 3 <> 0").select(F.col("user_id").cast("string").alias("entity_id"), F.lit("base").alias("record")).distinct()
    op_id, entity = F.when(F.col("event_id") % 11 != 0, F.lpad(F.col("event_id").cast("string"), 20, "0")), F.when(F.col("user_id") % 4 != 0, F.col("user_id").cast("string")).otherwise("")
    return review.applied(base, events.select(op_id.alias("op_id"), "ts", entity.alias("entity_id"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("after")))


@query(
    "record_updates",
    """SELECT doc_id, source AS before_source, CASE WHEN doc_id % 2 = 0 THEN 'q' || quality ELSE source END AS source, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS lang, CASE WHEN doc_id % 5 = 0 THEN 'a,b' ELSE 'old' END AS themes FROM documents JOIN labels USING (doc_id)""",
)
def record_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as patches of documents; a field that may not be patched is among them."""
    state = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("entity_id"), "source", "lang", F.array(F.lit("old")).alias("theme_ids"))
    k = F.col("doc_id")
    source = F.when(k % 2 == 0, F.create_map(F.lit("source"), F.concat(F.lit(" q"), F.col("quality").cast("string"), F.lit(" ")))).otherwise(F.create_map(F.lit("other"), F.lit("x")))
    lang = F.when(k % 3 == 0, F.create_map(F.lit("lang"), F.lit("  "))).otherwise(F.create_map(F.lit("id"), F.lit("y")))
    patches = _table(spark, sf_dir, "labels").select(k.alias("entity_id"), F.map_concat(source, lang).alias("patch"), F.when(k % 5 == 0, F.array(*map(F.lit, "aba"))).alias("theme_ids"))
    out = review.updates(state, patches, ["source", "lang"])
    return out.select(F.col("entity_id").alias("doc_id"), F.col("before.source").alias("before_source"), F.col("after.source").alias("source"), F.col("after.lang").alias("lang"), F.array_join("after.theme_ids", ",").alias("themes"))


@query("relations_of", "SELECT s_suppkey AS fact_id, l_orderkey, l_linenumber FROM supplier JOIN lineitem ON l_suppkey = s_suppkey OR l_partkey = s_suppkey")
def relations_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as relations between suppliers and parts, at either end of each supplier's number."""
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("target"), "l_orderkey", "l_linenumber")
    return review.relations_of(rows, _table(spark, sf_dir, "supplier").select("s_suppkey")).select("fact_id", "l_orderkey", "l_linenumber")


@query(
    "linked_rows",
    "SELECT conv_id, place, doc_id, lang FROM (SELECT conv_id, unnest([conv_id % 100, -1, conv_id % 7, conv_id % 100]) AS doc_id, unnest([0, 1, 2, 3]) AS place FROM (SELECT DISTINCT conv_id FROM conversations)) JOIN documents USING (doc_id)",
)
def linked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that conversations name in lists, one of them unknown and one named twice."""
    ids = F.array(F.col("conv_id") % 100, F.lit(-1).cast("long"), F.col("conv_id") % 7, F.col("conv_id") % 100)
    samples = _table(spark, sf_dir, "conversations").select("conv_id").distinct().withColumn("ids", ids)
    return review.linked(samples, "conv_id", "ids", _table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").select("conv_id", "place", "doc_id", "lang")


_FACT_LINE = "trim(regexp_replace(replace(coalesce(text, ''), '|', '/'), '\\s+', ' ', 'g'))"


@query(
    "suggestions",
    f"""SELECT doc_id, 1 AS line_no, 'keep' AS action, doc_id::VARCHAR AS fact_id, lang AS category, source AS subject, {_FACT_LINE} AS fact, 'past' AS time_scope, 'why|so' AS reason FROM documents
    UNION ALL SELECT doc_id, 3, 'drop', doc_id::VARCHAR, NULL, NULL, NULL, NULL, source || '|' || lang FROM documents WHERE doc_id % 2 = 0""",
)
def suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a review made from whole documents: a fact to keep, lines that say nothing, every second time one to drop."""
    fact, key = F.trim(F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), "|", "/"), r"\s+", " ")), F.col("doc_id").cast("string")
    keep = F.concat_ws("|", F.lit(" Keep "), key, F.concat("lang", F.lit(" ")), "source", fact, F.lit(" past "), F.lit("why "), F.lit("so"))
    drop = F.when(F.col("doc_id") % 2 == 0, F.concat_ws(" | ", F.lit("DROP"), key, "source", "lang")).otherwise("drop|1")
    return review.suggestions(_table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("\n", F.lit("Here you are:"), keep, F.lit("keep|1|x"), drop).alias("text")), "text")


@query(
    "appended_turns",
    """SELECT conv_id, turn FROM conversations WHERE conv_id % 2 = 0 UNION ALL SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY role, text ORDER BY conv_id, turn) AS k FROM conversations c WHERE conv_id % 2 = 1
    AND NOT EXISTS (SELECT 1 FROM conversations e WHERE e.conv_id % 2 = 0 AND e.role = c.role AND e.text = c.text)) WHERE k = 1""",
)
def appended_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of odd conversations appended to those of even ones unless their role and text are known."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return review.appended(turns.where("conv_id % 2 = 0"), turns.where("conv_id % 2 = 1"), ["role", "text"], ["conv_id", "turn"]).select("conv_id", "turn")


_SILENT_OPENS = ("Я услышал зов: «Джуффин здесь» и ", "Он сказал: «Пойдем домой» ", "", "Мелифаро мысленно ответил: «", "«Зовите всех» и «зовите ВСЕХ» ")
_SILENT_CLOSES = ("", "», — подумал я", " «Опять зов»", "»")
_SILENT = f"""(WITH l AS (SELECT doc_id, k - 1 AS line_num, regexp_replace(raw, '^{_S}+|{_S}+$', '', 'g') AS line FROM (SELECT doc_id, k,
        ['Я услышал зов: «Джуффин здесь» и ', 'Он сказал: «Пойдем домой» ', '', 'Мелифаро мысленно ответил: «', '«Зовите всех» и «зовите ВСЕХ» '][(doc_id + k - 1) % 5 + 1] || l[k] || ['', '», — подумал я', ' «Опять зов»', '»'][(doc_id + k - 1) % 4 + 1] AS raw
        FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))),
    c AS (SELECT *, concat_ws(' ', line, lag(line) OVER w, lead(line) OVER w) AS c FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY line_num)),
    q AS (SELECT doc_id, line_num, c, line, unnest(regexp_extract_all(line, '«([^»]{{5,300}})»', 1)) AS text, generate_subscripts(regexp_extract_all(line, '«([^»]{{5,300}})»', 1), 1) AS k FROM c WHERE length(line) >= 10
        AND regexp_matches(c, '[Бб]езмолвн|[Зз]ов({_B}|$)|послал[аи]?{_S}+зов|мысленно|подумал[аи]?{_S}+я|услышал{_S}+я{_S}+(его|её|их){_S}+голос|прозвучал{_S}+(в|у){_S}+(моей|моём){_S}+голов'))
    SELECT doc_id, line_num, CASE WHEN regexp_matches(c, '(подумал|сказал|ответил|послал){_S}+я|мой{_S}+зов|я{_S}+послал') THEN 'Макс' WHEN contains(c, 'Джуффин') THEN 'Джуффин' WHEN contains(c, 'Мелифаро') THEN 'Мелифаро' END AS speaker, text, substr(line, 1, 200) AS context
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(text) ORDER BY line_num, k) AS n FROM q) WHERE n = 1)"""


def _silent(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))
    told = F.transform(F.split("text", "\n"), lambda x, i: F.concat(pick(_SILENT_OPENS, F.col("doc_id") + i), x, pick(_SILENT_CLOSES, F.col("doc_id") + i)))
    return speech.silent_speech(_table(spark, sf_dir, "documents").select("doc_id", F.array_join(told, "\n").alias("text")), "doc_id")


@query("silent_speech", f"SELECT doc_id, line_num, speaker, md5(text) AS said, md5(context) AS context FROM {_SILENT}")
def silent_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silent(spark, sf_dir).select("doc_id", "line_num", "speaker", F.md5("text").alias("said"), F.md5("context").alias("context"))


@query("silent_pairs", f"""SELECT doc_id, line_num, md5('[Безмолвная речь] ' || context) AS "user", md5(text) AS assistant FROM {_SILENT} WHERE speaker = 'Макс' AND length(text) >= 15""")
def silent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speech.pairs_from_silent(_silent(spark, sf_dir), "doc_id").select("doc_id", "line_num", F.md5("user").alias("user"), F.md5("assistant").alias("assistant"))


@query(
    "book_modes",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Меламори Блимм' WHEN 2 THEN '_сборник' ELSE 'Макс' END AS narrator, CASE doc_id % 4 WHEN 0 THEN 'knowledge_only' WHEN 1 THEN 'voice_only' WHEN 2 THEN 'knowledge_raw' ELSE 'full' END AS mode FROM documents""",
)
def book_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources read as files of known and unknown books."""
    name = F.element_at(F.array(*map(F.lit, (" Чуб земли.fb2", "Мой Рагнарёк, чашка Фрая", "Жалобная КНИГА", "other.txt"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return _table(spark, sf_dir, "documents").select("doc_id", names.book_mode(F.concat("source", name)).alias("x")).select("doc_id", "x.narrator", "x.mode")


@query(
    "chunk_headings",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Глава 1. Начало' WHEN doc_id % 4 = 2 THEN 'XIV.' ELSE coalesce(list_filter(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda p: regexp_replace(p, '^\\s+|\\s+$', '', 'g')), lambda p: p <> '')[1:CASE WHEN doc_id % 4 = 1 THEN 6 ELSE 0 END],
        lambda p: length(p) <= 120 AND (regexp_matches(p, '(?i)^([ivxlcdm]+|[0-9]+)[.)]?$') OR (length(regexp_replace(p, '[^A-Za-zА-Яа-яЁё]', '', 'g')) >= 4 AND upper(regexp_replace(p, '[^A-Za-zА-Яа-яЁё]', '', 'g')) = regexp_replace(p, '[^A-Za-zА-Яа-яЁё]', '', 'g'))))[1], '') END AS heading FROM documents""",
)
def chunk_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks: with a heading after a scene break, with a number, as they are, and with one too far down."""
    opens = F.element_at(F.array(*map(F.lit, ("***\n\nГлава 1. Начало\n\n", "", "[[SECTION_BREAK]]\n \nXIV.\n\n", "a,\n\nb,\n\ne,\n\nf,\n\ng,\n\nh,\n\nПролог\n\n"))), (F.col("doc_id") % 4 + 1).cast("int"))
    chunk = F.concat(opens, F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit("\n\n")))
    return _table(spark, sf_dir, "documents").select("doc_id", chunk_heading(chunk).alias("heading"))
