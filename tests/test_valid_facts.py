"""Facts rejected by the first rule that they break."""

import re

from corpuskb.functions import canon, fact_rules, facts
from corpuskb.operators import valid_facts
from corpuskb.plans import registry
from test_canonical import is_general
from test_same_facts import canonical, norm, subject_of

DATA = "/root/testdata/sf0.001"

CASES = [
    ("character", "Ирма", "Коротко", None, "short_fact"),
    ("character", "И", "Ирма живет в старой башне.", None, "short_subject"),
    ("weather", "Ирма", "Ирма живет в старой башне.", None, "bad_category"),
    (None, "Ирма", "Ирма живет в старой башне.", None, "bad_category"),
    ("Персонаж", "Ирма", "Ирма живет в старой башне.", None, None),
    ("location_name", "Старая башня", "Старая башня охраняет мост.", None, None),
    ("custom", "Меламори", "Меламори носит шляпу каждый день.", None, "placeholder_subject"),
    ("character", "Два друга", "Два друга часто ездят вместе.", None, "placeholder_subject"),
    ("place", "дверь в сад", "Дверь ведет прямо в старый сад.", None, "placeholder_subject"),
    ("place", "Королевский двор", "Королевский двор", None, "generic_fact"),
    ("custom", "Телефон", "В тексте не упоминается.", None, "generic_fact"),
    ("custom", "Телефон", "Телефон это редкая вещь", None, "generic_fact"),
    ("creature", "Кошка", "Кошка, возможно, живет в доме.", None, "generic_fact"),
    ("magic", "Безмолвная речь", "Безмолвная речь собаки передала Максу тревогу.", None, "too_local_fact"),
    ("magic", "Безмолвная речь", "Безмолвная речь — обычный способ общения на расстоянии.", None, None),
    ("event", "Обед у короля", "Обед у короля длился три часа.", None, "too_local_fact"),
    ("character", "Ирма", "Ирма спросила о погоде и ушла.", None, "too_local_fact"),
    ("custom", "пояс", "Пояса, которые носил убитый, не делают нигде.", None, "too_local_fact"),
    ("character", "Джуффин", "Шурф Лонли-Локли любит порядок.", None, "subject_fact_mismatch"),
    ("character", "Шурф", "Сэр Лонли-Локли любит порядок.", None, None),
    ("place", "Новая Гавань", "Новая Гавань лежит у моря.", "Мы шли вдоль реки и видели мосты.", "ungrounded_subject"),
    ("place", "Новая Гавань", "Новая Гавань лежит у теплого моря.", "Мы пришли в новую гавань и видели мосты.", "ungrounded_fact"),
    ("place", "Новая Гавань", "Новая Гавань лежит у теплого моря.", "Новая гавань, так зовут город, что лежит у моря.", None),
    ("character", "Макс", "Макс любит старые мосты.", "Мне нравятся старые мосты, я их люблю.", None),
    ("place", "Новая Гавань", "Новая Гавань лежит у теплого моря.", "[PRIMARY CHUNK #1]\nНовая гавань спит.\n\n[SUPPORTING CONTEXT]\nОна лежит у теплого моря.", "ungrounded_fact"),
    ("place", "Новая Гавань", "Новая Гавань лежит у теплого моря.", "", None),
]


def test_each_rule_in_its_turn(spark):
    chunks = spark.createDataFrame([(k, c[3]) for k, c in enumerate(CASES)], "chunk_id long, text string").withColumn("fact", facts.F.lit(1))
    rows = [(k, *c[:3], "") for k, c in enumerate(CASES)] + [(900, "place", "Новая Гавань", "Новая Гавань лежит у теплого моря.", "now"), (None, None, None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "chunk_id long, category string, subject string, fact string, time_scope string").selectExpr("*", "1 as text", "2 as keys")
    got = valid_facts.validate(df, chunks).collect()
    assert len(got) == len(rows)
    assert {r.chunk_id: r.reason for r in got if r.chunk_id is not None and r.chunk_id < 900} == {k: c[4] for k, c in enumerate(CASES)}
    assert [(r.reason, r.time_scope) for r in got if r.chunk_id == 900] == [(None, "current")] and [r.reason for r in got if r.chunk_id is None] == ["short_fact"] * 2
    assert {r.reason: r.n for r in valid_facts.rejections(valid_facts.validate(df, chunks)).collect()}["short_fact"] == 3
    assert valid_facts.validate(df.limit(0), chunks).count() == 0
    free = {r.chunk_id: r.reason for r in valid_facts.validate(df).collect()}
    assert free[20] is None and free[21] is None and free[18] == "subject_fact_mismatch"


def stem(t):
    if len(t) <= 4:
        return t
    return next((t[: -len(e)] for e in facts.STEM_ENDINGS if t.endswith(e) and len(t) - len(e) >= 4), t)


def keys_of(text):
    words = [w for w in norm(text).split() if len(w) >= 3]
    return set(words) | {stem(w) for w in words if len(stem(w)) >= 4}


def plain_reason(category, subject, fact, text):
    category, subject, fact = (category or "").strip().lower(), (subject or "").strip(), (fact or "").strip()
    n, s = norm(fact), norm(subject)
    if len(fact) < 10:
        return "short_fact"
    if len(subject) < 2:
        return "short_subject"
    if category not in fact_rules.CATEGORIES:
        return "bad_category"
    character = canonical(subject) or subject_of(subject).split()[:1] and (subject_of(subject).split()[0] in facts.HONORIFICS or subject_of(subject) in canon.SINGLE_NAMES)
    if (category == "custom" and character) or is_general(subject, category, ""):
        return "placeholder_subject"
    ignored = {*facts.STOPWORDS, *facts.SUBJECT_NOISE} | ({*facts.PLACE_HEADS.values(), *canon.PLACE_PARTS} if category == "place" else set())
    own = [w for w in s.split() if len(w) >= 3 and w not in ignored]
    keys = keys_of(text)
    met = lambda w: len(w) >= 3 and (w in keys or (len(stem(w)) >= 4 and stem(w) in keys))
    if norm(text):
        u = subject_of(subject)
        told = u in ("макс", "макс фрай") and re.search(fact_rules.FIRST_PERSON, norm(text))
        grounded = u and (told or f" {u} " in f" {norm(text)} " or not keys or (own and sum(map(met, own)) >= (1 if len(own) <= 2 else 2)))
        if not grounded:
            return "ungrounded_subject"
        words = {w for w in n.split() if len(w) >= 3 and w not in facts.STOPWORDS}
        words = words - set(own) or words
        k = len(words)
        need = 1 if k == 1 else 2 if k <= 4 else max(2, k // 3 if category == "event" else (k + 1) // 2)
        if keys and k and sum(map(met, words)) < need:
            return "ungrounded_fact"
    first = [w for w in n.split() if w not in facts.STOPWORDS and w not in facts.HONORIFICS][:4]
    if category in fact_rules.ANCHORED and own and first and not {stem(w) for w in first[:2]} & {stem(w) for w in own}:
        names = {canonical(" ".join(first[:k])) for k in (1, 2, 3) if len(first) >= k} - {None, canonical(subject) or subject_of(subject)}
        if names:
            return "subject_fact_mismatch"
    begins = lambda text, patterns: any(re.match(p, text) for p in patterns)
    has = lambda patterns: any(re.search(r"\b" + p, n) for p in patterns)
    if not n or (s and (n == s or n.startswith(s + " это "))) or begins(n, fact_rules.EMPTY_BEGINNINGS) or has(fact_rules.EMPTY_WORDS):
        return "generic_fact"
    passing = {
        "character": lambda: has(fact_rules.PASSING_CHARACTERS) or begins(n, fact_rules.PASSING_CHARACTER_BEGINNINGS),
        "place": lambda: s in {*canon.GENERIC_PLACES, *fact_rules.PASSING_ROOMS, *fact_rules.PASSING_PLACES},
        "magic": lambda: s == fact_rules.PASSING_MAGIC_SUBJECT and has(fact_rules.PASSING_MAGIC),
        "custom": lambda: has(fact_rules.PASSING_CUSTOMS),
        "event": lambda: begins(s, fact_rules.PASSING_EVENT_SUBJECTS) or has(fact_rules.PASSING_EVENTS) or begins(n, fact_rules.PASSING_EVENT_BEGINNINGS),
    }
    if s in fact_rules.PASSING_SUBJECTS or has(fact_rules.PASSING) or passing.get(category, lambda: False)():
        return "too_local_fact"
    return None


def test_query_over_documents(spark):
    from corpuskb.plans.validated import sourced_facts

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.ord: r.reason for r in registry.QUERIES["valid_facts"](spark, DATA).collect()}
    want = {r.ord: plain_reason(r.category, r.subject, r.fact, texts.get(r.chunk_id, "")) for r in sourced_facts(spark, DATA).collect()}
    assert got == want and len(set(want.values())) >= 5


def test_texts_are_not_copied_for_each_of_their_facts(spark, monkeypatch):
    """What is dealt out is about as long as both tables, also where a chunk's facts go to several parts."""
    monkeypatch.setattr(valid_facts, "_PART", 40)
    text = " ".join(f"слово{k}" for k in range(3000))
    facts_ = spark.range(0, 200).selectExpr("cast(1 as int) as chunk_id", "'place' as category", "concat('Место слово', id) as subject", "concat('слово', id, ' слово', id + 1, ' слово', id + 2) as fact", "'' as time_scope")
    chunks = spark.createDataFrame([(1, text), (2, "пусто")], "chunk_id long, text string")
    looked_up = valid_facts._looked_up
    made = spark.sparkContext.accumulator(0)

    def watched(batches):
        def passing():
            for batch in batches:
                made.add(sum(len(t.as_py() or "") for t in batch.column("_text")))
                yield batch

        yield from looked_up(passing())

    monkeypatch.setattr(valid_facts, "_looked_up", watched)
    got = valid_facts.validate(facts_, chunks).collect()
    assert len(got) == 200 and {r.reason for r in got} == {None}
    assert len(text) <= made.value <= 7 * len(text)
