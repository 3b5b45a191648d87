"""Operators that SQL can't express, against plain loops on small fixtures."""

import datetime
import difflib
import itertools
import random
import zipfile

from pyspark.sql import functions as F

from corpuskb.functions.text import canonical_book_name, duration
from corpuskb.functions import facts
from corpuskb.operators import chunks, dialogues, knowledge, metrics, review, speech, timeline
from corpuskb.sources import files
from corpuskb.streaming import event_log


def test_packing_is_greedy_and_whole(spark):
    texts = ["", None, "a" * 30, "\n".join("x" * n for n in (3, 9, 4, 25, 2, 2, 8)), " one \n\n two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in chunks.packed(docs, 20).orderBy("doc_id", "idx").collect():
        found.setdefault(r["doc_id"], []).append(r["chunk_text"])
    for k, text in enumerate(texts):
        want: list[str] = []
        for p in filter(None, (x.strip() for x in (text or "").split("\n"))):
            if want and len(want[-1]) + 2 + len(p) <= 20:
                want[-1] += "\n\n" + p
            else:
                want.append(p)
        assert found.get(k, []) == want


def test_fuzzy_pairs_keep_the_first(spark):
    texts = ["the quick brown fox jumps", "the quick brown fox jumped", "something else at all", None, "", "the quick brown fox jumps", "x"]
    rows = [(g, k, t) for g in ("a", "b") for k, t in enumerate(texts)]
    found = dialogues.fuzzy_first(spark.createDataFrame(rows, "g string, k int, t string"), "g", "t", ["k"])
    kept: list[tuple[int, str]] = []
    for k, t in enumerate(x or "" for x in texts):
        if not any(abs(len(t) - len(o)) <= 0.3 * max(len(t), 1) and difflib.SequenceMatcher(None, t, o).ratio() > 0.85 for _, o in kept):
            kept.append((k, t))
    assert sorted((r["g"], r["k"]) for r in found.collect()) == sorted((g, k) for g in ("a", "b") for k, _ in kept)


def test_fuzzy_pairs_across_conversations(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcde ") for _ in range(40)) for _ in range(8)]
    rows = []
    for k in range(90):
        t = list(rng.choice(texts))
        for _ in range(rng.randrange(6)):
            t[rng.randrange(len(t))] = rng.choice("abcde ")
        rows.append((k // 4, k % 4, rng.choice([None, "", "".join(t), "".join(t), "".join(t), "".join(t)])))
    kept, want = [], []
    for c, k, t in rows:
        t = t or ""
        if not any(abs(len(o) - len(t)) <= 0.3 * len(t) and difflib.SequenceMatcher(None, o, t).ratio() > 0.85 for o in kept[-3:]):
            kept.append(t)
            want.append((c, k))
    df = spark.createDataFrame(rows, "conv_id long, turn int, answer string")
    df = df.withColumn("h", F.md5(F.lit("x")))
    found = dialogues.fuzzy_first_overall(df, "answer", ["conv_id", "turn"], 3, parts=5)
    assert sorted((r["conv_id"], r["turn"]) for r in found.collect()) == want


def test_fuzzy_ratio_has_the_kept_text_first(spark):
    old, new = next((a, b) for a in map("".join, itertools.product("abc", repeat=5)) for b in map("".join, itertools.product("abc", repeat=5)) if difflib.SequenceMatcher(None, a, b).ratio() > difflib.SequenceMatcher(None, b, a).ratio())
    least = difflib.SequenceMatcher(None, new, old).ratio()
    found = dialogues.fuzzy_first(spark.createDataFrame([("g", 0, old), ("g", 1, new)], "g string, k int, t string"), "g", "t", ["k"], ratio=least)
    assert [r["k"] for r in found.collect()] == [0]


def test_facts_of_different_states_stay(spark):
    rows = [(0, "Лина", "живет в башне у реки", "current"), (1, "Лина", "живет в башне у реки", "past"), (2, "лина", "Живет в башне у реки!", "current"), (3, "Лина", "живет в башне у рек", "unclear"), (4, "Марк", "страж", "unclear")]
    found = knowledge.first_facts(spark.createDataFrame(rows, "ord int, subject string, fact string, scope string"))
    assert sorted(r["ord"] for r in found.collect()) == [0, 1, 4]


def test_line_protocol(spark):
    text = "1. category=place | subject=Bridge | fact=It stands | time_scope=current\nhistory | Mark | was a guard | past\nno fields here\n- category: event | subject: Lina | fact: came"
    found = knowledge.parse_lines(spark.createDataFrame([(1, text), (2, None)], "resp_id int, response string")).orderBy("line_no").collect()
    assert [tuple(r)[2:] for r in found] == [("place", "Bridge", "It stands", "current"), ("history", "Mark", "was a guard", "past"), ("event", "Lina", "came", None)]


def test_speech_lines(spark):
    told = "Он вошел.\n\n— Привет, друг! — сказал Джон Смит. — Как дела?..\n— Да\nТихо.\n-\u00a0Хорошо, — ответил я.\nКонец"
    texts = spark.createDataFrame([(1, told), (2, None), (3, "")], "doc_id long, text string")
    found = speech.direct_speech(texts, "doc_id")
    assert [tuple(r)[:5] for r in found.orderBy("line_num").collect()] == [
        (1, 2, "Джон Смит", "Привет, друг! Как дела?", "Он вошел."),
        (1, 5, "Макс", "-\u0020Хорошо,", "— Да Тихо."),
    ]
    assert speech.pairs_from_speech(found, "doc_id").count() == 0
    long = found.withColumn("text", F.rpad("text", 20, "!"))
    assert [tuple(r) for r in speech.pairs_from_speech(long, "doc_id").collect()] == [(1, 5, "[Джон Смит]: Привет, друг! Как де", "-\u0020Хорошо,!!!!!!!!!!!")]


def test_monologues_and_their_pairs(spark):
    own = "Честно говоря, мне было страшно. " + "Никто не пришел, и долгая ночь шла своим чередом до самого утра."
    texts = spark.createDataFrame([(1, own + "\n\n" + "x" * 100 + "\n— " + own), (2, None), (3, "я")], "doc_id long, text string")
    found = speech.monologues(texts, "doc_id")
    assert [tuple(r) for r in found.collect()] == [(1, 0, own, 2, 1)]
    assert [tuple(r) for r in speech.pairs_from_monologues(found, "doc_id").collect()] == [(1, 0, "[Расскажи, что ты думаешь о: Честно говоря, мне было страшно]", own)]


def test_style_candidates_fall_back_to_all(spark):
    rows = spark.createDataFrame([("short",), (None,)], "text string")
    assert speech.style_candidates(rows, "text").count() == 2
    assert speech.style_candidates(rows.union(spark.createDataFrame([("y" * 31,)], "text string")), "text").count() == 1


def test_timeline_groups_and_edges(spark):
    facts = spark.createDataFrame([("b.txt", "", 3), ("b.txt", "", 3), ("b.txt", " one ", None), ("", "one", 1), (None, None, 2)], "book string, chapter string, chunk_idx long")
    assert sorted(tuple(r)[2:] for r in timeline.groups(facts).collect()) == [(1, 0, None), (2, 1, 3)]
    chunks = spark.createDataFrame([("b.txt", k) for k in range(9)], "book string, idx long")
    assert sorted((r["idx"], r["place"]) for r in timeline.group_chunks(facts, chunks, 4, 6).collect()) == [(k, k + 1) for k in range(6)]
    edges = [(1, "a", "b", "Before", [2, 1], " x ", ""), (2, "a", "b", "before", [1, 2], "y", "inferred"), (3, "a", "a", "before", None, "", ""), (4, "a", "", "before", None, "", ""), (5, "a", "b", "nothing", None, None, None)]
    rows = spark.createDataFrame(edges, "n long, source string, target string, type string, chunk_indices array<bigint>, evidence string, confidence string").withColumns({"book": F.lit("b"), "chapter": F.lit("")})
    found = sorted((r["type"], r["chunk_indices"], r["evidence"], r["confidence"]) for r in timeline.unique_edges(rows, "n").collect())
    assert found == [("before", [1, 2], "x", "explicit"), ("related_to", [], "", "explicit")]


def test_best_models_of_one_and_of_none(spark):
    rows = spark.createDataFrame([(1, "m", 3, 1.0, None, 0.5, 0.5), (2, "n", 0, 1.0, 1.0, 9.0, 9.0)], "ord int, model string, n_cases int, hit_rate double, offload double, quality_speed double, quality double")
    assert [tuple(r) for r in metrics.best_models(rows).collect()] == [("speed", "m"), ("quality", "m")]
    assert metrics.best_models(rows.where("n_cases = 0")).count() == 0


def test_undo_appends_the_inverse_of_the_latest_operation_of_all(spark):
    at = datetime.datetime(2024, 1, 1)
    ops = spark.createDataFrame([("1", at, "x", None, "pending"), ("2", at, "x", "pending", "approved"), ("3", at, "y", None, "pending"), ("4", at, "y", "pending", None)], "op_id string, ts timestamp, entity_id string, before string, after string")
    state = lambda log: {r["entity_id"]: r["after"] for r in review.replay(log).collect()}
    undone = review.undo_last(ops, lambda op: F.concat(op, F.lit("u")))
    assert state(ops) == {"x": "approved"} and state(undone) == {"x": "approved", "y": "pending"}
    again = review.undo_last(undone, lambda op: F.concat(op, F.lit("u")))
    assert again.count() == 6 and state(again) == state(ops)
    assert review.undo_last(ops.limit(0), lambda op: op).count() == 0


def test_books_are_read_and_flattened(spark, tmp_path):
    body = "<FictionBook><body><section><title><p>One</p></title><p>a <emphasis>b</emphasis> c</p><p>" + "d" * 120 + '</p></section></body><body name="notes"><p>note</p></body></FictionBook>'
    (tmp_path / "a.txt").write_text("word " * 40)
    (tmp_path / "short.txt").write_text("word")
    (tmp_path / "b.fb2").write_text(body)
    with zipfile.ZipFile(tmp_path / "c.fb2.zip", "w") as z:
        z.writestr("c.fb2", body)
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    found = {r["book"].rpartition("/")[2]: r["text"] for r in files.read_books(spark, f"file://{tmp_path}").collect()}
    assert found.keys() == {"a.txt", "b.fb2", "c.fb2.zip"} and found["b.fb2"] == found["c.fb2.zip"] == "One\n\na b c\n\n" + "d" * 120


def test_measurements_skip_what_is_no_number(spark, tmp_path):
    (tmp_path / "gpu.csv").write_text("util [%], power [W]\n10 %, [N/A]\n30 %, 5.5\n")
    found = {r["metric"]: (r["n"], r["least"], r["mean"], r["most"]) for r in files.measurements(spark, f"file://{tmp_path}/gpu.csv").collect()}
    assert found == {"util [%]": (2, 10.0, 20.0, 30.0), "power [W]": (1, 5.5, 5.5, 5.5)}


def test_stream_equals_batch_up_to_the_watermark(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(f"file://{tmp_path}/log")
    counts = event_log.windowed_counts(event_log.read_log(spark, f"file://{tmp_path}/log", events.schema))
    event_log.run_once(counts, f"file://{tmp_path}/out", f"file://{tmp_path}/state").awaitTermination()
    got = {(r["window_start"], r["event_type"]): r["n"] for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    want = {(r["window_start"], r["event_type"]): r["n"] for r in event_log.windowed_counts(events).collect()}
    assert got and got.items() <= want.items()


def test_names_and_durations(spark):
    row = spark.range(1).select(canonical_book_name(F.lit("a/b.fb2.zip")), duration(F.lit(59)), duration(F.lit(61)), duration(F.lit(3661))).first()
    assert tuple(row) == ("a/b", "59s", "1m01s", "1h01m01s")


def test_parse_errors_are_counted_as_lines(spark):
    text = "# head\n- category=place | subject=x | fact=y\ncategory=place | subject=x\n[list]\n{object}\nplain words\n\n2) category=a | fact=b"
    rows = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    assert [r[0] for r in rows.select(metrics.parse_errors(F.col("t"))).collect()] == [2, 0, 0]


def test_signals_need_all_their_words_in_one_fact(spark):
    found = spark.createDataFrame([(1, "Сэр Макс", "Он живёт (там) в доме"), (1, "Дом", "стоит"), (2, None, None)], "case_id int, subject string, fact string")
    signals = spark.createDataFrame([(1, 1, ["макс"], ["живет", "доме"]), (1, 2, ["макс"], ["стоит"]), (2, 1, [], []), (3, 1, ["x"], [])], "case_id int, n int, subject_tokens array<string>, fact_tokens array<string>")
    assert {(r["case_id"], r["n"]): r["hit"] for r in metrics.signal_hits(found, signals).collect()} == {(1, 1): True, (1, 2): False, (2, 1): False, (3, 1): False}


def test_places_lose_prepositions_and_take_the_nominative(spark):
    cases = {"в Доме у Моста": "Дом у Моста", "На улице": "улица", "к": "к", "УЛИЦУ Роз.": "УЛИЦА Роз", None: "", " от до ": "до", "Еллафах": "Еллафах"}
    rows = spark.createDataFrame([(k,) for k in cases], "s string")
    assert [r[0] for r in rows.select(facts.canonical_place(F.col("s"))).collect()] == list(cases.values())


def test_log_over_base_records(spark):
    at = datetime.datetime(2024, 1, 1)
    base = spark.createDataFrame([("x", "base"), ("y", "base"), ("z", "base")], "entity_id string, record string")
    ops = spark.createDataFrame([("1", at, "x", "one"), ("2", at, "x", "two"), ("3", at, "y", None), (None, at, "z", None), ("4", at, "", "lost"), ("5", at, "new", "made")], "op_id string, ts timestamp, entity_id string, after string")
    assert sorted(tuple(r) for r in review.applied(base, ops).collect()) == [("new", "made"), ("x", "two"), ("z", "base")]
    assert review.applied(base, ops.limit(0)).count() == 3


def test_updates_take_named_fields_of_known_records(spark):
    state = spark.createDataFrame([("x", "old", "kept", ["t"]), ("y", None, None, None)], "entity_id string, subject string, fact string, theme_ids array<string>")
    patches = spark.createDataFrame([("x", {"subject": " new ", "id": "no"}, ["b", "a", "b"]), ("gone", {"subject": "n"}, None), ("y", {}, None)], "entity_id string, patch map<string,string>, theme_ids array<string>")
    found = {r["entity_id"]: r for r in review.updates(state, patches, ["subject", "fact"]).collect()}
    assert set(found) == {"x", "y"}
    assert tuple(found["x"]["before"]) == ("old", "kept", ["t"]) and tuple(found["x"]["after"]) == ("new", "kept", ["b", "a"])
    assert tuple(found["y"]["after"]) == (None, None, None)


def test_appended_rows_have_new_keys(spark):
    rows = lambda *r: spark.createDataFrame(r, "n int, role string, text string")
    existing, new = rows((1, "a", "x"), (2, "a", "x"), (3, None, "y")), rows((4, "a", "x"), (6, "b", "x"), (5, "b", "x"), (7, None, "y"), (8, "a", None), (9, "a", None))
    assert sorted(r["n"] for r in review.appended(existing, new, ["role", "text"], ["n"]).collect()) == [1, 2, 3, 5, 8]


def test_suggestions_of_odd_answers(spark):
    answers = spark.createDataFrame([(1, "keep|1|place|Bridge| It stands |past|a | b\r\n| drop |1|\nDROP|2|bad\nkeep|1|2|3|4|5"), (2, None), (3, "")], "id int, text string")
    assert [tuple(r) for r in review.suggestions(answers, "text").orderBy("line_no").select("id", "line_no", "action", "fact_id", "fact", "reason").collect()] == [(1, 0, "keep", "1", "It stands", "a|b"), (1, 2, "drop", "2", None, "bad")]


def test_texts_kept_by_counts_equal_a_loop_of_ratios():
    pick = random.Random(6)
    for window, ratio in ((4, 0.85), (7, 0.6), (3, 0.3)):
        kept, last = dialogues.Kept(window, ratio), []
        for k in range(400):
            t = "" if not k % 50 else "".join(pick.choice("abcdeяж🙂 ") for _ in range(pick.choice((10, 60, 350)) + pick.randrange(40)))
            if last and pick.random() < 0.6:
                t = "".join(pick.choice("ab xyzXYZ012") if pick.random() < 0.12 else c for c in pick.choice(last))
            want = not any(abs(len(o) - len(t)) <= 0.3 * len(t) and difflib.SequenceMatcher(None, o, t).ratio() > ratio for o in last)
            assert kept.takes(t) == want
            if want:
                last = [*last[1 - window :], t]
            assert kept.last() == last


def test_degenerate_rows_that_share_an_id(spark):
    lines, words = "same line here\n" * 30 + "other\n" * 4, "one two " * 40
    plain = " ".join(f"word{k}" for k in range(90))
    rows = [(1, lines), (1, plain), (2, words), (3, None), (4, ""), (5, "x" * 300), (6, " " * 300), (None, lines)]
    got = chunks.degenerate(spark.createDataFrame(rows, "doc_id long, text string").withColumn("lines", F.lit(1))).collect()
    assert sorted(((str(r.doc_id), r.n_lines, r.top_lines) for r in got)) == [("1", 34, 30), ("2", 1, 1), ("None", 34, 30)]
