"""Canonical subjects: worked cases, and items of documents against a loop over books."""

import re
from collections import defaultdict

from corpuskb.functions import canon, facts
from corpuskb.operators import canonical
from corpuskb.plans import registry
from test_same_facts import canonical as known_name
from test_same_facts import norm, scope_of, subject_of

DATA = "/root/testdata/sf0.001"
FIELDS = "ord long, book string, narrator string, category string, subject string, fact string, time_scope string"


def stripped_titles(text):
    text = (text or "").strip()
    while (cut := re.sub(r"^(?:сэр|леди|господин|госпожа|мадам|месье)\s+", "", text, flags=re.I)) != text:
        text = cut.strip()
    return text


def place_name(text):
    words = (text or "").split()
    while len(words) > 1 and norm(words[0]) in facts.PREPOSITIONS:
        words = words[1:]
    if not words:
        return ""
    head, w = facts.PLACE_HEADS.get(norm(words[0])), words[0]
    if head:
        words[0] = head.upper() if w.isupper() else head.capitalize() if w[:1].isupper() else head
    return " ".join(words).strip(" \t\n\r,;:.!?-")


def is_general(subject, category, narrator):
    s = (subject or "").strip()
    if not s:
        return True
    if narrator and s == narrator:
        return False
    checked = stripped_titles(s) if category == "character" else place_name(s) if category == "place" else s
    n = norm(checked)
    words = n.split()
    if not n:
        return True
    own = set()
    if narrator and narrator != "_сборник":
        t = subject_of(narrator).split()
        own = {" ".join(t), t[0], " ".join(t[:2]), *(canon.NARRATOR_NAMES if narrator == "Макс" else ())}
    if n in own:
        return False
    lists = {"character": canon.GENERIC_CHARACTERS, "place": canon.GENERIC_PLACES, "event": ("действие", "действия", "событие", "события"), "custom": ("сон",)}
    if n in canon.GENERIC_ANY or n in lists.get(category, ()):
        return True
    plain = lambda pattern: re.match(pattern.replace("(?iuU)", ""), n, re.I)
    if plain(canon.VAGUE) or (category == "character" and (plain(canon.SEVERAL_CHARACTERS) or n.startswith("место"))):
        return True
    if category != "place":
        return False
    meant = [w for w in words if w not in facts.PREPOSITIONS and w not in ("и", "или")]
    listed = {"и", "или"} & set(words) and meant and all(w in facts.PLACE_HEADS.values() or w in canon.PLACE_PARTS or w in canon.NOT_PLACES for w in meant)
    return bool(plain(canon.VAGUE_PLACE) or (len(words) == 1 and n in facts.PLACE_HEADS.values()) or {*words[:2]} & set(canon.NOT_PLACES) or listed)


def narrator_name(subject, narrator):
    s = (subject or "").strip()
    if not s or not narrator or narrator == "_сборник":
        return s
    if known_name(s):
        return known_name(s)
    n, t = subject_of(s), subject_of(narrator).split()
    own, theirs = ({w for w in x.split() if w not in facts.SUBJECT_NOISE} or set(x.split()) for x in (n, " ".join(t)))
    alike = own and theirs and (own == theirs or (len(own) == 1 and own <= theirs))
    return narrator if n in canon.NARRATOR_SUBJECTS or n in (" ".join(t), t[0], " ".join(t[:2])) or n in (canon.NARRATOR_NAMES if narrator == "Макс" else ()) or alike else s


def one_pass(items, books=True):
    """Items by ord as (subject, fact, scope), a book at a time."""
    groups = defaultdict(list)
    for ord_, book, narrator, category, subject, fact, scope in sorted(items):
        groups[book if books else ""].append([ord_, (narrator or "") if books else "", category or "", (subject or "").strip(), (fact or "").strip(), scope])
    out = {}
    for found in groups.values():
        for item in found:
            narrator = item[1]
            if narrator == "Макс":
                item[3] = narrator_name(item[3], narrator) or item[3]
                if item[3] == narrator and item[4]:
                    f = item[4]
                    for w in ("рассказчик", "автор", "главный герой", "протагонист"):
                        f = re.sub(rf"\b{w}\b", narrator, f, flags=re.I)
                    for w in ("я", "он", "она"):
                        f = re.sub(rf"^\s*{w}\b", narrator, f, flags=re.I)
                    item[4] = " ".join(f.split())
        shown, forced, firsts, entries, places, place_entries = {}, {}, defaultdict(set), [], {}, []
        better = lambda a, b: max((len(norm(x).split()), len(x), x) for x in (a, b) if x)[2]
        for _, narrator, category, subject, *_rest in found:
            if category == "character":
                s = narrator_name(subject, narrator) if narrator else subject
                name = stripped_titles(s)
                core = norm(name)
                if not s or is_general(s, category, narrator) or not core:
                    continue
                shown[core] = better(shown.get(core), name)
                if known_name(name):
                    forced[subject_of(known_name(name))] = known_name(name)
                if " " in core:
                    firsts[core.split()[0]].add(core)
                entries.append((s, name, core))
            if category == "place":
                name = place_name(subject)
                if name and not is_general(name, category, narrator):
                    places[norm(name)] = better(places.get(norm(name)), name)
                    place_entries.append((subject, name))
        aliases = {}
        for s, name, core in entries:
            target = subject_of(known_name(name)) if known_name(name) else core
            if not known_name(name) and " " not in core and len(firsts[core]) == 1:
                target = next(iter(firsts[core]))
            aliases[norm(s)] = aliases[norm(name)] = forced.get(target) or shown[target]
        by_place = {}
        for s, name in place_entries:
            by_place[norm(s)] = by_place[norm(name)] = places[norm(name)]
        for ord_, narrator, category, subject, fact, scope in found:
            told, name = scope_of(scope, fact, category), subject
            starts = []
            if category == "character":
                name = aliases.get(norm(subject), stripped_titles(subject)).strip() or subject
                starts = ["он", "она", "тот", "та"] + [re.escape(x) for x in [stripped_titles(subject)] if x]
            elif category == "place":
                name = by_place.get(norm(subject), place_name(subject)).strip() or subject
                starts = ["это место", "здесь", "там"]
            if starts and fact and name:
                for w in starts:
                    changed = re.sub(rf"^\s*{w}\b", lambda m: name, fact, flags=re.I)  # noqa: B023
                    if changed != fact:
                        fact = changed
                        break
                fact = " ".join(fact.split())
            if not is_general(name, category, narrator):
                out[ord_] = (name, fact, told)
    return out


def test_worked_cases(spark):
    rows = [
        ("a", "character", "Ирма", "Она поет по утрам.", "Ирма Таль поет по утрам.", "Ирма Таль"),
        ("a", "character", "Ирма Таль", "Ирма Таль живет одна.", "Ирма Таль живет одна.", "Ирма Таль"),
        ("b", "character", "Ирма", "Ирма ушла.", "Ирма ушла.", "Ирма"),
        ("b", "character", "Ирма Таль", "Тут.", "Тут.", "Ирма Таль"),
        ("b", "character", "Ирма Кот", "Там.", "Там.", "Ирма Кот"),
        ("a", "character", "леди Меламори", "Она улыбается.", "Меламори Блимм улыбается.", "Меламори Блимм"),
        ("a", "character", "рассказчик", "Я видел, что автор спит", "Макс видел, что Макс спит", "Макс"),
        ("a", "place", "на улице Длинной", "Там темно.", "улица Длинной темно.", "улица Длинной"),
        ("a", "place", "улица Длинной", "Здесь $1 тихо.", "улица Длинной $1 тихо.", "улица Длинной"),
        ("a", "place", "дом и сад", "Там.", None, None),
        ("a", "place", "парадная дверь с надписью", "Там.", None, None),
        ("a", "place", "Дом у Моста", "Дом у Моста стоит.", "Дом у Моста стоит.", "Дом у Моста"),
        ("a", "character", "Мелифаро", "Он смеется.", "Мелифаро смеется.", "Мелифаро"),
        ("a", "character", "два друга", "Они пришли.", None, None),
        ("a", "custom", "сон", "Снится.", None, None),
        ("a", None, None, "без имени", None, None),
        (None, "character", "Ирма", "Она.", None, None),
    ]
    items = [(k, book, "Макс", category, subject, fact, None) for k, (book, category, subject, fact, *_) in enumerate(rows)]
    df = spark.createDataFrame(items, FIELDS).selectExpr("*", "1 as key", "2 as name", "3 as target")
    got = {r.ord: (r.subject, r.fact) for r in canonical.canonicalize_books(df).collect()}
    assert got == {k: (subject, fact) for k, (*_, fact, subject) in enumerate(rows) if subject}
    assert canonical.canonicalize_books(df.limit(0)).count() == 0
    assert {k: v[:2] for k, v in one_pass([i for i in items if i[1]]).items()} == got


def test_names_of_one_book_help_others(spark):
    items = [(1, "a", "", "character", "Ирма Таль", "Она пришла.", ""), (2, "b", "", "character", "Ирма", "Она ушла.", ""), (3, "b", "", "place", "к городе Ка", "Там.", "")]
    df = spark.createDataFrame(items, FIELDS)
    got = {r.ord: (r.book, r.subject, r.fact) for r in canonical.canonicalize_all(canonical.canonicalize_books(df)).collect()}
    assert got == {1: ("a", "Ирма Таль", "Ирма Таль пришла."), 2: ("b", "Ирма Таль", "Ирма Таль ушла."), 3: ("b", "город Ка", "город Ка.")}


def test_query_over_documents(spark):
    import hashlib

    from corpuskb.plans.validated import told_facts

    rows = [tuple(r) for r in told_facts(spark, DATA).collect()]
    by = {r[0]: r for r in rows}
    first = one_pass(rows)
    again = one_pass([(k, by[k][1], "", by[k][3], s, f, t) for k, (s, f, t) in first.items()], books=False)
    got = {r.ord: (r.subject, r.fact_md5, r.time_scope) for r in registry.QUERIES["canonical_facts"](spark, DATA).collect()}
    assert got == {k: (s, hashlib.md5(f.encode()).hexdigest(), t) for k, (s, f, t) in again.items()}
    assert len(got) < len(rows) and {"Меламори Блимм", "Макс"} <= {v[0] for v in got.values()}
