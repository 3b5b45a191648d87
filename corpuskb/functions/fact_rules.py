"""Rules on facts that a model extracted: grounds in the text, anchors in the subject, empty and passing statements, as Column expressions.

Texts are normalized before patterns are looked for, so these know lower-case words and single spaces only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskb.functions import facts
from corpuskb.functions.canon import GENERIC_PLACES, PLACE_PARTS, canonical_character
from corpuskb.functions.text import norm_text, once, strip_text, tokens

# Categories and their aliases, and patterns that results depend on.
CATEGORIES = ("character", "place", "magic", "history", "event", "creature", "custom")
CATEGORY_ALIASES = {
    "персонаж": "character", "person": "character", "persona": "character", "место": "place", "location": "place", "location name": "place",
    "place name": "place", "region": "place", "geography": "place", "магия": "magic", "spell": "magic", "история": "history", "epoch": "history",
    "era": "history", "period": "history", "historical period": "history", "событие": "event", "существо": "creature", "быт": "custom",
    "обычай": "custom", "обычаи": "custom", "item": "custom", "object": "custom", "artifact": "custom", "institution": "custom",
}
ANCHORED = ("character", "creature", "magic", "event")
FIRST_PERSON = r"\b(я|мне|меня|мой|моя|мое|мои|мы|нас|нам)\b"
#: What an empty statement begins with.
EMPTY_BEGINNINGS = (
    r"главн(ый|ая) геро(й|иня)\b", r"место действия\b", r"персонаж +котор(ый|ая|ое)\b", r"место +где.+происходят события", r"место +в котором.+происходят события",
    r"объект +котор(ый|ая|ое).+упомина", r"сущность +котор(ая|ый|ое)", r"персонаж +котор(ый|ая|ое).+присутств", r"место +котор(ое|ый).+упомина",
    r"действие +котор(ое|ый)\b", r"действия +в (сцене|тексте)\b", r"это место +где", r"это предмет +котор", r"это предмет гардероба +котор", r"это напиток +котор",
    r"это вино +котор", r"это заведение +где", r"это одно из заведений", r"это территория +котор", r"это миф +то +чего нет", r"явля(ется|ются) местом действия\b",
    r"явля(ется|ются) местом где\b", r"в тексте не упоминается\b", r"не упоминается в данном отрывке\b", r"описани[ея] отсутствует\b", r"не может быть определен\b",
    r"не указан конкретный персонаж\b", r"предмет +котор(ый|ая|ое)\b", r"один из них\b", r"другой\b", r"упоминается в контексте\b", r"упоминание о\b",
    r"событие +связанное с\b", r"место +связанное с\b", r"персонаж +связанный с\b", r"важность\b.+\bдля героя\b", r"появление\b.+\bкоторые окружают\b",
)
#: What an empty statement has anywhere.
EMPTY_WORDS = (
    r"это персонаж +котор(ый|ая|ое)", r"персонаж +котор(ый|ая|ое)\b", r"является персонажем +котор", r"в данной сцене\b", r"по видимому\b", r"источник шума или внимания\b",
    r"вероятно +имеется в виду\b", r"в тексте не упоминается\b", r"не упоминается в данном отрывке\b", r"описани[ея] отсутствует\b", r"не раскрывается\b", r"в курсе событий\b",
    r"может быть\b", r"возможно\b", r"предполагается\b", r"источником информации\b", r"в центре внимания\b", r"в состоянии +когда\b", r"в процессе повествования\b",
    r"происходит действие\b", r"по мнению рассказчика\b", r"в какой то момент\b", r"в роли\b", r"место +связанное с\b", r"событие +связанное с\b", r"предметом обсуждения\b",
    r"предмет +который был замечен\b", r"один из них\b",
)
EMPTY_EVENTS = ("действие которое совершает макс чтобы отвлечь внимание", "действие которое совершает герой чтобы отвлечь внимание")
#: What a passing statement has anywhere, of any category and of one.
PASSING = (
    r"в тексте не упоминается\b", r"описани[ея] отсутствует\b", r"предметом обсуждения\b", r"упоминание о\b", r"упоминается в контексте\b", r"не раскрывается\b", r"в курсе событий\b",
    r"может быть\b", r"возможно\b", r"предполагается\b", r"источником информации\b", r"в центре внимания\b", r"в процессе повествования\b", r"в состоянии +когда\b",
    r"не может быть определен\b", r"по мнению рассказчика\b", r"в какой то момент\b", r"местом действия\b", r"курс\w* адаптац\w*\b", r"интенсивн\w* курс\w* адаптац\w*\b",
    r"осваива\w* в новом мире\b", r"начинает привыкать к новой жизни\b", r"катализатор\w* изменени\w* привычек\b", r"помощ\w* в трудоустройств\w*\b",
)
PASSING_SUBJECTS = ("два друга", "два персонажа", "действие", "действия")
PASSING_CHARACTERS = (
    r"удивил(ся|ась|ось)?\b.+\bспрос", r"спросил[аи]?\b", r"посоветовал[аи]?\b", r"ведет себя так будто\b", r"не смог понять что происходит\b", r"решил это объяснить\b",
    r"решил объяснить\b", r"другой\b", r"является персонажем +котор", r"персонажем +котор", r"переоде(лся|лась|ться)\b", r"переодеть\b", r"помог.+переодеться\b", r"был переодет\b",
    r"меняет.+туфли\b", r"меняет.+мокасины\b", r"меняет.+обувь\b", r"практиковался в (имитации|приеме пищи)\b", r"имитируя действия\b", r"наблюдая за.+учител",
    r"стал проводником.+по дому\b", r"был озадачен\b.+\bвидом\b", r"был озадачен\b.+\bпри встрече\b", r"стал катализатором\b", r"проявляет слабость к\b", r"привык\w* к новой жизни\b",
    r"катализатор\w* изменени\w*\b", r"заявил +что\b", r"заявляет +что\b", r"назвал\b.+\bглавн\w* спасител\w*\b", r"приказал\b.+\bехать\b", r"приказал\b.+\bотправитьс[яь]\b",
    r"приказал\b.+\bпосетить\b", r"настоял\b.+\bусвоил\b", r"унес\b.+\bпод мышк\w*\b", r"будет коллекционировать амобилер\w*\b", r"каждый нищий кочевник\b", r"лонки ломки\b",
    r"был строго предупрежден\b", r"встретить\b.+\bпо первому разряду\b", r"помог\b.+\bодеть", r"выглядел пристойно\b", r"состоит из десятка букв\b", r"запомнить его фамилию\b",
    r"был назван\b.+\bлихим ветром\b", r"питал к\b.+\bслабость\b",
)
PASSING_CHARACTER_BEGINNINGS = (r"один из них\b",)
PASSING_ROOMS = ("гостиная", "кабинет", "комната", "зал", "спальня", "кухня", "сад", "двор", "дом", "улица")
PASSING_PLACES = ("сарайчик", "стол")
PASSING_MAGIC = (r"передал[аио]?\b.+\bмакс", r"передала максу\b", r"собак[аи]\b.+\bпередал[аио]?\b", r"сказал[аи]?\b.+\bпо безмолвн")
PASSING_MAGIC_SUBJECT = "безмолвная речь"
PASSING_CUSTOMS = (r"вероятно +имеется в виду\b", r"носил убитый\b", r"объект +который может быть связан\b", r"место +где происходит действие\b")
PASSING_EVENT_SUBJECTS = (r"(обед|завтрак|ужин)\b", r".+\bподвиг\b", r"действие\b", r"действия\b")
PASSING_EVENT_BEGINNINGS = (r"действие +котор",)
PASSING_EVENTS = (
    r"удивил(ся|ась|ось)?\b.+\bспрос", r"спросил[аи]?\b", r"отправил(?:ся|ась|ись)\b.+\b(обедать|завтракать|ужинать)\b", r"пош(?:ел|ла|ли)\b.+\b(обедать|завтракать|ужинать)\b",
    r"рассказал[аи]?\b.+\bо своем\b", r"в сцене упоминается\b", r"меняет.+туфли\b", r"меняет.+мокасины\b", r"переоде(лся|лась|ться)\b", r"практиковался в (имитации|приеме пищи)\b",
    r"наблюдая за.+учител", r"впервые едет\b", r"проходит экзамен на водительские\b", r"имитируя действия\b", r"заявляет +что\b", r"покидают место происшествия +чтобы\b",
    r"признает +что его действия\b", r"унес\b.+\bпод мышк\w*\b", r"приказывает\b.+\bотправитьс[яь]\b", r"приказывает\b.+\bехать\b", r"приказывает\b.+\bпосетить\b",
    r"приказал\b.+\bотправитьс[яь]\b", r"приказал\b.+\bехать\b", r"приказал\b.+\bпосетить\b", r"назвал\b.+\bглавн\w* спасител\w*\b", r"был признан\b.+\bглавн\w* спасител\w*\b",
    r"назвал\b.+\bлихим ветром\b", r"назвал\b.+\bураганом\b", r"был назван\b.+\bлихим ветром\b",
)


def _begins(text: Column, patterns: tuple[str, ...]) -> Column:
    return text.rlike("(?uU)^(?:" + "|".join(patterns) + ")")


def _has(text: Column, patterns: tuple[str, ...]) -> Column:
    return text.rlike(r"(?uU)\b(?:" + "|".join(patterns) + ")")


def category_of(category: Column) -> Column:
    """A known category for its aliases, else the lower-case text."""
    return F.coalesce(F.create_map(*(F.lit(x) for pair in CATEGORY_ALIASES.items() for x in pair))[norm_text(category)], F.lower(strip_text(category)))


def subject_words(subject: Column, category: Column) -> Column:
    """A subject's words of three characters or more that are no function words, titles or common nouns, and for places no parts of them."""
    found = F.filter(tokens(subject), lambda t: (F.length(t) >= 3) & ~t.isin(*facts.STOPWORDS, *facts.SUBJECT_NOISE))
    return F.filter(found, lambda t: (category != "place") | ~t.isin(*set(facts.PLACE_HEADS.values()), *PLACE_PARTS))


def subject_grounded(subject: Column, category: Column, text: Column, keys: Column) -> Column:
    """Whether a subject occurs in a normalized text, or enough of its words do among the text's keys; the narrator does in the first person.

    Of one word that one, of two one, of more two. An empty text grounds everything, a subject without words is never grounded.
    """

    def judged(n: Column) -> Column:
        told = first_person_subject(n) & speaks(text)
        whole = F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), n, F.lit(" ")))
        enough = once(subject_words(subject, category), lambda w: enough_subject_words(F.size(w), F.size(F.filter(w, lambda t: facts.grounded(t, keys)))))
        return F.when(n == "", False).when(told | whole | (F.size(keys) == 0), True).otherwise(enough)

    return F.when(text == "", True).otherwise(once(facts.normalized_subject(subject), judged))


def first_person_subject(normalized: Column) -> Column:
    """Whether a normalized subject is the narrator, who is grounded by the first person."""
    return normalized.isin("макс", "макс фрай")


def speaks(text: Column) -> Column:
    """Whether a normalized text has a word of the first person."""
    return text.rlike("(?uU)" + FIRST_PERSON)


def enough_subject_words(n: Column, met: Column) -> Column:
    return (n > 0) & (met >= F.when(n <= 2, 1).otherwise(2))


def fact_grounded(fact: Column, category: Column, subject: Column, keys: Column) -> Column:
    """Whether enough of a fact's content words, those of its subject aside, are among a text's keys; a text without keys grounds everything.

    Of one word that one, of up to four two, of more half of them, of an event's a third, two at least.
    """

    def judged(words: Column) -> Column:
        return enough_fact_words(F.size(words), F.size(F.filter(words, lambda t: facts.grounded(t, keys))), category)

    return F.when(F.size(keys) == 0, True).otherwise(once(fact_words(fact, category, subject), judged))


def fact_words(fact: Column, category: Column, subject: Column) -> Column:
    """A fact's content words without those of its subject, or all if no other is left."""
    return once(facts.content_tokens(fact), lambda words: once(F.array_except(words, subject_words(subject, category)), lambda other: F.when(F.size(other) > 0, other).otherwise(words)))


def enough_fact_words(n: Column, met: Column, category: Column) -> Column:
    need = F.when(n == 1, 1).when(n <= 4, 2).when(category == "event", F.greatest(F.lit(2), F.floor(n / 3))).otherwise(F.greatest(F.lit(2), F.floor((n + 1) / 2)))
    return (n == 0) | (met >= need)


def anchored(fact: Column, category: Column, subject: Column) -> Column:
    """Whether a fact on a character, creature, magic or event isn't told of another known character in its first words."""

    def judged(x: Column) -> Column:
        first, own = x["first"], x["own"]
        named = F.exists(F.slice(first, 1, 2), lambda t: F.array_contains(F.transform(own, facts.stem), facts.stem(t)))
        of = F.coalesce(canonical_character(subject), facts.normalized_subject(subject))
        told = [once(canonical_character(F.array_join(F.slice(first, 1, k), " ")), lambda c: c.isNotNull() & (c != of)) & (F.size(first) >= k) for k in (3, 2, 1)]
        return (F.size(own) == 0) | (F.size(first) == 0) | named | ~(told[0] | told[1] | told[2])

    both = F.struct(facts.leading_tokens(fact).alias("first"), subject_words(subject, category).alias("own"))
    return F.when(category.isin(*ANCHORED), once(both, judged)).otherwise(True)


def empty_statement(fact: Column, category: Column, subject: Column) -> Column:
    """Whether a fact says no more than that its subject is there."""

    def judged(x: Column) -> Column:
        n, s = x["n"], x["s"]
        same = (s != "") & ((n == s) | n.startswith(F.concat(s, F.lit(" это "))))
        return (n == "") | same | _begins(n, EMPTY_BEGINNINGS) | _has(n, EMPTY_WORDS) | ((category == "event") & n.isin(*EMPTY_EVENTS))

    return once(F.struct(norm_text(fact).alias("n"), norm_text(subject).alias("s")), judged)


def passing_statement(fact: Column, category: Column, subject: Column) -> Column:
    """Whether a fact tells of a moment in a scene only."""

    def judged(x: Column) -> Column:
        n, s = x["n"], x["s"]
        by_category = {
            "character": _has(n, PASSING_CHARACTERS) | _begins(n, PASSING_CHARACTER_BEGINNINGS),
            "place": s.isin(*GENERIC_PLACES, *PASSING_ROOMS, *PASSING_PLACES),
            "magic": (s == PASSING_MAGIC_SUBJECT) & _has(n, PASSING_MAGIC),
            "custom": _has(n, PASSING_CUSTOMS),
            "event": _begins(s, PASSING_EVENT_SUBJECTS) | _has(n, PASSING_EVENTS) | _begins(n, PASSING_EVENT_BEGINNINGS),
        }
        out = (n == "") | s.isin(*PASSING_SUBJECTS) | _has(n, PASSING)
        for name, rule in by_category.items():
            out = out | ((category == name) & rule)
        return out

    return once(F.struct(norm_text(fact).alias("n"), norm_text(subject).alias("s")), judged)
