"""What facts and their subjects are compared by: signatures, markers, clauses, stems and keys, as Column expressions.

Null texts are empty. A fact is given by its columns category, subject, fact and time_scope.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskb.functions.text import norm_text, once, strip_text, text_hash12, tokens

# Word lists that results depend on.
SUBJECT_NOISE = ("сэр", "леди", "господин", "госпожа", "мадам", "месье", "город", "трактир", "орден", "графство", "эпоха", "кодекс", "район", "остров", "улица", "мир", "пёс", "пес")
HONORIFICS = ("сэр", "леди", "господин", "госпожа", "мадам", "месье")
STOPWORDS = (
    "и", "или", "а", "но", "что", "как", "это", "этот", "эта", "эти", "он", "она", "они", "его", "ее", "её", "их", "для", "при", "из",
    "в", "во", "на", "по", "к", "ко", "у", "с", "со", "от", "до", "над", "под", "же", "ли", "не", "ни", "был", "была", "были", "было",
    "является", "являются", "который", "которая", "которое", "которые", "где",
)
NEGATIONS = ("не", "нет", "никогда", "никак", "больше", "уже", "перестал", "перестала", "перестали", "лишился", "лишилась", "отменен", "отменена", "отменено", "отменены")
TEMPORAL = (
    "раньше", "прежде", "когда", "теперь", "сейчас", "позже", "потом", "впоследствии", "некогда", "прежний", "прежняя", "прежнее",
    "бывший", "бывшая", "бывшее", "стал", "стала", "стали", "снова", "вновь", "вернулся", "вернулась", "вернулись", "после", "до",
)
CONTRADICTIONS = (
    (("жив", "жива", "живы"), ("мертв", "мертва", "мертвый", "мертвая", "умер", "умерла", "погиб", "погибла", "мертвец")),
    (("действует", "работает", "существует"), ("не", "отменен", "перестал", "исчез", "упразднен")),
    (("женат", "замужем"), ("развелся", "развелась", "не", "больше")),
    (("вернулся", "вернулась", "вернулись", "появился", "появилась"), ("уехал", "уехала", "исчез", "исчезла", "пропал", "пропала")),
)
STEM_ENDINGS = (
    "иями", "ями", "ами", "ием", "иеми", "иях", "ях", "ах", "ого", "ему", "ому", "ыми", "ими", "ыми", "его", "ого",
    "ий", "ый", "ой", "ая", "яя", "ое", "ее", "ые", "ие", "ым", "им", "ом", "ем", "ам", "ям", "ов", "ев", "ей",
    "ою", "ею", "ую", "юю", "ия", "ья", "ью", "ию", "у", "ю", "а", "я", "ы", "и", "е", "о",
)
#: Words that mark a time scope, in order of precedence.
SCOPES = (
    ("ended", ("больше", "не", "перестал", "перестала", "перестали", "исчез", "исчезла", "умер", "умерла", "мертв", "мертва", "отменен", "лишился")),
    ("change", ("стал", "стала", "стали", "теперь", "снова", "вновь", "после", "впоследствии", "вернулся", "вернулась", "вернулись", "изменился", "изменилась")),
    ("past", ("раньше", "прежде", "бывший", "бывшая", "бывшее", "некогда", "когда")),
    ("current", ("сейчас", "ныне", "теперь")),
)
TIMELESS = ("custom", "magic", "place", "creature")
INFORMATIVE = ("past", "current", "change", "ended")
SCOPE_ALIASES = {
    "past": "past", "former": "past", "before": "past", "current": "current", "present": "current", "now": "current",
    "change": "change", "changed": "change", "transition": "change", "ended": "ended", "end": "ended", "ceased": "ended", "stopped": "ended",
    "timeless": "timeless", "stable": "timeless", "general": "timeless", "unclear": "unclear", "unknown": "unclear",
}
PREPOSITIONS = ("к", "ко", "в", "во", "на", "у", "из", "с", "со", "от", "до", "по")
PLACE_HEADS = {
    "улица": "улица", "улице": "улица", "улицу": "улица", "улицы": "улица", "дом": "дом", "доме": "дом", "дома": "дом", "дому": "дом", "домом": "дом",
    "квартира": "квартира", "квартире": "квартира", "квартиру": "квартира", "квартиры": "квартира", "кабинет": "кабинет", "кабинете": "кабинет",
    "кабинету": "кабинет", "комната": "комната", "комнате": "комната", "комнату": "комната", "комнаты": "комната", "крыша": "крыша",
    "крыше": "крыша", "крышу": "крыша", "трактир": "трактир", "трактире": "трактир", "трактира": "трактир", "мост": "мост", "мосту": "мост",
    "моста": "мост", "город": "город", "городе": "город", "города": "город",
}


def _words(values) -> Column:
    return F.array(*(F.lit(v) for v in values))


def _without(found: Column, values) -> Column:
    return F.filter(found, lambda t: ~t.isin(*values))


def normalized_subject(subject: Column) -> Column:
    """The normalized subject without leading titles and common nouns; its last word always stays."""
    return F.regexp_replace(norm_text(subject), "^(?:(?:" + "|".join(SUBJECT_NOISE) + ") )+", "")


def subject_signature(subject: Column) -> Column:
    """The sorted words of a subject without titles and common nouns, or all if nothing is left."""
    found = F.filter(F.split(normalized_subject(subject), " "), lambda t: t != "")

    def signed(words: Column) -> Column:
        return once(_without(words, SUBJECT_NOISE), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(words))

    return F.array_sort(F.array_distinct(once(found, signed)))


def content_tokens(fact: Column) -> Column:
    """The sorted words of three characters or more that are no function words."""
    return F.array_sort(F.array_distinct(F.filter(_without(tokens(fact), STOPWORDS), lambda t: F.length(t) >= 3)))


def marker_tokens(fact: Column) -> Column:
    """The sorted words of negation, time and change."""
    return F.array_sort(F.array_distinct(F.filter(tokens(fact), lambda t: t.isin(*NEGATIONS, *TEMPORAL))))


def leading_clause(fact: Column) -> Column:
    """The normalized text before the first mark of punctuation."""
    return norm_text(F.regexp_extract(F.coalesce(fact, F.lit("")), r"^[^,:;.!?]*", 0))


def leading_tokens(fact: Column, limit: int = 4) -> Column:
    """The first words that are neither function words nor titles, in order."""
    return F.slice(_without(tokens(fact), (*STOPWORDS, *HONORIFICS)), 1, limit)


def stem(token: Column) -> Column:
    """A word without the first of the endings that it has, if four characters stay; short words stay whole."""
    # of two endings that a word may have, the longer one stands first in the list, so the shortest beginning has it
    short = F.regexp_replace(token, r"(?s)\A(.{4,}?)(?:" + "|".join(dict.fromkeys(STEM_ENDINGS)) + r")\z", "$1")
    # words of other alphabets are not searched for an ending at each character
    return F.when(token.rlike(r"[а-я]\z"), short).otherwise(token)


def grounding_keys(text: Column) -> Column:
    """The sorted words of three characters or more and their stems of four or more."""
    found = F.filter(tokens(text), lambda t: F.length(t) >= 3)
    stems = F.filter(F.transform(found, stem), lambda t: F.length(t) >= 4)
    return F.array_sort(F.array_distinct(F.concat(found, stems)))


def grounded(token: Column, keys: Column) -> Column:
    """Whether a word or its stem is among the keys of a text."""
    short = stem(token)
    return (F.length(token) >= 3) & (F.array_contains(keys, token) | ((F.length(short) >= 4) & F.array_contains(keys, short)))


def without_honorifics(subject: Column) -> Column:
    """The subject without the titles before it."""
    return F.trim(F.regexp_replace(strip_text(subject), r"(?iU)^(?:(?:сэр|леди|господин|госпожа|мадам|месье)\s+)+", ""))


def _table(entries: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in entries.items() for x in pair))


def match_case(shape: Column, value: Column) -> Column:
    """A word in capitals, or with a capital first letter, if the given shape is so."""
    capital = F.concat(F.upper(F.substring(value, 1, 1)), F.substring(value, 2, 1 << 20))
    return F.when((F.upper(shape) == shape) & (F.lower(shape) != shape), F.upper(value)).when(F.substring(shape, 1, 1) != F.lower(F.substring(shape, 1, 1)), capital).otherwise(value)


def canonical_place(subject: Column) -> Column:
    """A place's name without prepositions before it, its head word in the nominative, no punctuation at its ends."""

    def renamed(words: Column) -> Column:
        # the last word always stays
        other = F.array_position(F.transform(words, lambda t: norm_text(t).isin(*PREPOSITIONS)), False)
        skipped = F.least(F.when(other == 0, F.size(words)).otherwise(other - 1), F.size(words) - 1).cast("int")
        return F.when(F.size(words) == 0, "").otherwise(once(F.slice(words, skipped + 1, F.size(words)), headed))

    def headed(rest: Column) -> Column:
        first = F.get(rest, F.lit(0))
        head = once(F.struct(first.alias("first"), _table(PLACE_HEADS)[norm_text(first)].alias("head")), lambda x: F.coalesce(match_case(x["first"], x["head"]), x["first"]))
        joined = F.array_join(F.concat(F.array(head), F.slice(rest, 2, 1 << 20)), " ")
        return F.regexp_replace(joined, r"^[ \t\n\r,;:.!?-]+|[ \t\n\r,;:.!?-]+$", "")

    return once(F.filter(F.split(strip_text(subject), r"(?U)\s+"), lambda t: t != ""), renamed)


def inferred_scope(fact: Column, category: Column) -> Column:
    """The first scope of which a marker occurs in the fact; else timeless for lasting categories; unclear without words."""

    def scoped(found: Column) -> Column:
        out = F.when(category.isin(*TIMELESS), "timeless").otherwise("unclear")
        for scope, markers in reversed(SCOPES):
            out = F.when(F.arrays_overlap(found, _words(markers)), scope).otherwise(out)
        return F.when(F.size(found) == 0, "unclear").otherwise(out)

    return once(tokens(fact), scoped)


def time_scope(value: Column, fact: Column, category: Column) -> Column:
    """A known scope or alias as given, else what the fact says."""
    return F.coalesce(_table(SCOPE_ALIASES)[norm_text(value)], inferred_scope(fact, category))


def scopes_differ(left: Column, right: Column) -> Column:
    """Whether two normalized scopes both tell of a time, and of different ones."""
    return left.isin(*INFORMATIVE) & right.isin(*INFORMATIVE) & (left != right)


def _content(words: Column) -> Column:
    return F.array_distinct(F.filter(_without(words, STOPWORDS), lambda t: F.length(t) >= 3))


def states_differ(left: Column, right: Column) -> Column:
    """Whether two facts that share two content words or more contradict each other, or differ in negation or markers."""

    def judged(x: Column) -> Column:
        a, b = x["a"], x["b"]
        opposed = F.lit(False)
        for positive, negative in CONTRADICTIONS:
            for one, other in ((a, b), (b, a)):
                opposed = opposed | (F.arrays_overlap(one, _words(positive)) & F.arrays_overlap(other, _words(negative)))
        negated = F.arrays_overlap(a, _words(NEGATIONS)) != F.arrays_overlap(b, _words(NEGATIONS))
        marks = lambda words: F.array_sort(F.array_distinct(F.filter(words, lambda t: t.isin(*NEGATIONS, *TEMPORAL))))
        shared = F.size(F.array_intersect(_content(a), _content(b))) >= 2
        return (F.size(a) > 0) & (F.size(b) > 0) & (a != b) & shared & (opposed | negated | (marks(a) != marks(b)))

    return once(F.struct(tokens(left).alias("a"), tokens(right).alias("b")), judged)


def subjects_alike(left: Column, right: Column) -> Column:
    """Whether two subjects name one entity by their words: equal, one within the other by one word, or three quarters shared."""
    a, b = subject_signature(left), subject_signature(right)
    x, y = normalized_subject(left), normalized_subject(right)
    shared, every = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    within = (shared == F.size(a)) | (shared == F.size(b))
    some = (F.size(a) > 0) & (F.size(b) > 0)
    return (x != "") & (y != "") & ((x == y) | (some & F.when(a == b, True).when(within, F.abs(F.size(a) - F.size(b)) <= 1).otherwise((shared > 0) & (shared / F.greatest(every, F.lit(1)) >= 0.75))))


def fuller_subject(left: Column, right: Column) -> Column:
    """The name of more words, then of more characters, then the later one."""
    rank = lambda c: F.struct(F.size(tokens(c)), F.length(c), c)
    a, b = F.coalesce(left, F.lit("")), F.coalesce(right, F.lit(""))
    return F.when(a == "", b).when(b == "", a).when(rank(b) > rank(a), b).otherwise(a)


def _json(value: Column) -> Column:
    """A JSON string."""
    out = F.coalesce(value, F.lit(""))
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit('"'), out, F.lit('"'))


def _json_key(**parts: Column) -> Column:
    """The short hash of a JSON object whose keys are sorted."""
    fields = [x for k, name in enumerate(sorted(parts)) for x in (F.lit(("{" if not k else ", ") + f'"{name}": '), parts[name])]
    return text_hash12(F.concat(*fields, F.lit("}")))


def stable_fact_hash(category: Column, subject: Column, fact: Column, scope: Column) -> Column:
    return _json_key(category=_json(category), subject=_json(subject), fact=_json(fact), time_scope=_json(scope))


def fact_key(category: Column, subject: Column, fact: Column, scope: Column) -> Column:
    """The key under which facts of several passes are one."""
    return _json_key(category=_json(norm_text(category)), subject=_json(normalized_subject(subject)), fact=_json(norm_text(fact)), time_scope=_json(time_scope(scope, strip_text(fact), strip_text(category))))


def dialogue_key(kind: Column, interlocutor: Column, says: Column, answer: Column) -> Column:
    """The key under which replies of several passes are one; a missing interlocutor stays null."""
    who = F.when(interlocutor.isNull(), "null").otherwise(_json(interlocutor))
    return _json_key(type=_json(kind), interlocutor=who, interlocutor_says=_json(norm_text(says)), max_says=_json(norm_text(answer)))
