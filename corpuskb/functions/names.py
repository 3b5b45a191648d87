"""Names of books, files, traces and graph nodes as Column expressions; null is empty throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskb.functions.facts import normalized_subject
from corpuskb.functions.text import norm_text, strip_text, text_hash12

#: Suffixes of books.
BOOK_SUFFIXES = (".fb2.zip", ".fb2", ".txt", ".zip")
_SUFFIX = r"(?i)(\.fb2\.zip|\.fb2|\.txt|\.zip)$"

#: The graph's type of entities by category of facts.
ENTITY_TYPES = {"character": "character", "place": "place", "custom": "item", "magic": "magic", "creature": "creature", "history": "history_subject", "event": "event_subject"}
#: Types of relations.
RELATION_TYPES = ("before", "after", "involves", "occurs_in", "uses", "affects", "changes_state_of", "belongs_to", "located_in", "related_to")


def split_book_suffix(name: Column) -> Column:
    """(root, suffix) of a book's name; the suffix is empty if it is none of the known ones, its case stays."""
    text = strip_text(name)
    return F.struct(F.regexp_replace(text, _SUFFIX, "").alias("root"), F.regexp_extract(text, _SUFFIX, 1).alias("suffix"))


def book_aliases(name: Column) -> Column:
    """The names under which a book may be known, in order: its root, and either its own name or the root with every suffix."""
    text, parts = strip_text(name), split_book_suffix(name)
    every = F.array(parts["root"], *(F.concat(parts["root"], F.lit(s)) for s in BOOK_SUFFIXES))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.when(parts["suffix"] != "", F.array(parts["root"], text)).otherwise(every))))


def book_names_match(left: Column, right: Column) -> Column:
    a, b = split_book_suffix(left)["root"], split_book_suffix(right)["root"]
    return (strip_text(a) != "") & (strip_text(a) == strip_text(b))


def _without_last_suffix(path: Column) -> Column:
    # a leading dot of the last part is no suffix, nor is a closing one
    return F.regexp_replace(path, r"(?<=[^/])\.[^./]+$", "")


def book_stem(name: Column) -> Column:
    """A book's flat name for its output files: no last suffix, two dashes for a slash."""
    return F.regexp_replace(_without_last_suffix(F.coalesce(name, F.lit(""))), "/", "--")


def stem_of_output(filename: Column, prefix: str) -> Column:
    """A file's name without its last suffix, and without the prefix if it has it."""
    stem = _without_last_suffix(filename)
    return F.when(stem.startswith(prefix), F.substring(stem, len(prefix) + 1, 1 << 30)).otherwise(stem)


def name_of_stem(stem: Column) -> Column:
    return F.regexp_replace(stem, "--", "/")


def default_chapter(name: Column) -> Column:
    """The last part of a book's name without its suffix, or a placeholder."""
    label = strip_text(F.regexp_extract(_without_last_suffix(F.coalesce(name, F.lit(""))), r"([^/]*)/*$", 1))
    return F.when(label == "", "Без названия").otherwise(label)


def trace_slug(value: Column, default: str = "llm") -> Column:
    """At most 80 letters, digits, dots, dashes and underscores."""
    slug = F.regexp_replace(F.regexp_replace(F.coalesce(value, F.lit("")), r"[^0-9A-Za-zА-Яа-яЁё._-]+", "_"), r"^[._-]+|[._-]+$", "")
    return F.substring(F.when(slug == "", default).otherwise(slug), 1, 80)


def chunk_tag(idx: Column, total: Column) -> Column:
    return F.concat(F.lit("[фрагмент "), (idx + 1).cast("string"), F.lit("/"), total.cast("string"), F.lit("]"))


def entity_type(category: Column) -> Column:
    category = strip_text(category)
    out = F.lit("unknown")
    for key, value in ENTITY_TYPES.items():
        out = F.when(category == key, value).otherwise(out)
    return out


def entity_node_id(label: Column, category: Column) -> Column:
    key = normalized_subject(label)
    return F.concat(entity_type(category), F.lit("::"), F.when(key == "", text_hash12(label)).otherwise(key))


def event_node_id(book: Column, chapter: Column, order: Column) -> Column:
    number = F.when(order < 1000, F.lpad(order.cast("string"), 3, "0")).otherwise(order.cast("string"))
    return F.concat(F.lit("event::"), book_stem(book), F.lit("::"), text_hash12(chapter), F.lit("::"), number)


def relation_type(value: Column) -> Column:
    """A known relation type, words joined by underscores; all others are ``related_to``."""
    key = F.regexp_replace(norm_text(value), " ", "_")
    return F.when(key.isin(*RELATION_TYPES), key).otherwise("related_to")


#: Parts of file names with the book's narrator and how it is used, first match first.
BOOK_MODES = {
    "чуб земли": ("Меламори Блимм", "knowledge_only"),
    "туланский детектив": ("Меламори Блимм", "knowledge_only"),
    "властелин морморы": ("Джуффин Халли", "knowledge_only"),
    "ворона на мосту": ("Шурф Лонли-Локли", "knowledge_only"),
    "горе господина гро": ("Кофа Йох", "knowledge_only"),
    "обжора-хохотун": ("Мелифаро", "knowledge_only"),
    "обжора хохотун": ("Мелифаро", "knowledge_only"),
    "тубурская игра": ("Нумминорих Кута", "knowledge_only"),
    "неуловимый хабба": ("Макс", "full"),
    "дар шаванахолы": ("Макс", "full"),
    "хроники ехо (сборник)": ("_сборник", "knowledge_raw"),
    "мой рагнарёк": ("Макс", "voice_only"),
    "мой рагнарек": ("Макс", "voice_only"),
    "гнёзда химер": ("Макс", "voice_only"),
    "гнезда химер": ("Макс", "voice_only"),
    "ключ из желтого": ("Макс", "voice_only"),
    "энциклопедия мифов": ("Макс", "voice_only"),
    "чашка фрая": ("_сборник", "knowledge_raw"),
    "жалобная книга": ("_сборник", "knowledge_raw"),
}


def book_mode(filename: Column, rules: dict[str, tuple[str, str]] = BOOK_MODES, default: tuple[str, str] = ("Макс", "full")) -> Column:
    """(narrator, mode) by the first rule whose words the file name contains, whatever their case."""
    pair = lambda x: F.struct(F.lit(x[0]).alias("narrator"), F.lit(x[1]).alias("mode"))
    out = pair(default)
    for key, value in reversed(rules.items()):
        out = F.when(F.contains(F.lower(filename), F.lit(key)), pair(value)).otherwise(out)
    return out
