"""Scalar text functions as Column expressions; every one stays in the JVM."""

from __future__ import annotations

from string import ascii_lowercase, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, as the pattern (?U)\s has it.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def once(value: Column, use) -> Column:
    """``use`` of a value that is computed once a row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip_text(value: Column) -> Column:
    """Text without white space at its ends; null is empty."""
    return F.trim(F.coalesce(value.cast("string"), F.lit("")), F.lit(_SPACE))


def norm_text(value: Column) -> Column:
    """The key under which texts are compared: lower case, no bracketed parts, only [0-9a-zа-я] words, single spaces."""
    out = F.replace(F.lower(F.coalesce(value.cast("string"), F.lit(""))), F.lit("ё"), F.lit("е"))
    out = F.regexp_replace(out, r"\([^)]*\)", " ")
    # single characters are looked up in a table of bits, ranges are asked one after the other: 0-9 and a-z take several times as long
    return F.trim(F.regexp_replace(out, f"[^{digits}{ascii_lowercase}а-я]+", " "))


def text_hash12(value: Column) -> Column:
    """First 12 hex digits of the MD5 of the stripped lower-case text."""
    return F.substring(F.md5(F.lower(strip_text(value))), 1, 12)


def estimate_tokens(value: Column) -> Column:
    """A third of the characters, one at least."""
    return F.greatest(F.floor(F.length(F.coalesce(value, F.lit(""))) / 3), F.lit(1)).cast("long")


def preview(value: Column, limit: int = 180) -> Column:
    """Single-spaced text, cut at ``limit`` characters with three dots at its end."""
    flat = F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"\s+", " "))
    return F.when(F.length(flat) <= limit, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, limit - 3)), F.lit("...")))


def stable_hash(*parts: Column) -> Column:
    """First 16 hex digits of the MD5 of the stripped parts, joined by the unit separator; null parts are empty."""
    return F.substring(F.md5(F.concat_ws("\x1f", *(strip_text(p) for p in parts))), 1, 16)


def tokens(value: Column) -> Column:
    """Words of the normalized text."""
    return F.array_remove(F.split(norm_text(value), " "), "")


def canonical_book_name(value: Column) -> Column:
    """A book's name without its known suffix."""
    return F.regexp_replace(strip_text(value), r"(\.fb2\.zip|\.fb2|\.txt|\.zip)$", "")


def duration(seconds: Column) -> Column:
    """Seconds as ``Ns``, ``MmSSs`` or ``HhMMmSSs``."""
    s = F.floor(seconds).cast("int")
    hours, minutes, rest = F.floor(s / 3600).cast("int"), F.floor(s % 3600 / 60).cast("int"), s % 60
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm%02ds", minutes, rest)).otherwise(F.format_string("%dh%02dm%02ds", hours, minutes, rest))


def squeezed(value: Column) -> Column:
    """Text with single spaces for runs of white space, none at its ends."""
    return F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\s+", " "))


def looks_like_heading(paragraph: Column) -> Column:
    """At most 120 characters that are a chapter word with what follows, a roman or plain number, or capitals only, four or more."""

    def judged(t: Column) -> Column:
        letters = F.regexp_replace(t, "[^A-Za-zА-Яа-яЁё]", "")
        named = t.rlike(r"(?iuU)^(глава|часть|книга|пролог|эпилог|послесловие|предисловие)\b.*$") | t.rlike(r"(?i)^[ivxlcdm]+[.)]?$") | t.rlike(r"^[0-9]+[.)]?$")
        return F.when((t == "") | (F.length(t) > 120), False).otherwise(named | once(letters, lambda x: (F.length(x) >= 4) & (F.upper(x) == x)))

    return once(squeezed(paragraph), judged)


def is_scene_break(paragraph: Column) -> Column:
    """Three to twelve marks of a separator and nothing else but white space."""
    # most paragraphs are settled by their first character
    return F.coalesce(paragraph, F.lit("")).rlike(r"(?U)\A\s*(?:[*#~\-_=•·.]\s*){3,12}\z")


def paragraph_preview(paragraph: Column, limit: int = 120) -> Column:
    """A paragraph in one line; a long one as its head and its last 40 characters."""
    cut = lambda t: F.when(F.length(t) <= limit, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, min(160, limit - 50))), F.lit(" ... "), F.ltrim(F.substring(t, -40, 40))))
    return once(squeezed(paragraph), cut)


def chunk_excerpt(text: Column, token_limit: int) -> Column:
    """A chunk whole, or its head and tail if it has more tokens than the limit."""
    t, n = F.coalesce(text, F.lit("")), max(token_limit * 4, 600)
    edge = lambda c, pattern: F.regexp_replace(c, pattern, "")
    cut = F.concat(edge(F.substring(t, 1, n), r"(?U)\s+$"), F.lit("\n...\n"), edge(F.when(F.length(t) <= n, t).otherwise(F.substring(t, -n, n)), r"(?U)^\s+"))
    return F.when(estimate_tokens(t) <= token_limit, strip_text(t)).otherwise(strip_text(cut))


def search_text(value: Column) -> Column:
    """Lower-case text without quotes and dashes, white space squeezed, as quotations are looked up."""
    return F.lower(squeezed(F.regexp_replace(F.coalesce(value, F.lit("")), r"[«»\"'\-—–]", "")))


def clean_json(value: Column) -> Column:
    """A model's answer without a byte-order mark, a fence of code around it and the word json before it."""
    t = F.regexp_replace(strip_text(value), "^﻿+", "")
    bare = F.regexp_replace(F.regexp_replace(t, r"(?iU)^```(?:json)?\s*", ""), r"(?U)\s*```$", "")
    return strip_text(F.regexp_replace(F.when(t.startswith("```"), bare).otherwise(t), r"(?iU)^\s*json\s*:?\s*", ""))


def primary_chunk(payload: Column) -> Column:
    """The chunk that a payload marks as the primary one, without its context and glossary; all of it if it marks none."""
    text = F.coalesce(payload, F.lit(""))
    marked = r"(?sU)\[PRIMARY CHUNK[^\]]*\]\s*\n(.*?)(?=\n\s*\[(?:SUPPORTING CONTEXT|SCENE GLOSSARY)\]|\z)"
    return F.when(text.rlike(marked), strip_text(F.regexp_extract(text, marked, 1))).otherwise(text)


def messages(system: Column, user: Column, assistant: Column) -> Column:
    """A conversation as (role, content) in order; an empty system text is left out."""
    said = lambda role, text: F.struct(F.lit(role).alias("role"), strip_text(text).alias("content"))
    return F.filter(F.array(said("system", system), said("user", user), said("assistant", assistant)), lambda m: (m["role"] != "system") | (m["content"] != ""))


def chunk_heading(chunk: Column, section_break: str = "[[SECTION_BREAK]]") -> Column:
    """The first heading among a chunk's first six paragraphs, scene breaks and section marks aside; empty if there is none."""
    parts = F.filter(F.transform(F.split(F.coalesce(chunk, F.lit("")), r"(?U)\n\s*\n+"), strip_text), lambda p: p != "")
    headings = F.filter(F.slice(parts, 1, 6), lambda p: (p != section_break) & ~is_scene_break(p) & looks_like_heading(p))
    return F.coalesce(F.get(headings, F.lit(0)), F.lit(""))
