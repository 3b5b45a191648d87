"""Chunks and payloads against lists of texts put together one by one."""

import random
import re

import pytest

from corpuskb.operators import chunking
from corpuskb.plans import registry

DATA = "/root/testdata/sf0.001"


def size(text):
    return max(1, len(text) // 3)


def is_head(p):
    t, letters = " ".join(p.split()), re.sub("[^A-Za-zА-Яа-яЁё]", "", p)
    named = re.match(r"(глава|часть|книга|пролог|эпилог|послесловие|предисловие)\b.*$", t, re.I) or re.match(r"[ivxlcdm]+[.)]?$", t, re.I) or re.match(r"[0-9]+[.)]?$", t)
    return bool(t and len(t) <= 120 and (named or (len(letters) >= 4 and letters.upper() == letters)))


def is_break(p):
    t = re.sub(r"\s+", "", p)
    return p == "[[SECTION_BREAK]]" or (len(t) <= 12 and bool(re.match(r"[*#~\-_=•·.]{3,}$", t)))


def plain_chunks(text, limit, overlap):
    sections = [[]]
    for p in filter(None, (x.strip() for x in re.split(r"\n\s*\n+", text or ""))):
        if is_break(p):
            sections.append([])
        elif is_head(p):
            sections.append([p])
        else:
            sections[-1].append(p)
    units = []
    for section in filter(None, sections):
        whole = "\n\n".join(section)
        if size(whole) <= limit or len(section) == 1:
            units.append(whole)
            continue
        group = []
        for p in section:
            waits = len(group) == 1 and is_head(group[0])
            if group and not waits and (size(p) > limit or sum(map(size, group)) + size(p) > limit):
                units.append("\n\n".join(group))
                group = []
            group.append(p)
            if size(p) > limit:
                units.append("\n\n".join(group))
                group = []
        if group:
            units.append("\n\n".join(group))
    chunks, current = [], []
    for unit in units:
        if current and sum(map(size, current)) + size(unit) > limit:
            chunks.append("\n\n".join(current))
            tail = []
            while size(unit) <= limit and len(tail) < len(current) and sum(map(size, tail)) + size(current[-len(tail) - 1]) <= overlap:
                tail = current[len(current) - len(tail) - 1 :]
            current = tail
        if size(unit) > limit:
            chunks.append(unit)
            current = []
        else:
            current.append(unit)
    return chunks + (["\n\n".join(current)] if current else [])


def made(seed):
    pick = random.Random(seed)
    some = lambda: pick.choice(["Глава 3", "* * *", "[[SECTION_BREAK]]", "XIV.", "ВСЕ ЗАГЛАВНЫЕ", "x" * pick.randrange(1, 400), "слово " * pick.randrange(1, 30), "a\nb", "короткий"])
    return pick.choice(["\n\n", "\n \n", "\n\n\n"]).join(some() for _ in range(pick.randrange(40)))


@pytest.mark.parametrize("limit,overlap", [(30, 8), (60, 0), (25, 40), (1, 1), (2500, 150)])
def test_chunks_equal_lists_of_texts(spark, limit, overlap):
    texts = [None, "", " \n\n ", "* * *", *(made(k) for k in range(60))]
    docs = spark.createDataFrame([(k % 50, t) for k, t in enumerate(texts)], "doc_id long, text string").selectExpr("*", "1 as key", "2 as parts", "3 as idx").repartition(3)
    got = {}
    for r in chunking.chunked(docs, limit, overlap).collect():
        assert r.n_tokens == size(r.chunk) and r.first <= r.last
        got.setdefault(r.doc_id, []).append((r.idx, r.chunk))
    want = {}
    for k, t in enumerate(texts):
        want.setdefault(k % 50, []).extend(enumerate(plain_chunks(t, limit, overlap)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items() if v}
    assert chunking.chunked(docs.limit(0), limit, overlap).count() == 0


def test_a_book_takes_linear_time_and_keeps_its_bounds():
    pick = random.Random(1)
    lengths = [pick.randrange(1, 900) for _ in range(300_000)]
    heads = [pick.random() < 0.01 for _ in lengths]
    found = list(chunking.chunk_ranges([chunking._joined(lengths, a, b) for s in chunking.section_ranges(heads, [False] * len(lengths)) for a, b in chunking.unit_ranges(lengths, heads, s, 2500)], 2500, 150))
    assert 0.9 * sum(lengths) / 7500 < len(found) < 2.5 * sum(lengths) / 7500


def test_context_within_the_budget():
    chunks = ["a" * 30, "b" * 60 + "\n\n" + "c" * 30, "d" * 90, "e" * 9, "f" * 300]
    text, n, used = chunking.payload(chunks, 3, 60, 2, 12)
    assert text.startswith("[PRIMARY CHUNK #4]\n" + chunks[3] + "\n\n[SUPPORTING CONTEXT]\n[SUPPORTING PREV CHUNK #3 | full]\n" + "d" * 90)
    assert "[SUPPORTING NEXT CHUNK #5 | excerpt]\nffff" in text and (n, used) == (2, 130)
    text, n, used = chunking.payload(chunks, 3, 73, 2, 12)
    assert n == 2 and "CHUNK #2" not in text
    assert chunking.payload(chunks, 2, 53, 2, 12)[0].split("\n\n", 1)[1] == "[SUPPORTING CONTEXT]\n[SUPPORTING PREV CHUNK #2 | excerpt]\n" + "c" * 30 + "\n\n[SUPPORTING NEXT CHUNK #4 | full]\n" + chunks[3] + "\n\n[SUPPORTING PREV CHUNK #1 | full]\n" + chunks[0]
    assert chunking.payload(chunks, 4, 20, 2, 12) == ("[PRIMARY CHUNK #5]\n" + chunks[4], 0, 0)
    assert chunking.payload(chunks, 0, 90, 0, 12)[1:] == (0, 0)
    assert chunking.excerpt(["p" * 6, "q" * 9, "r" * 3], 4, True) == "q" * 9 + "\n\n" + "r" * 3
    assert chunking.excerpt(["p" * 90, "q"], 4, False) == "p" * 90


def test_query_over_documents(spark):
    import hashlib

    got = {(r.doc_id, r.idx): (r.chunk_md5, r.payload_md5, r.support_chunks) for r in registry.QUERIES["book_chunks"](spark, DATA).collect()}
    want = {}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        chunks = plain_chunks((r.text or "").replace("\n", "\n\n"), 400, 60)
        for k, c in enumerate(chunks):
            text, n, _ = chunking.payload(chunks, k, 900, 2, 120)
            want[r.doc_id, k] = (hashlib.md5(c.encode()).hexdigest(), hashlib.md5(text.encode()).hexdigest(), n)
    assert got == want and any(v[2] == 4 for v in want.values())
