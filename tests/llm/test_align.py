import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer as Library

from corpuskb.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(texts):
    """The contract's rows by byte offsets of whole texts, encoded by the libraries themselves."""
    library, pieces = Library.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    from corpuskb.llm.bpe import tokenizer

    bytes_a, rows, pairs = tokenizer(A).token_bytes, [], Counter()
    for i, text in texts:
        a, b = [], []
        if text:
            a, b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        spelled_a = [bytes_a[x] for x in a]
        spelled_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(x) else p.replace("▁", " ").encode() for x, p in ((x, pieces.id_to_piece(x)) for x in b)]
        if b"".join(spelled_a) != (" " + (text or "")).encode() or b"".join(spelled_b) != b"".join(spelled_a):
            a, b, spelled_a, spelled_b = [], [], [], []
        ends_a, ends_b, at = {}, {}, 0
        for k, s in enumerate(spelled_a):
            at += len(s)
            ends_a[at] = k
        at = 0
        for k, s in enumerate(spelled_b):
            at += len(s)
            ends_b[at] = k
        common = sorted(set(ends_a) & set(ends_b))
        links = [(a[ends_a[e]], b[ends_b[e]]) for e in common]
        groups, i0, j0 = [], 0, 0
        for e in common:
            i1, j1 = ends_a[e] + 1, ends_b[e] + 1
            groups.append(",".join(map(str, a[i0:i1])) + "|" + ",".join(map(str, b[j0:j1])))
            i0, j0 = i1, j1
        pairs.update(links)
        rows.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = {}
    for (_, y), n in pairs.items():
        most[y] = max(most.get(y, 0), n)
    return [(i, n_a, n_b, g, len(links), sum(pairs[p] == most[p[1]] for p in links), sum(pairs[p] for p in links), d) for i, n_a, n_b, g, links, d in rows]


def key(row):
    return tuple(map(str, row))


TEXTS = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "<|endoftext|> <s> plain </s><unk><0x0A>"),
    (5, "under▁line"),
    (6, "naïve 日本語 🙂🙂 \x00 ​ zero width ﻿"),
    (7, "tabs\t\tand\n\n  lines   \r\n x"),
    (7, "tabs\t\tand\n\n  lines   \r\n x"),
    (None, "no id at all"),
    (8, "antidisestablishmentarianism's " * 50),
    (9, "word, and more of it.  " * 9000),
    (10, "y" * 70_000 + " end"),
]


def test_rows_equal_byte_offsets(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("*", "1 as key", "2 as a", "3 as n").repartition(3)
    got = align.summarize(df, A, B).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain(TEXTS), key=key)
    empty = align.summarize(df.limit(0), A, B)
    assert empty.count() == 0 and empty.columns == list(got[0].asDict())


def test_query_over_documents(spark):
    from corpuskb.llm import queries

    got = queries.op11_align(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain([tuple(r) for r in docs]), key=key)


def test_groups_are_kept_on_demand(spark):
    df = spark.createDataFrame([(1, "un deux"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in align.groups(df, A, B, keep_groups=True).collect()}
    assert hashlib.sha256(rows[1].groups.encode()).hexdigest() == rows[1].groups_sha256 and rows[1].n_groups == rows[1].groups.count("|")
    assert rows[2].groups == "" and rows[2].groups_sha256 == ""


def test_transducer_states_are_suffixes_and_remembered():
    spelled_a, spelled_b = [b"ab", b"c", b"abc", b"a"], [b"a", b"bc", b"abc", b"b"]
    t = align.Transducer(spelled_a, spelled_b)
    # ab|c against a|bc: one group; then abc against abc
    assert t.ends([0, 1, 2], [0, 1, 2]) == ([2, 3], [2, 3])
    assert t.ends([3, 0, 1], [0, 2]) == ([1, 3], [1, 2])
    suffixes = {s[k:] for s in spelled_a + spelled_b for k in range(len(s))}
    assert all(rest in suffixes for _, rest in t._states if rest)
    with pytest.raises(ValueError):
        t.ends([0, 1], [0, 0])


def test_blocks_cut_where_neither_side_has_tokens_across():
    both = align.aligner(A, B)
    text = ("some words \n and  more " * 9000)[:-1]
    assert both.cuts and "".join(both.blocks(text)) == " " + text and len(list(both.blocks(text))) > 1
