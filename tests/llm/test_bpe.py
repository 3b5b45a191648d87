import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from corpuskb.llm.bpe import encode_decode, tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


def ids_of(text):
    import numpy as np

    return np.frombuffer(b"".join(tokenizer(PATH).encode(text)), "<u4").tolist()


def cases():
    rng = random.Random(5)
    yield from ["", " ", "a", "  a  b \n\n c", "it's we'll'd  ", "<|endoftext|>x<|endoftext|>", "\x1c\x85 \xa0 a", "été ñ 日本語 🙂🙂", "a" * 9000, "-=" * 5000, " " * 9000, "word" * 4000, "x \n" * 4000, "​﻿'S 'T 12ab"]
    for alphabet in ("ab ", "the in g\n", "=-_*#", "aàé ñß'1", "\n\t \r"):
        for n in (7, 60, 400, 12000):
            yield "".join(rng.choice(alphabet) for _ in range(n))
    for _ in range(300):
        yield "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(9, 14), rng.randrange(0x80, 0x3100), 32])) for _ in range(rng.randrange(40)))


def test_ids_equal_the_library(library):
    for text in cases():
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(text) == want, text[:80]
        assert "".join(tokenizer(PATH).decode(tokenizer(PATH).encode(text))) == library.decode(want, skip_special_tokens=False)


def test_streaming_equals_whole(library):
    t = tokenizer(PATH)
    rng = random.Random(1)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "=-", "aeiou", "0123456789", "etaoinshr"):
        text = "".join(rng.choice(alphabet) for _ in range(20000))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(text) == want
        assert 0 < t.lookahead < 4096


def test_rows_and_edges(spark):
    rows = [(1, None), (2, ""), (3, "hello world"), (3, "hello world"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens", "'q' as key")
    out = encode_decode(df, PATH, keep_output=True).collect()
    assert len(out) == 5
    empty = hashlib.sha256(b"").hexdigest()
    for r in out:
        if r.doc_id in (1, 2):
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, empty, empty)
        if r.doc_id == 3:
            assert r.n_tokens == 2 and r.decoded == "hello world"
    assert encode_decode(df.limit(0), PATH).count() == 0
