import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer as Library

from corpuskb.llm.packing import pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_every_token_in_one_piece(spark):
    library = Library.from_file(PATH)
    rows = [(1, None), (2, ""), (3, "hello world " * 3000), (4, "a<|endoftext|>b"), (5, "x  \n\n y été 日本 \x1c z"), (5, "x"), (None, "n"), *((k, f"word{k} and more " * (k % 40)) for k in range(10, 80))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n", "3 as part").repartition(5)
    got = pack(df, PATH, 256, keep_ids=True).collect()
    expect = {}
    for i, t in rows:
        expect.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [1])
    total = sum(len(x) for v in expect.values() for x in v)
    assert sum(r.length for r in got) == total
    taken = sorted((r.sequence_id, r.offset, r.length) for r in got)
    at = 0
    for sequence, offset, length in taken:
        assert sequence * 256 + offset == at and offset + length <= 256
        at += length
    assert at == total
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(ids) == r.length
        assert any(ids == x[r.start : r.start + r.length] and r.doc_tokens == len(x) for x in expect[r.doc_id])
        last = total // 256
        rest = total % 256
        assert r.padded_to == (256 if r.sequence_id < last or rest & (rest - 1) else rest)
    assert pack(df.limit(0), PATH).count() == 0
