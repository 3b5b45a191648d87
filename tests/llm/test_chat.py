import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuskb.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.text(alphabet=st.sampled_from(list("ab \n\\<|>/#é🙂日endtursay")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<|end|>", ""]), TEXT), max_size=6))
def test_round_trip_and_mask(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    encoded = chat.encode_marked(PATH, text)
    flags = chat.mask(encoded, [s for s, t in zip(spans, turns, strict=True) if t[0] == "assistant"])
    assert "".join(chat.under_mask(text, encoded, flags)) == "".join(t for r, t in turns if r == "assistant")


def test_rows(spark):
    rows = [(1, 1, "assistant", "hi"), (1, 0, "user", None), (2, 0, None, "x<|end|>"), (None, 0, "assistant", "n"), (1, 2, "assistant", "hi"), (1, 2, "assistant", "hi"), (3, None, "assistant", "🙂" * 3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as n_turns", "2 as formatted")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df, PATH)).collect()}
    assert got[1].n_turns == 4 and got[1].loss_chars == 6
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nhi\nassistant\nhi\nassistant\nhi\n").hexdigest()
    assert got[2].loss_chars == 0 and got[None].loss_chars == 1 and got[3].loss_chars == 3000
    assert chat.digests(chat.format_conversations(df.limit(0), PATH)).count() == 0
