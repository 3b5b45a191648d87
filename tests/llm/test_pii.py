import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuskb.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1.@-+ %é")), max_size=40))
def test_emails_equal_the_pattern(text):
    assert list(pii._emails(text)) == [m.span() for m in EMAIL.finditer(text)]


def test_base_patterns():
    text = "x a.b@c.de 1.2.3.4 256.1.1.1 4111 1111 1111 1111 +1 (724) 555-7058"
    found = {(k, text[a:b]) for a, k, b in pii.base_spans(text)}
    assert {("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("phone", "+1 (724) 555-7058")} <= found
    assert not any(k == "ip" and t.startswith("256") for k, t in found)
    assert pii.base_spans("") == [] and pii.base_spans("9" * 5000) == []
    assert pii.base_spans("4111111111111111") == [(0, "card", 16)]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    t = pii.Tagger(size=3)
    for part in (t.forward, t.backward):
        for k in part:
            part[k] = part[k].astype(float)
    t.out, t.bias, t.first = t.out.astype(float), t.bias.astype(float), rng.standard_normal(pii.N_LABELS)
    t.step = rng.standard_normal((pii.N_LABELS, pii.N_LABELS))
    x, y = rng.integers(0, pii.N_CLASSES, (3, 6)), rng.integers(0, pii.N_LABELS, (3, 6))
    _, grads = t.gradients(x, y)
    for k, p in t.parameters().items():
        at = (int(x[0, 2]), 1) if k.endswith(".x") else tuple(0 for _ in p.shape)
        old = p[at]
        p[at] = old + 1e-3
        up = t.gradients(x, y)[0]
        p[at] = old - 1e-3
        down = t.gradients(x, y)[0]
        p[at] = old
        assert abs(grads[k][at] - (up - down) / 2e-3) < 1e-4


def test_tagger_on_held_out_windows():
    t = pii.trained()
    rng = np.random.default_rng(99)
    pairs = [pii._sample_text(rng) for _ in range(200)]
    x, y = np.stack([pii.classes(a) for a, _ in pairs]).astype(int), np.stack([b for _, b in pairs])
    assert (t.decode(x) == y).mean() > 0.97


def test_long_texts_do_not_depend_on_windows_and_rows_have_edges(spark):
    t = pii.trained()
    filler = "lorem ipsum dolor " * 40
    long = filler + "call (555) 123-4567 now " + filler + "a@b.co " + filler
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "1.2.3.4"), (4, "no data here"), (5, "w" * 50000 + "@")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as spans", "1 as n_email")
    got = {r.doc_id: r for r in pii.digests(pii.find(df, t)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    for k in (1, 2, 4, 5):
        assert got[k].base_sha256 == empty and got[k].spans == "" and got[k].n_email == 0
    assert got[3].n_email == 1 and "phone:" in got[3].spans and got[3].n_phone == 0
    assert got[None].n_ip == 1 and got[None].spans == "ip:0:7"
    assert pii.find(df.limit(0), t).count() == 0
    red = {r.doc_id: r.text for r in pii.redact(df, t).collect()}
    assert red[1] is None and "<email>" in red[3] and "<phone>" in red[3] and red[None] == "<ip>"
