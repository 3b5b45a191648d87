import numpy as np
import pytest

from corpuskb.llm import rules, words


def thue_morse(n):
    return "".join("ab"[k.bit_count() & 1] for k in range(n))


@pytest.mark.parametrize("n", [8, 64, 1024, 2048, 4096, 65536])
def test_hashes_of_thue_morse_strings_differ(n):
    a = thue_morse(n)
    b = a.translate(str.maketrans("ab", "ba"))
    h = words.span_hashes(np.frombuffer((a + b + a).encode(), np.uint8), np.arange(3) * n, np.arange(1, 4) * n)
    assert h[0] == h[2] != h[1]


def test_hashes_depend_on_the_span_alone():
    rng = np.random.default_rng(3)
    raw = rng.integers(0, 3, 3000).astype(np.uint8)
    start = rng.integers(0, 2900, 4000)
    end = start + rng.integers(0, 40, 4000)
    seen = {}
    for h, a, b in zip(words.span_hashes(raw, start, end).tolist(), start, end, strict=True):
        assert seen.setdefault(h, raw[a:b].tobytes()) == raw[a:b].tobytes()
    assert len(seen) == len(set(seen.values()))


def test_lines_that_differ_are_no_copies(spark):
    a = thue_morse(1024)
    b = a.translate(str.maketrans("ab", "ba"))
    raw = np.frombuffer(f"{a}\n{b}\n{a}".encode(), np.uint8)
    found = rules.statistics(raw, np.array([0, len(raw)]))
    assert found["n_dup_lines"].tolist() == [1]
