"""Chat formatting with offset-aligned masks.

A conversation is rendered as one text, its turns between marks that are special tokens, so no token can
lie across a mark. The whole text is encoded once with offsets; the sorted character spans of the
assistant's turns are cut with the sorted token spans by binary search, which gives the tokens under loss.
Inside roles and texts a bar behind ``<`` and every backslash gets a backslash before it: no text can hold
a mark, and the original comes back by dropping each first backslash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, SAY, END = "<|turn|>", "<|say|>", "<|end|>"
_RISKY = re.compile(r"\\|(?<=<)\|")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURNS = re.compile(r"<\|turn\|>(.*?)<\|say\|>(.*?)<\|end\|>", re.DOTALL)


def escape(text: str) -> str:
    return _RISKY.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text and the character span of each turn's content in it."""
    parts, at, spans = [], 0, []
    for role, text in turns:
        head = TURN + escape(role) + SAY
        body = escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at = spans[-1][1] + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURNS.finditer(formatted)]


@dataclass
class Encoded:
    ids: np.ndarray
    start: np.ndarray
    end: np.ndarray


_libraries: dict = {}


def encode_marked(path: str, text: str) -> Encoded:
    """Ids and character spans of a rendered text; the marks are tokens of their own behind the vocabulary."""
    if path not in _libraries:
        from tokenizers import AddedToken, Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        t.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (TURN, SAY, END)])
        _libraries[path] = t
    got = _libraries[path].encode(text, add_special_tokens=False)
    offsets = np.array(got.offsets, np.int64).reshape(-1, 2)
    return Encoded(np.array(got.ids, np.int64), offsets[:, 0], offsets[:, 1])


def mask(encoded: Encoded, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens touch one of the sorted, disjoint character spans.

    Tokens of one character share its span, so both ends of the tokens are sorted as well.
    """
    out = np.zeros(len(encoded.ids) + 1, np.int64)
    for a, b in spans:
        if b > a:
            out[np.searchsorted(encoded.end, a, "right")] += 1
            out[np.searchsorted(encoded.start, b, "left")] -= 1
    return np.cumsum(out[:-1]) > 0


def under_mask(formatted: str, encoded: Encoded, flags: np.ndarray) -> list[str]:
    """The unescaped text of every maximal run of flagged tokens."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [unescape(formatted[encoded.start[a] : encoded.end[b - 1]]) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def format_conversations(rows: DataFrame, path: str, learn: str = "assistant") -> DataFrame:
    """One row per conversation: its rendered text, ids, loss mask and number of turns.

    Turns are ordered by turn, ties by role and text; null turns come first, null roles and texts are empty,
    and a null conv_id is a conversation of its own. Repeated rows are repeated turns. Turns of other roles
    than ``learn`` bear no loss. A conversation is one output text, so its turns meet in one task; other
    columns are ignored, and an empty table gives no rows.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, turns in zip(frame["conv_id"], frame["turns"], strict=True):
                turns = [(t["role"], t["text"]) for t in turns]
                formatted, spans = render(turns)
                encoded = encode_marked(path, formatted)
                flags = mask(encoded, [s for s, (role, _) in zip(spans, turns, strict=True) if role == learn])
                out.append((key, len(turns), formatted, encoded.ids.astype(np.int32), flags.astype(np.int8), encoded.start, encoded.end))
            yield pd.DataFrame(out, columns=["conv_id", "n_turns", "formatted", "ids", "loss_mask", "token_start", "token_end"])

    chosen = rows.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))).alias("t"))
    kind = dict(rows.dtypes)["conv_id"]
    schema = f"conv_id {kind}, n_turns long, formatted string, ids array<int>, loss_mask array<tinyint>, token_start array<long>, token_end array<long>"
    return chosen.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).mapInPandas(run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: turns, and the text under the loss mask."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, text, ids, flags, start, end in zip(*(frame[c] for c in ("conv_id", "formatted", "ids", "loss_mask", "token_start", "token_end")), strict=True):
                turns = parse(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                learned = "".join(under_mask(text, Encoded(ids, start, end), np.asarray(flags)))
                out.append((key, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text), len(ids), int(np.sum(flags))))
            yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"])

    kind = dict(formatted.dtypes)["conv_id"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long"
    return formatted.select("conv_id", "formatted", "ids", "loss_mask", "token_start", "token_end").mapInPandas(run, schema)
