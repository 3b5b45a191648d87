"""Personal data by a character-level bidirectional LSTM with CRF transitions, beside four exact patterns.

The tagger is trained in numpy on generated texts whose spans are known: addresses, numbers and look-alikes
in many spellings between random words. Every kind of span holds a digit or an at-sign, so only windows with
one of them can hold a span; those overlap by half, each is decoded by Viterbi, and each character takes the
label from the window in which it lies furthest from the edges. A tagged span is added when it passes its
kind's check and overlaps no span of the patterns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIGGER = re.compile(r"[0-9@]")
WINDOW = 96


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def valid_ip(text: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return len(parts) == 4 and all(re.fullmatch(r"[0-9]{1,3}", p) and int(p) <= 255 for p in parts)


def valid_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their at-signs, so long runs of letters cost no square."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            # letters before this sign can't belong to an address at a later one
            done = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' spans by start, then kind as listed."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if _TRIGGER.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if valid_ip(m.group())]
        found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if valid_card(m.group())]
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


# The tagger: characters are classes, labels are 0 for none and 1 + the kind's place.
_CLASSES = {c: k for k, c in enumerate(" .-+()@_%,:;/='\"#$!?&*|<>[]\n\t", 4)}
N_CLASSES, N_LABELS = 4 + len(_CLASSES), 1 + len(KINDS)
_ASCII = np.array([_CLASSES.get(chr(c), 3 if chr(c).isdigit() else 2 if chr(c).isupper() else 1) for c in range(128)], np.int8)


def classes(text: str) -> np.ndarray:
    """A class for every character: punctuation is itself, digits, capitals and other letters are one class each."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _ASCII[np.minimum(points, 127)], np.int8(1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lstm(x: np.ndarray, w: dict, keep: bool = False):
    """Hidden states of a batch (rows, steps); with ``keep`` also what the backward pass needs."""
    n, steps = x.shape
    size = w["h"].shape[0]
    h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    out, tape = np.empty((n, steps, size), np.float32), []
    for t in range(steps):
        a = w["x"][x[:, t]] + h @ w["h"]
        gates = _sigmoid(a[:, : 3 * size])
        g = np.tanh(a[:, 3 * size :])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        if keep:
            tape.append((h, before, i, f, o, g, squashed))
        h = o * squashed
        out[:, t] = h
    return out, tape


def _lstm_back(x: np.ndarray, w: dict, tape: list, grad: np.ndarray) -> dict:
    size = w["h"].shape[0]
    gx, gh = np.zeros_like(w["x"]), np.zeros_like(w["h"])
    dh, dc = np.zeros_like(grad[:, 0]), np.zeros_like(grad[:, 0])
    for t in range(x.shape[1] - 1, -1, -1):
        h, before, i, f, o, g, squashed = tape[t]
        dh = dh + grad[:, t]
        dc = dc + dh * o * (1 - squashed**2)
        da = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], 1)
        np.add.at(gx, x[:, t], da)
        gh += h.T @ da
        dh, dc = da @ w["h"].T, dc * f
    return {"x": gx, "h": gh}


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Two LSTMs over a window, one from each end, under a linear-chain CRF."""

    def __init__(self, size: int = 14, seed: int = 17):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.25).astype(np.float32)
        self.forward = {"x": draw(N_CLASSES, 4 * size), "h": draw(size, 4 * size)}
        self.backward = {"x": draw(N_CLASSES, 4 * size), "h": draw(size, 4 * size)}
        self.out, self.bias = draw(2 * size, N_LABELS), np.zeros(N_LABELS, np.float32)
        self.step, self.first = np.zeros((N_LABELS, N_LABELS), np.float32), np.zeros(N_LABELS, np.float32)

    def emissions(self, x: np.ndarray, keep: bool = False):
        a, tape_a = _lstm(x, self.forward, keep)
        b, tape_b = _lstm(x[:, ::-1], self.backward, keep)
        both = np.concatenate([a, b[:, ::-1]], 2)
        return both @ self.out + self.bias, (both, tape_a, tape_b)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the label paths, and its gradients."""
        e, (both, tape_a, tape_b) = self.emissions(x, True)
        n, steps, _ = e.shape
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = self.first + e[:, 0]
        for t in range(1, steps):
            alpha[:, t] = _log_sum(alpha[:, t - 1, :, None] + self.step, 1) + e[:, t]
        for t in range(steps - 2, -1, -1):
            beta[:, t] = _log_sum(self.step + (e[:, t + 1] + beta[:, t + 1])[:, None], 2)
        z = _log_sum(alpha[:, -1], 1)
        seen = np.eye(N_LABELS, dtype=np.float32)[y]
        score = (e * seen).sum((1, 2)) + self.first[y[:, 0]] + self.step[y[:, :-1], y[:, 1:]].sum(1)
        ge = (np.exp(alpha + beta - z[:, None, None]) - seen) / n
        pair = np.exp(alpha[:, :-1, :, None] + self.step + (e[:, 1:] + beta[:, 1:])[:, :, None] - z[:, None, None, None])
        gstep = pair.sum((0, 1)) / n
        np.add.at(gstep, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1 / n)
        gboth = ge @ self.out.T
        size = self.forward["h"].shape[0]
        fwd = _lstm_back(x, self.forward, tape_a, gboth[:, :, :size])
        bwd = _lstm_back(x[:, ::-1], self.backward, tape_b, gboth[:, ::-1, size:])
        return float((z - score).mean()), {"forward.x": fwd["x"], "forward.h": fwd["h"], "backward.x": bwd["x"], "backward.h": bwd["h"], "out": np.einsum("nth,ntk->hk", both, ge), "bias": ge.sum((0, 1)), "step": gstep, "first": ge[:, 0].sum(0)}

    def parameters(self) -> dict:
        return {"forward.x": self.forward["x"], "forward.h": self.forward["h"], "backward.x": self.backward["x"], "backward.h": self.backward["h"], "out": self.out, "bias": self.bias, "step": self.step, "first": self.first}

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The likeliest label path of every window."""
        e, _ = self.emissions(x)
        n, steps, _ = e.shape
        back = np.zeros((n, steps, N_LABELS), np.int8)
        best = self.first + e[:, 0]
        for t in range(1, steps):
            to = best[:, :, None] + self.step
            back[:, t] = to.argmax(1)
            best = to.max(1) + e[:, t]
        path = np.zeros((n, steps), np.int8)
        path[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        return path


def _sample_text(rng: np.random.Generator) -> tuple[str, np.ndarray]:
    """A window of made-up words, personal data and look-alikes, with the label of every character."""
    pick = lambda options: options[int(rng.integers(len(options)))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda a=1, b=9: "".join(rng.choice(list("etaoinshrdlucmfwypvbgkjqxz"), int(rng.integers(a, b + 1))))

    def email() -> str:
        local = word(2, 8) + pick(["", "." + word(2, 8), "_" + word(2, 6), "." + digits(2), digits(2), "+" + word(2, 4)])
        return local + pick(["@", "@", "@", " @ ", "(@)"]) + word(3, 8) + pick(["", digits(1), "-" + word(2, 5)]) + "." + pick([word(2, 3), word(4, 8) + "." + word(2, 3)])

    def ip() -> str:
        return pick([".", ".", ".", " . "]).join(str(x) for x in rng.integers(1, 256, 4))

    def card() -> str:
        d = digits(pick([15, 15, 15, 14, 12]))
        d += next(c for c in "0123456789" if luhn(d + c))
        gap = pick(["", "", " ", "-", ".", "/"])
        return gap.join(d[k : k + 4] for k in range(0, len(d), 4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return pick([f"+{digits(1)} ({a}) {b}-{c}", f"+{digits(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{digits(1)}-{a}-{b}-{c}", f"+{digits(11)}", f"{a} {b}-{c}", f"{a}.{b}.{c}", f"00{digits(2)} {a} {b} {c}"])

    def other() -> str:
        return pick([digits(int(rng.integers(1, 5))), f"{digits(1)}.{digits(1)}", f"{digits(1)}.{digits(1)}.{digits(1)}", f"20{digits(2)}-0{digits(1)}-1{digits(1)}", f"{digits(2)}:{digits(2)}", f"{digits(2)}.{digits(2)}.{digits(4)}", f"${digits(3)},{digits(3)}.{digits(2)}", f"{word(3, 6).upper()}{digits(4)}{word(4, 8).upper()}{digits(2)}", f"{word()}={digits(2)}{word(3, 4)}{digits(5)}{word(2, 5)}{digits(4)}", digits(int(rng.integers(5, 9))), f"{digits(1)},{digits(1)}", f"@{word()}", f"v{digits(1)}", f"{word()}{digits(1)}", f"{digits(2)} {digits(2)} {digits(1)}"])

    makers = (email, ip, card, phone)
    parts, labels = [], []
    while sum(map(len, parts)) < 2 * WINDOW:
        kind = int(rng.integers(-5, 4)) if rng.random() < 0.35 else -9
        piece = word() if kind == -9 else other() if kind < 0 else makers[kind]()
        piece = piece.capitalize() if kind == -9 and rng.random() < 0.2 else piece
        end = pick([" ", " ", " ", " ", ". ", ", ", "\n", ".\n", "; "])
        parts += [piece, end]
        labels += [np.full(len(piece), max(kind + 1, 0)), np.zeros(len(end), int)]
    text, label = "".join(parts), np.concatenate(labels)
    at = int(rng.integers(0, len(text) - WINDOW))
    return text[at : at + WINDOW], label[at : at + WINDOW]


@lru_cache(maxsize=4)
def trained(samples: int = 3000, batches: int = 420, batch: int = 64, seed: int = 23) -> Tagger:
    """A tagger fitted by Adam on ``samples`` generated windows; the same for the same parameters."""
    rng = np.random.default_rng(seed)
    pairs = [_sample_text(rng) for _ in range(samples)]
    x, y = np.stack([classes(t) for t, _ in pairs]).astype(np.int64), np.stack([lab for _, lab in pairs]).astype(np.int64)
    tagger = Tagger()
    first = {k: np.zeros_like(v) for k, v in tagger.parameters().items()}
    second = {k: np.zeros_like(v) for k, v in tagger.parameters().items()}
    for step in range(1, batches + 1):
        rows = rng.integers(0, samples, batch)
        _, grads = tagger.gradients(x[rows], y[rows])
        scale = min(1.0, 5.0 / (np.sqrt(sum((g**2).sum() for g in grads.values())) + 1e-9))
        rate = 0.02 * (1 - step / (batches + 1)) ** 0.7
        for k, p in tagger.parameters().items():
            g = grads[k] * scale
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            p -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return tagger


def _plausible(kind: str, text: str) -> bool:
    n = len(_digits(text))
    if kind == "email":
        local, at, domain = text.partition("@")
        return bool(at) and bool(re.search(r"\w", local)) and "." in domain.strip(".")
    if kind == "ip":
        return valid_ip(re.sub(r"\s", "", text))
    if kind == "card":
        return valid_card(text)
    return 9 <= n <= 15 and bool(re.search(r"[-+(.\s]", text)) and not valid_ip(text)


def tag(tagger: Tagger, texts: list[str], limit: int = 4096) -> list[list[tuple[int, str, int]]]:
    """The tagger's spans of whole texts: windows with a digit or at-sign are decoded and reconciled by character."""
    stride = WINDOW // 2
    where, windows = [], []
    coded: dict[int, np.ndarray] = {}
    labels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    distance = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.int16)

    def settle() -> None:
        if not windows:
            return
        paths = tagger.decode(np.stack(windows).astype(np.int64))
        for (k, start), path in zip(where, paths, strict=True):
            label, depth = labels[k]
            here = slice(start, min(start + WINDOW, len(label)))
            n = here.stop - here.start
            # the ends of a text are no window edges
            d = distance[:n].copy()
            if start == 0:
                d[:stride] = WINDOW
            if here.stop == len(label):
                d[n // 2 :] = WINDOW
            closer = d > depth[here]
            label[here] = np.where(closer, path[:n], label[here])
            depth[here] = np.where(closer, d, depth[here])
        where.clear()
        windows.clear()

    for k, text in enumerate(texts):
        if not _TRIGGER.search(text):
            continue
        code = coded[k] = classes(text)
        labels[k] = np.zeros(len(code), np.int8), np.full(len(code), -1, np.int16)
        marks = np.flatnonzero((code == 3) | (code == _CLASSES["@"]))
        starts = np.unique(np.concatenate([marks // stride, marks // stride - 1])) * stride
        for start in starts[starts >= 0]:
            piece = code[start : start + WINDOW]
            windows.append(np.concatenate([piece, np.zeros(WINDOW - len(piece), np.int8)]))
            where.append((k, int(start)))
            if len(windows) >= limit:
                settle()
    settle()
    out: list[list[tuple[int, str, int]]] = [[] for _ in texts]
    for k, (label, _) in labels.items():
        edges = np.flatnonzero(np.diff(label, prepend=0, append=0))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if not label[a]:
                continue
            kind, piece = KINDS[label[a] - 1], texts[k][a:b]
            start = int(a) + len(piece) - len(piece.lstrip(" \n\t.,;:"))
            end = int(b) - (len(piece) - len(piece.rstrip(" \n\t.,;:")))
            if start < end and _plausible(kind, texts[k][start:end]):
                out[k].append((start, kind, end))
    return out


def _find(tagger: Tagger, texts: list[str]) -> list[tuple[list, list]]:
    out = []
    for text, tagged in zip(texts, tag(tagger, texts), strict=True):
        base = base_spans(text)
        added = [s for s in tagged if all(s[2] <= b[0] or s[0] >= b[2] for b in base)]
        out.append((base, sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[1]), s[2]))))
    return out


def _listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def find(docs: DataFrame, tagger: Tagger, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The spans of every document as text lists ``kind:start:end`` in code points: the patterns' and all.

    Null texts are empty: no spans. Rows are independent: repeated rows give repeated results, an empty table
    none; other columns are ignored. There is no shuffle.
    """
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _find(tagger, [t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_listed(b) for b, _ in found], pa.string()), pa.array([_listed(s) for _, s in found], pa.string())], [id_column, "base_spans", "spans"])

    return docs.select(id_column, F.col(text_column).cast("string").alias(text_column)).mapInArrow(run, f"{id_column} {kind}, base_spans string, spans string")


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts of the base spans by kind with their digest, and all spans."""
    counts = [F.size(F.expr(f"filter(split(base_spans, ','), s -> startswith(s, '{k}:'))")).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(id_column, *counts, F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans")


def redact(docs: DataFrame, tagger: Tagger, text_column: str = "text") -> DataFrame:
    """The rows, all columns kept, with every span of the text replaced by its kind in angle brackets; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(text_column)
            texts = batch.column(k).to_pylist()
            out = []
            for text, (_, spans) in zip(texts, _find(tagger, [t or "" for t in texts]), strict=True):
                if text is not None and spans:
                    parts, at = [], 0
                    for a, kind, b in spans:
                        if a >= at:
                            parts += [text[at:a], f"<{kind}>"]
                        at = max(at, b)
                    text = "".join([*parts, text[at:]])
                out.append(text)
            yield batch.set_column(k, batch.schema.field(k), pa.array(out, batch.schema.field(k).type))

    return docs.mapInArrow(run, docs.schema)
