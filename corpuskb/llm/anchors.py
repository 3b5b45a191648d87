"""Anchors of byte strings: every string of ``LENGTH`` bytes holds one, at the same place in each of its copies.

The anchor of a window of LENGTH bytes is the leftmost of its runs of ``GRAM`` bytes with the least hash. Windows
of one text whose anchor is the same run are neighbours; they are the anchor's windows.
"""

from __future__ import annotations

import numpy as np

from corpuskb.llm import words

GRAM = 40


#: Odd factors of the eight-byte pieces of a run.
_FACTORS = [np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64) | 1) for k in range(1, GRAM // 8 + 1)]


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every position that has so many behind it."""
    piece = words.mix(words.chunks(raw)[: len(raw) - 7].copy())
    n = len(raw) - GRAM + 1
    h = np.zeros(n, np.uint64)
    for k, factor in enumerate(_FACTORS):
        h += piece[8 * k : 8 * k + n] * factor
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def find(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(hash, anchor position, first window, end of windows) of every anchor of a block of texts."""
    none = np.zeros(0, np.int64)
    n = len(raw) - length + 1
    if n < 1:
        return np.zeros(0, np.uint64), none, none, none
    h = gram_hashes(raw)
    width = length - GRAM + 1
    # least of ``width`` neighbours by doubling
    least, span = h, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[width - span : width - span + n])
    # windows within one text
    whole = np.ones(n, bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        whole[max(a, b - length + 1) : b] = False
    begins = whole.copy()
    begins[1:] &= (least[1:] != least[:-1]) | ~whole[:-1]
    first = np.flatnonzero(begins)
    if not len(first):
        return np.zeros(0, np.uint64), none, none, none
    ends = np.flatnonzero(whole & ~np.append(whole[1:], False)) + 1
    stop = np.minimum(np.append(first[1:], n), ends[np.searchsorted(ends, first, "right")])
    value = least[first]
    # places of a stretch's value from its first window to the end of its last: nearly always one
    lengths = stop - first + width - 1
    index = np.repeat(first - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    owner = np.repeat(np.arange(len(first)), lengths)
    hit = np.flatnonzero(h[index] == value[owner])
    place, owner = index[hit], owner[hit]
    # a place owns the windows behind the place before it, up to itself
    before = np.concatenate([[-1], place[:-1]])
    before[np.concatenate([[True], owner[1:] != owner[:-1]])] = -1
    a = np.maximum(first[owner], before + 1)
    b = np.minimum(stop[owner], place + 1)
    keep = a < b
    return value[owner[keep]], place[keep], a[keep], b[keep]
