"""Vectorised word and hash helpers over the UTF-8 bytes of Arrow string columns.

A word is a maximal run of bytes outside space and 0x09-0x0D; words never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string or binary column; null is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, one row at least: bounds the memory of vectorised work."""
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = max(start + 1, stop)
        yield start, stop
        start = stop


def spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word."""
    n = len(raw)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = inside[last]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, "right") - 1


def chunks(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one number; beyond the end they are zero."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    return np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))


_MASKS = np.array([0] + [(1 << 8 * k) - 1 for k in range(1, 9)], np.uint64)


def masks(length: np.ndarray) -> np.ndarray:
    """What keeps so many of eight bytes."""
    return _MASKS[length]


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte span: each eight bytes are mixed with their number before they are added.

    The mixing leaves no algebra of positions to collide by, as powers of a base modulo 2**64 have.
    """
    length = (end - start).astype(np.int64)
    out = mix(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    if not len(start):
        return out
    at = chunks(raw)
    # most spans are words of up to eight bytes: one step for all, the long ones go on in pieces of bounded size
    out += mix(at[start] & _MASKS[np.minimum(length, 8)])
    long_ = np.flatnonzero(length > 8)
    steps = (length[long_] - 1) // 8
    edges = np.searchsorted(np.cumsum(steps), np.arange(0, steps.sum(), 1 << 18)[1:], "left")
    for part in np.split(np.arange(len(long_)), np.unique(edges)):
        if not len(part):
            continue
        who, n = long_[part], steps[part]
        first = np.cumsum(n) - n
        number = np.arange(n.sum()) - np.repeat(first, n) + 1
        owner = np.repeat(who, n)
        left = np.minimum(length[owner] - 8 * number, 8)
        value = at[start[owner] + 8 * number] & _MASKS[left]
        out[who] += np.add.reduceat(mix(value ^ mix(number.astype(np.uint64))), first)
    return mix(out)


def shingles(hashes: np.ndarray, row: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``size`` words; a row with fewer words gives one shingle of all of them, none if it has none."""
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)])
    grams, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(hashes) - size + 1
    if n > 0:
        grams = np.zeros(n, np.uint64)
        for k in range(size):
            grams = grams * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n]
        whole = row[:n] == row[size - 1 :]
        grams, rows = mix(grams[whole]), row[:n][whole]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        few = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = count[short] > k
            few[has] = few[has] * np.uint64(0xA3B195354A39B70D) + hashes[first[short[has]] + k] + np.uint64(k)
        grams, rows = np.concatenate([grams, mix(few)]), np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        grams, rows = grams[order], rows[order]
    return grams, rows
