"""Words and shingle hashes of Arrow text columns, computed in numpy.

Whole texts are handled in pieces of bounded size, so a task's memory follows
the piece and the number of words, never a multiple of a long text.  All word
separators used here are ASCII, so splitting UTF-8 bytes equals splitting code
points.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

PIECE = 1 << 20  # bytes hashed at once
LONG_WORD = 1 << 16  # longer words are hashed one by one
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def _word_bytes(kind: str) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    if kind == "space":  # [^\x20\x09-\x0D]+
        table[[0x20, *range(0x09, 0x0E)]] = False
    elif kind == "alnum":  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, capitals are lowered first
        table[:0x30] = False
        table[0x3A:0x61] = False
        table[0x7B:0x80] = False
        table[0x41:0x5B] = True
    else:
        raise ValueError(kind)
    return table


WORD_BYTES = {k: _word_bytes(k) for k in ("space", "alnum")}


@lru_cache(maxsize=None)
def byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
    if lower:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


@lru_cache(maxsize=None)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD6E8FEB86659FD93
    inverse = pow(base, -1, 2**64)
    up = np.full(n, base, dtype=np.uint64)
    down = np.full(n, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit (x is overwritten)."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string or binary column;
    nulls are empty."""
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        width = np.int64
    elif pa.types.is_string(col.type) or pa.types.is_binary(col.type):
        width = np.int32
    else:
        col, width = col.cast(pa.string()), np.int32
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    _, where, data = col.buffers()
    if len(col) == 0 or where is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(where, width)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def pieces(offsets: np.ndarray, limit: int = 4 * PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, or one longer row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        to = min(max(to, row + 1), rows)
        yield row, to
        row = to


def words(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each row (one
    more entry than rows).  `offsets` are relative to `data`."""
    inside = WORD_BYTES[kind][data]
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True  # a word ends with its row
    starts = np.flatnonzero(edge[:-1] & inside)
    ends = np.flatnonzero(edge[1:] & inside) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each word; equal words have equal hashes everywhere."""
    out = np.empty(len(starts), dtype=np.uint64)
    values = byte_values(lower)
    size = PIECE + LONG_WORD
    up, down = powers(size)
    at = 0
    while at < len(starts):
        if ends[at] - starts[at] > LONG_WORD:
            word = data[starts[at] : ends[at]].tobytes()
            out[at] = xxhash.xxh64_intdigest(word.lower() if lower else word, seed=7)  # bytes.lower() folds A-Z only
            at += 1
            continue
        begin = starts[at]
        to = int(np.searchsorted(ends, begin + PIECE, side="right"))
        to = max(to, at + 1)
        far = np.flatnonzero(ends[at:to] - starts[at:to] > LONG_WORD)
        if len(far):
            to = at + int(far[0])
        total = np.zeros(ends[to - 1] - begin + 1, dtype=np.uint64)
        np.cumsum(values[data[begin : ends[to - 1]]] * up[: len(total) - 1], out=total[1:])
        a, b = starts[at:to] - begin, ends[at:to] - begin
        out[at:to] = mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64) * _ODD)
        at = to
    return out


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k neighbouring words (rows are not told apart)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n] * _ODD + _U(k)
    for j in range(1, k):
        out ^= out >> _U(29)
        out *= _U(0xBF58476D1CE4E5B9)
        out += hashes[j : j + n]
    return mix(out)


def shingle_sets(col: pa.Array, k: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each row: lower-cased words of
    the whole text, k to a shingle; a shorter text is one shingle; no words,
    none."""
    raw, offsets = column_bytes(col)
    for first, last in pieces(offsets):
        data = raw[offsets[first] : offsets[last]]
        own = offsets[first : last + 1] - offsets[first]
        starts, ends, of = words(data, own, "space")
        hashed = word_hashes(data, starts, ends, lower=True)
        shingles = window_hashes(hashed, k)
        for row in range(first, last):
            a, b = of[row - first], of[row - first + 1]
            if b - a >= k:
                yield row, np.unique(shingles[a : b - k + 1])
            elif b > a:
                yield row, window_hashes(hashed[a:b], int(b - a))
            else:
                yield row, np.zeros(0, dtype=np.uint64)
