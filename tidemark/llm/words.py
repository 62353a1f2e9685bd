"""Words and hashes of a batch of texts, straight from Arrow buffers, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_random = np.random.Generator(np.random.PCG64(20240611))
_CODES = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_STEP = 1 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text begins and, last, ends; a missing text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, ends: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last-plus-one byte of every word, and the number of its first word for each text (and the total)."""
    filled = ~space[data]
    begins, stops = filled.copy(), filled.copy()
    begins[1:] &= ~filled[:-1]
    stops[:-1] &= ~filled[1:]
    inner = ends[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = filled[inner]
    stops[inner - 1] = filled[inner - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return first, last, np.searchsorted(first, ends)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose result bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_STEP, _BASE), _powers(_STEP, pow(_BASE, -1, 2**64))


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word over random byte codes; its value is the same in every batch."""
    out = np.zeros(len(first), dtype=np.uint64)
    lo = 0
    while lo < len(first):
        # Whole words that fit the table of powers; a longer word is hashed in pieces of its own.
        hi = max(lo + 1, int(np.searchsorted(last, first[lo] + _STEP, side="right")))
        a, b = int(first[lo]), int(last[hi - 1])
        if b - a > _STEP:
            value = 0
            for i in range(a, b, _STEP):
                piece = _CODES[data[i : min(b, i + _STEP)]]
                value = (value + int((piece * _UP[: len(piece)]).sum(dtype=np.uint64)) * pow(_BASE, i - a, 2**64)) % 2**64
            out[lo] = value
        else:
            sums = np.zeros(b - a + 1, dtype=np.uint64)
            np.cumsum(_CODES[data[a:b]] * _UP[: b - a], out=sums[1:])
            out[lo:hi] = (sums[last[lo:hi] - a] - sums[first[lo:hi] - a]) * _DOWN[first[lo:hi] - a]
        lo = hi
    return mix(out)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the windows of ``width`` words; fewer words are one window, none are no window."""
    n = len(words)
    if n == 0:
        return words
    width_here = min(width, n)
    value = np.full(n - width_here + 1, 0x5851F42D4C957F2D if width_here == width else 0x14057B7EF767814F + n, dtype=np.uint64)
    for i in range(width_here):
        value = mix(value * np.uint64(0xD1342543DE82EF95) + words[i : n - width_here + 1 + i])
    return np.unique(value)


def all_shingles(words: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of ``shingles`` for many texts, whose words begin at ``at``, with the text of each; repeats stay."""
    counts = np.diff(at)
    owner = np.repeat(np.arange(len(counts)), counts)
    value = np.full(max(0, len(words) - width + 1), 0x5851F42D4C957F2D, dtype=np.uint64)
    for i in range(width if len(value) else 0):
        value = mix(value * np.uint64(0xD1342543DE82EF95) + words[i : len(words) - width + 1 + i])
    inside = owner[: len(value)] == owner[width - 1 :] if len(value) else np.zeros(0, dtype=bool)
    few = [(n, shingles(words[at[n] : at[n + 1]], width)) for n in np.flatnonzero((counts > 0) & (counts < width))]
    values = np.concatenate([value[inside], *(v for _, v in few)])
    return values, np.concatenate([owner[: len(value)][inside], *(np.full(len(v), n) for n, v in few)]).astype(np.int64)


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The shingle set of every text, in lower case (A-Z only)."""
    data, ends = text_bytes(column)
    data = LOWER[data]
    first, last, at = spans(data, ends)
    hashes = word_hashes(data, first, last)
    return [shingles(hashes[at[i] : at[i + 1]], width) for i in range(len(at) - 1)]
