"""Words and word shingles of many texts at once, with numpy over Arrow buffers.

A word's hash is a polynomial over its bytes (mod 2**64), taken from prefix sums over the whole
buffer, so that no Python code runs for a single word. A shingle's hash mixes its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = [np.uint64(x | 1) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
#: Tables of bytes: A-Z lower-cased, and a space for all that separates words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[0x09:0x0E] = 32
#: Here all other than letters, digits and non-ASCII characters separates words.
LETTERS = LOWER.copy()
LETTERS[[c for c in range(128) if not chr(c).isalnum()]] = 32
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * _MIX[0]
        x = x ^ (x >> np.uint64(27))
        x = x * _MIX[1]
        return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** k and its inverse, for k < n at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * SLICE_BYTES)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS.clear()
        with np.errstate(over="ignore"):
            for b in (_BASE, inverse):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0][:n], _POWERS[1][:n]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in them) of parts of about SLICE_BYTES; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        last = min(last, n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = LOWER, prefix: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, lower-cased, and the places in them where each row starts (rows + 1).

    prefix: only that many first bytes of a word count, if not 0.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = table[data]
    word = low != 32
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    if prefix:
        ends = np.minimum(ends, starts + prefix)
    power, inverse = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _MIX[2])
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(words: np.ndarray, rows: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each row, concatenated, and where each row starts.

    A row with fewer words has its whole sequence as one shingle; a row without words has none.
    """
    sets, sizes = [], np.zeros(len(rows), np.int64)
    with np.errstate(over="ignore"):
        if len(words) >= width:
            m = len(words) - width + 1
            grams = words[:m] * _MIX[0]
            for k in range(1, width):
                grams = mix(grams) + words[k : k + m] * _MIX[k % len(_MIX)]
            grams = mix(grams)
        for r in range(len(rows) - 1):
            a, b = int(rows[r]), int(rows[r + 1])
            if b - a >= width:
                own = np.sort(grams[a : b - width + 1])
                keep = np.empty(len(own), bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                own = own[keep]
            elif b > a:
                g = words[a : a + 1] * _MIX[0]
                for k in range(1, b - a):
                    g = mix(g) + words[a + k : a + k + 1] * _MIX[k]
                own = mix(g + np.uint64(b - a))
            else:
                continue
            sets.append(own)
            sizes[r + 1] = len(own)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum(sizes)
