"""64-bit hashes of all words of many texts at once, from their UTF-8 bytes.

The hash of a word is a polynomial in a fixed odd base, modulo 2^64, over random values of its
bytes: differences of one running sum give every word's hash without a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: The base's inverse modulo 2^64.
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PIECE = 1 << 20

_VALUES = np.random.default_rng(20240).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_VALUES[65:91] = _VALUES[97:123]  # A-Z count as a-z
#: Bytes that belong to words: all but the six blanks, or ASCII letters and digits and all of other scripts.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[32, *range(9, 14)]] = False
LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * PIECE)
        _powers = tuple(np.concatenate([np.ones(1, dtype=np.uint64), np.cumprod(np.full(size - 1, b, dtype=np.uint64))]) for b in (_BASE, _INVERSE))
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashed(data: np.ndarray, first: np.ndarray, word: np.ndarray, beginnings: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes [words x (1 + beginnings)]) of the words of ``data``; a text begins at each of ``first``.

    The hash of a beginning of n bytes is 0 for words of n bytes or less.
    """
    inside = word[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    at = first[(first > 0) & (first < len(data))]
    start[at] = inside[at]
    end[at - 1] = inside[at - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    power, inverse = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * power[:len(data)], out=sums[1:])
    out = np.zeros((len(s), 1 + len(beginnings)), dtype=np.uint64)
    out[:, 0] = mixed((sums[e] - sums[s]) * inverse[s])
    for k, n in enumerate(beginnings, 1):
        long = e - s > n
        out[long, k] = mixed((sums[s[long] + n] - sums[s[long]]) * inverse[s[long]] + np.uint64(n))
    return s, out


def word_hashes(texts: pa.Array, word: np.ndarray = NOT_BLANK, beginnings: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(words of each text, their hashes in order) of a string array; a null text has none."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    _, _, raw = texts.buffers()
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if texts.null_count:
        texts = texts.fill_null("")
        _, _, raw = texts.buffers()
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    count = np.zeros(len(texts), dtype=np.int64)
    parts = [np.zeros((0, 1 + len(beginnings)), dtype=np.uint64)]
    for a, b in _pieces(data, offsets, word):
        s, h = _hashed(data[a:b], offsets[(offsets > a) & (offsets < b)] - a, word, beginnings)
        parts.append(h)
        count += np.bincount(np.searchsorted(offsets, s + a, side="right") - 1, minlength=len(texts))[:len(texts)]
    return count, np.concatenate(parts)


def stretches(texts: pa.Array, rows: int = 256, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Cuts of a string array into runs of at most ``rows`` texts and ``size`` bytes (or a single text), so that
    what is made of a run has a bound."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    i = 0
    while i < len(texts):
        before = ends[i] - lengths[i]
        j = max(i + 1, min(i + rows, int(np.searchsorted(ends, before + size, side="right"))))
        yield i, j
        i = j


def _pieces(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of about a megabyte that part no word; they may part texts."""
    a, stop = int(offsets[0]), int(offsets[-1])
    while a < stop:
        b = min(a + PIECE, stop)
        while b < stop and word[data[b - 1]] and b not in offsets:
            gap = np.flatnonzero(~word[data[b:b + PIECE]])
            nearest = int(gap[0]) + b + 1 if len(gap) else min(b + PIECE, stop)
            later = offsets[np.searchsorted(offsets, b)]  # a text's end parts words too
            b = min(nearest, int(later))
        yield a, b
        a = b
