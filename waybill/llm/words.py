"""Words, word hashes and shingle sets of a packed string column, computed for many texts at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_STEP = [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 20)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[:] = tables
    return _powers


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return _LOWER[data]


def spans(data: np.ndarray, bounds: np.ndarray, word: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word; words are split at the ends of texts and at 0x20 and 0x09-0x0D.

    ``word`` tells for each byte whether it belongs to a word, where other bytes are to split.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~_SPACE[data] if word is None else word
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    text = np.searchsorted(bounds, starts, side="right") - 1
    return starts, ends, text


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A shingle is ``size`` consecutive words, A-Z in lower case; a text of fewer
    words is one shingle as a whole, a text without words has none.
    """
    data = lower(data)
    starts, ends, text = spans(data, bounds)
    texts = len(bounds) - 1
    sets = [np.zeros(0, np.uint64)] * texts
    if not len(starts):
        return sets
    words = span_hashes(data, starts, ends)
    first = np.searchsorted(text, np.arange(texts + 1))
    keys = [np.uint64((_STEP[j % 4] * (2 * j + 1)) % (1 << 64)) for j in range(size)]
    shingles = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for j, key in enumerate(keys):
        shingles += words[j : j + len(shingles)] * key
    shingles = mix(shingles)
    for i in range(texts):
        a, b = first[i], first[i + 1]
        if b - a >= size:
            own = np.sort(shingles[a : b - size + 1])
            sets[i] = own[np.r_[True, own[1:] != own[:-1]]] if len(own) > 1 else own
        elif b > a:
            whole = np.uint64(b - a)
            for word, key in zip(words[a:b], keys, strict=False):
                whole = np.uint64((int(whole) + int(word) * int(key)) % (1 << 64))
            sets[i] = mix(np.array([whole]))
    return sets
