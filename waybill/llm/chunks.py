"""Byte spans as padded matrices: work on each distinct span of a slice once, then spread the answers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Spans of up to so many bytes go through matrices of that width; longer ones are walked one by one.
WIDTHS = (8, 16, 32, 64, 256)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of one span for each hash, and each span's number among these."""
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return first, inverse


def matrices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of span numbers with their bytes, padded with zeros; the widest groups are left out."""
    length = ends - starts
    padded = np.concatenate([data, np.zeros(WIDTHS[-1], np.uint8)])
    least = 0
    for width in WIDTHS:
        group = np.flatnonzero((length > least) & (length <= width))
        least = width
        for part in np.array_split(group, max(1, len(group) * width // 2_000_000)):
            if len(part):
                bytes_ = padded[starts[part][:, None] + np.arange(width)[None, :]]
                bytes_[np.arange(width)[None, :] >= length[part][:, None]] = 0
                yield part, bytes_


def long_spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.flatnonzero(ends - starts > WIDTHS[-1])


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after the other."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) if len(counts) else starts
    return np.arange(total) + shift


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each run of values; bounds are n + 1 indices."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]
