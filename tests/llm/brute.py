"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text: str | None, size: int) -> set[tuple[str, ...]]:
    words = _WORD.findall((text or "").translate(_LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def components(texts: dict[int, str | None], size: int, percent: int) -> dict[int, int]:
    sets = {i: shingles(t, size) for i, t in texts.items()}
    having = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            having[s].append(i)
    above = {i: i for i in texts}

    def top(x: int) -> int:
        while above[x] != x:
            x = above[x]
        return x

    for i, own in sets.items():
        for j in {j for s in own for j in having[s] if j < i}:
            common = len(own & sets[j])
            if 100 * common >= percent * (len(own) + len(sets[j]) - common):
                a, b = top(i), top(j)
                above[max(a, b)] = min(a, b)
    return {i: top(i) for i in texts}


def kept_bytes(texts: dict[int, str | None], length: int) -> dict[int, tuple[bytes, int]]:
    """Bytes left and runs removed; ids in ascending order see the windows of smaller ones."""
    seen: dict[bytes, int] = {}
    found = {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        covered = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if seen.setdefault(data[k : k + length], i) < i:
                covered[k : k + length] = b"\1" * length
        runs = sum(1 for k, c in enumerate(covered) if c and (k == 0 or not covered[k - 1]))
        found[i] = bytes(b for b, c in zip(data, covered, strict=True) if not c), runs
    return found


def edits_within(pattern: bytes, text: bytes) -> int:
    """Fewest edits between the pattern and any part of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for byte in text:
        last, row[0] = row[0], 0
        for k in range(1, len(row)):
            last, row[k] = row[k], min(last + (pattern[k - 1] != byte), row[k] + 1, row[k - 1] + 1)
        best = min(best, row[-1])
    return best


def greedy_pieces(word: bytes, first: set[bytes], more: set[bytes]) -> int | None:
    at = count = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in (more if at else first)), None)
        if end is None:
            return None
        at, count = end, count + 1
    return count
