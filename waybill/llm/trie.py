"""A double-array trie over bytes, built once and walked for many spans at a time.

``base`` and ``check`` are the two arrays: the child of ``node`` along byte ``b``
is ``base[node] + b`` if ``check`` of that slot is ``node``. ``value`` holds the
number of the entry that ends at a node, or -1.
"""

from __future__ import annotations

import numpy as np


class DoubleArrayTrie:
    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base, check, value

    @classmethod
    def build(cls, entries: dict[bytes, int]) -> DoubleArrayTrie:
        """Entries are non-empty byte strings with their numbers; the root is node 0."""
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for entry, number in entries.items():
            node = 0
            for byte in entry:
                below = children[node].get(byte)
                if below is None:
                    below = len(children)
                    children[node][byte] = below
                    children.append({})
                    ends.append(-1)
                node = below
            ends[node] = number
        # Wide nodes choose first, near the end of what is taken; nodes with one child then fill the gaps.
        offset: dict[int, int] = {}
        used = np.zeros(4 * len(children) + 65_536, bool)
        used[:256] = True
        tail = 256
        for node in sorted((n for n in range(len(children)) if len(children[n]) > 1), key=lambda n: -len(children[n])):
            wanted = np.array(sorted(children[node]))
            at = max(0, tail - int(wanted[0]))
            while True:
                if at + 1024 >= len(used):
                    used = np.concatenate([used, np.zeros(len(used), bool)])
                spots = at + np.arange(256)
                fits = spots[~used[spots[:, None] + wanted].any(axis=1)]
                if len(fits):
                    break
                at += 256
            offset[node] = int(fits[0])
            used[offset[node] + wanted] = True
            while used[tail : tail + 256].mean() > 0.6:
                tail += 128
        single = [n for n in range(len(children)) if len(children[n]) == 1]
        gaps = np.flatnonzero(~used)
        if len(gaps) < len(single):
            gaps = np.concatenate([gaps, np.arange(len(used), len(used) + len(single))])
            used = np.concatenate([used, np.zeros(len(single), bool)])
        for node, spot in zip(single, gaps.tolist(), strict=False):
            offset[node] = spot - next(iter(children[node]))
            used[spot] = True
        place = {0: 0}
        size = len(used) + 256
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        todo = [0]
        while todo:
            node = todo.pop()
            own = place[node]
            value[own] = ends[node]
            base[own] = offset.get(node, 0)
            for byte, below in children[node].items():
                place[below] = base[own] + byte
                check[place[below]] = own
                todo.append(below)
        top = int(np.flatnonzero(check >= 0).max(initial=0)) + 257
        return cls(base[:top].copy(), check[:top].copy(), value[:top].copy())

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child of each node along its byte, or -1."""
        to = self.base[node] + byte
        return np.where(self.check[to] == node, to, -1)
