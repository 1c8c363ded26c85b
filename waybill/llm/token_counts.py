"""Token counts by greedy longest match, without building the pieces.

A trie of the vocabulary gets failure links: where no child fits, the link leads
to the node of what is left after the longest pieces so far are cut off, and a
count next to it says how many pieces that are. Each byte of a word is then read
once and the number of pieces is a sum of those counts.

Defined results: null, empty and blank texts have 0 words and 0 tokens. A word
that cannot be split is one token and counts as unknown. Rows are independent,
so repeated rows give repeated results and an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import chunks, words
from .common import column, steps, utf8
from .trie import DoubleArrayTrie

#: First byte of continuation pieces in the trie; it does not occur in words of valid text, which 0x00 would.
_MORE = b"\xff"


class LongestMatch:
    """Automaton of a vocabulary; ``fail`` is -1 where a word cannot be split, ``pops`` counts the pieces cut off."""

    def __init__(self, first: Iterable[bytes], more: Iterable[bytes]):
        """``first`` are the pieces at the start of a word, ``more`` those inside it."""
        entries = {piece: 0 for piece in first if piece}
        if any(piece.startswith(_MORE) for piece in entries):
            raise ValueError("a first piece starts with 0xFF")
        entries |= {_MORE + piece: 0 for piece in more if piece}
        entries.setdefault(_MORE, -1)
        self.trie = DoubleArrayTrie.build(entries)
        base, check, value = self.trie.base.tolist(), self.trie.check.tolist(), self.trie.value.tolist()
        self.more = base[0] + _MORE[0]
        below: dict[int, list[tuple[int, int]]] = {}
        for node, parent in enumerate(check):
            if parent >= 0:
                below.setdefault(parent, []).append((node - base[parent], node))
        fail, pops = [-1] * len(base), [0] * len(base)
        todo = [node for _, node in below.get(0, []) if node != self.more]
        depth_first = [*todo, *(node for _, node in below.get(self.more, []))]
        parent_of = {node: parent for node, parent in enumerate(check) if parent >= 0}
        at = 0
        while at < len(depth_first):
            node = depth_first[at]
            at += 1
            depth_first += [child for _, child in below.get(node, [])]
            if value[node] >= 0:
                fail[node], pops[node] = self.more, 1
                continue
            parent = parent_of[node]
            byte, link, count = node - base[parent], fail[parent], pops[parent]
            while link >= 0 and check[base[link] + byte] != link:
                count += pops[link]
                link = fail[link]
            if link >= 0:
                fail[node], pops[node] = base[link] + byte, count
        self.fail, self.pops = np.array(fail, np.int32), np.array(pops, np.int32)

    def count(self, matrix: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Pieces of each word (a row of bytes); -1 where it cannot be split."""
        node = np.zeros(len(matrix), np.int32)
        count = np.zeros(len(matrix), np.int64)
        dead = np.zeros(len(matrix), bool)
        for at in range(int(length.max(initial=0))):
            rows = np.flatnonzero((length > at) & ~dead)
            while len(rows):
                own = node[rows]
                to = self.trie.step(own, matrix[rows, at].astype(np.int32))
                node[rows[to >= 0]] = to[to >= 0]
                rows, own = rows[to < 0], own[to < 0]
                count[rows] += self.pops[own]
                node[rows] = self.fail[own]
                dead[rows] = self.fail[own] < 0
                rows = rows[self.fail[own] >= 0]
        rows = np.flatnonzero(~dead & (node != self.more))
        while len(rows):
            own = node[rows]
            count[rows] += self.pops[own]
            node[rows] = self.fail[own]
            dead[rows] = self.fail[own] < 0
            rows = rows[(self.fail[own] >= 0) & (self.fail[own] != self.more)]
        count[dead] = -1
        return count


    def count_long(self, word: bytes) -> int:
        """``count`` for one long word, byte by byte."""
        base, check, fail, pops = (memoryview(x) for x in (self.trie.base, self.trie.check, self.fail, self.pops))
        node = count = 0
        for byte in word:
            while check[base[node] + byte] != node:
                count += pops[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = base[node] + byte
        while node != self.more:
            count += pops[node]
            node = fail[node]
            if node < 0:
                return -1
        return count


def byte_vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """First and later pieces of a ranks file of byte-level pieces, in which a space marks the start of a word."""
    with open(path, "rb") as lines:
        pieces = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    return [p for p in pieces if p.startswith(b" ")], [p for p in pieces if not p.startswith(b" ")]


def word_tokens(data: np.ndarray, bounds: np.ndarray, matcher: LongestMatch, lead: bytes = b" ") -> np.ndarray:
    """Words, tokens and unknown words of each text, as rows of three numbers."""
    starts, ends, text = words.spans(data, bounds)
    texts = len(bounds) - 1
    if not len(starts):
        return np.zeros((texts, 3), np.int64)
    first, inverse = chunks.distinct(words.span_hashes(data, starts, ends))
    a, b = starts[first], ends[first]
    counts = np.empty(len(first), np.int64)
    prefix = np.frombuffer(lead, np.uint8)
    for group, matrix in chunks.matrices(data, a, b):
        led = np.concatenate([np.broadcast_to(prefix, (len(group), len(prefix))), matrix], axis=1)
        counts[group] = matcher.count(led, (b - a)[group] + len(prefix))
    for i in chunks.long_spans(a, b):
        counts[i] = matcher.count_long(lead + data[a[i] : b[i]].tobytes())
    each = counts[inverse]
    at = np.searchsorted(text, np.arange(texts + 1))
    return np.stack([np.diff(at), chunks.sums(np.abs(each), at), chunks.sums(each < 0, at)], axis=1)


def token_counts(df: DataFrame, vocabulary: tuple[list[bytes], list[bytes]], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``df``: its id, ``n_words``, ``n_tokens`` and ``n_unknown``.

    ``vocabulary`` holds the pieces at the start of a word (with a leading space)
    and the later ones; its size does not depend on the data.
    """
    matcher = LongestMatch(*vocabulary)
    source = df.select(df[id_column].alias("id"), df[text_column].alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            found = word_tokens(*utf8(column(part, "text")), matcher)
            yield pa.RecordBatch.from_arrays(
                [column(part, "id"), *(pa.array(found[:, k]) for k in range(3))],
                names=[id_column, "n_words", "n_tokens", "n_unknown"],
            )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(work, f"`{id_column}` {kind}, n_words bigint, n_tokens bigint, n_unknown bigint")
