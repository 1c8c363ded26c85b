"""Benchmark passages in documents: q-gram lemma, diagonal bands and banded alignment.

Both sides are put into one form first: A-Z in lower case and runs of white space
as one space. What is searched are patterns: every item as a whole and, so that
excerpts count, its segments of ``SEGMENT`` bytes, one every ``STEP`` bytes. An
excerpt of an item holds a segment once it has ``SEGMENT + STEP - 1`` bytes. Equal
patterns of several items are searched once.

Two strings at edit distance k share at least ``length + 1 - q * (k + 1)`` q-grams,
counted with the pattern's length, and their places lie on diagonals at most k
apart. So the q-grams a document shares with a pattern are counted in diagonal
bands 2k + 1 wide that overlap by half; each place of the document counts once in
a band, wherever the pattern has the q-gram. Bands that reach the count mark
regions, those that meet are one, and a banded alignment decides whether a part of
the region is within k edits of the pattern.

A block of the benchmark is held by every task; a benchmark above ``BLOCK_BYTES``
is searched block by block against all documents. The documents are never shuffled.

Defined results: null and empty documents have no hits. Null and empty items
cannot be found. Items of fewer than q bytes are found as whole words and without
edits, if they have at least ``shortest`` bytes; the budget of other short items
falls until the lemma demands at least one shared q-gram. Items with equal form
are all reported. Repeated rows give repeated hits, empty tables no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks
from .common import column, staged, steps, utf8

Q = 12
#: Edits allowed per byte of an item.
EDIT_SHARE = 0.06
#: Bytes of a segment of an item, and from one segment to the next.
SEGMENT, STEP = 120, 40
#: Bytes of items, about, that one pass over the documents searches.
BLOCK_BYTES = 4_000_000
#: Pairs of a place and a pattern that are counted at a time.
PAIRS = 1_000_000
_FORM = np.arange(256, dtype=np.uint8)
_FORM[65:91] += 32
_FORM[0x09:0x0E] = 0x20


def in_form(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes in comparable form, their bounds, and where each byte was before."""
    data = _FORM[data]
    space = data == 0x20
    drop = np.zeros(len(data), bool)
    drop[1:] = space[1:] & space[:-1]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    drop[heads] = False
    place = np.flatnonzero(~drop)
    return data[place], np.concatenate([[0], np.cumsum(~drop)])[bounds], place


def _in_word(data: np.ndarray) -> np.ndarray:
    return (data >= 0x80) | ((data >= 0x30) & (data <= 0x39)) | ((data >= 0x61) & (data <= 0x7A))


def _grams(data: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q bytes from each place on; the last places are padded."""
    padded = np.concatenate([data, np.zeros(q + 8, np.uint8)])
    words = lambda at: np.ndarray(len(data), "<u8", padded, at, (1,))
    total = np.zeros(len(data), np.uint64)
    for at in [*range(0, q - 7, 8), *([q - 8] if q % 8 else [])]:
        total = (total ^ words(at)) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    return total


class Benchmark:
    """The patterns of the items in comparable form, with their q-grams in hash order."""

    def __init__(
        self,
        items: list[tuple[int, str | None]],
        q: int = Q,
        edit_share: float = EDIT_SHARE,
        segment: int | None = SEGMENT,
        step: int = STEP,
        shortest: int = 1,
    ):
        """With ``segment`` None only whole items are searched."""
        if q < 8:
            raise ValueError("q must be at least 8")
        if segment is not None and segment < q:
            raise ValueError("a segment must have at least q bytes")
        self.q = q
        data, bounds, _ = in_form(*utf8(pa.array([(text or "").strip() for _, text in items], pa.string())))
        self.ids = [item for item, _ in items]
        self.texts = [bytes(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        self.edits = self._budget(np.diff(bounds), edit_share)
        #: Where each pattern comes from: (item, first byte in it), whole items and segments apart.
        whole: dict[bytes, list[int]] = {}
        parts: dict[bytes, list[tuple[int, int]]] = {}
        self.short: dict[bytes, list[int]] = {}
        for item, text in enumerate(self.texts):
            if len(text) < q:
                if len(text) >= max(1, shortest):
                    self.short.setdefault(text, []).append(item)
                continue
            whole.setdefault(text, []).append(item)
            if segment is not None and len(text) > segment:
                for at in [*range(0, len(text) - segment, step), len(text) - segment]:
                    parts.setdefault(text[at : at + segment], []).append((item, at))
        self.patterns = [*whole, *(part for part in parts if part not in whole)]
        self.whole = [whole.get(pattern, []) for pattern in self.patterns]
        self.parts = [parts.get(pattern, []) for pattern in self.patterns]
        length = np.array([len(pattern) for pattern in self.patterns], np.int64)
        # The lemma must demand something of every pattern, and of long ones a share of their q-grams.
        self.budget = self._budget(length, edit_share)
        self.need = length + 1 - q * (self.budget + 1)
        self._index(np.frombuffer(b"".join(self.patterns), np.uint8), length)

    def _budget(self, length: np.ndarray, edit_share: float) -> np.ndarray:
        return np.minimum((edit_share * length).astype(np.int64), np.maximum(0, (length - self.q) // self.q))

    def _index(self, data: np.ndarray, length: np.ndarray) -> None:
        """One entry for each q-gram of a pattern: its hash, the pattern, its first and last place there."""
        count = length - self.q + 1
        begin = np.cumsum(length) - length
        place = chunks.ragged(begin, count)
        grams = _grams(data, self.q)[place] if len(data) else np.zeros(0, np.uint64)
        pattern = np.repeat(np.arange(len(length), dtype=np.int32), count)
        place = (place - np.repeat(begin, count)).astype(np.int32)
        order = np.lexsort((place, pattern, grams))
        grams, pattern, place = grams[order], pattern[order], place[order]
        head = np.flatnonzero(np.r_[True, (grams[1:] != grams[:-1]) | (pattern[1:] != pattern[:-1])][: len(grams)])
        self.grams, self.pattern, self.first = grams[head], pattern[head], place[head]
        self.last = place[np.r_[head[1:], len(grams)] - 1] if len(head) else place
        #: A bitmap of hash prefixes turns most places of a document away.
        self.bits = max(16, int(np.ceil(np.log2(max(1, len(self.grams))))) + 6)
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[(self.grams >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def regions(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, pattern, start, end) of the parts that share enough q-grams in a band, those that meet as one."""
        if not len(self.grams) or not len(data):
            return []
        grams = _grams(data, self.q)
        at = np.flatnonzero(self.seen[(grams >> np.uint64(64 - self.bits)).astype(np.int64)])
        first, last = np.searchsorted(self.grams, grams[at]), np.searchsorted(self.grams, grams[at], side="right")
        text = np.searchsorted(bounds, at, side="right") - 1
        used = (last > first) & (at + self.q <= bounds[text + 1])
        at, first, last, text = at[used], first[used], last[used], text[used]
        each = np.cumsum(last - first)
        # Counts of a text that goes on in the next lot are carried over, summed up.
        counts: list[tuple[np.ndarray, ...]] = []
        spans: list[tuple[int, int, int, int]] = []
        begin = 0
        while begin < len(at):
            done = int(each[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(each, done + PAIRS, side="right")))
            lot = slice(begin, end)
            counts.append(self._changes(at[lot], first[lot], last[lot], text[lot], bounds))
            merged = _summed(*(np.concatenate(part) for part in zip(*counts, strict=True)))
            closed = merged[0] < text[end] if end < len(at) else np.ones(len(merged[0]), bool)
            spans.extend(self._full_bands(*(part[closed] for part in merged), bounds))
            counts = [tuple(part[~closed] for part in merged)]
            begin = end
        found: list[tuple[int, int, int, int]] = []
        for t, p, start, stop in sorted(spans):
            if found and found[-1][:2] == (t, p) and start <= found[-1][3]:
                found[-1] = (t, p, found[-1][2], max(stop, found[-1][3]))
            else:
                found.append((t, p, start, stop))
        return found

    def _changes(self, at: np.ndarray, first: np.ndarray, last: np.ndarray, text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """How the count of a (text, pattern, shift) rises and falls from band to band, as the places of a lot have it."""
        each = last - first
        hit = chunks.ragged(first, each)
        pattern, text, place = self.pattern[hit], np.repeat(text, each), np.repeat(at, each)
        place = place - bounds[text]
        width = self.budget[pattern] + 1
        # Bands of twice the width, once from multiples of the width and once shifted by it: any run of k + 1 diagonals is in one.
        rows = []
        for shift in (0, 1):
            low = (place - self.last[hit] + shift * width) // (2 * width)
            high = (place - self.first[hit] + shift * width) // (2 * width)
            group = pattern.astype(np.int64) * 2 + shift
            rows += [(text, group, low, np.ones(len(low), np.int64)), (text, group, high + 1, np.full(len(low), -1))]
        return _summed(*(np.concatenate(part) for part in zip(*rows, strict=True)))

    def _full_bands(self, text: np.ndarray, group: np.ndarray, band: np.ndarray, change: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """The changes of a group sum up to nothing, so one running sum does for all."""
        for k in np.flatnonzero(np.cumsum(change) >= self.need[group // 2]).tolist():
            pattern, shift = int(group[k]) // 2, int(group[k]) % 2
            edits, size = int(self.budget[pattern]), len(self.patterns[pattern])
            low, high = ((2 * int(b) - shift) * (edits + 1) for b in (band[k], band[k + 1] - 1))
            length = int(bounds[text[k] + 1] - bounds[text[k]])
            yield int(text[k]), pattern, max(0, low - edits), min(length, high + 3 * edits + 2 + size)

    def align(self, text: np.ndarray, pattern: int, start: int, end: int) -> tuple[int, int, int] | None:
        """Edits, start and end of the best place for the pattern in the region, if within the budget."""
        wanted, k = self.patterns[pattern], int(self.budget[pattern])
        part = bytes(text[start:end])
        spot = part.find(wanted)
        if spot >= 0:
            return 0, start + spot, start + spot + len(wanted)
        if not k:
            return None
        end = first_best_end(wanted, part, k)
        if end is None:
            return None
        # A match of k edits at most begins within length + k of its end.
        begin = max(0, end - len(wanted) - k)
        best = banded(wanted, part[begin:end], k)
        return best and (best[0], start + begin + best[1], start + begin + best[2])

    def words(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, start) of the short items that stand in a text as whole words."""
        if not self.short or not len(data):
            return
        inside = _in_word(data)
        heads, tails = np.ones(len(data), bool), np.ones(len(data), bool)
        heads[1:], tails[:-1] = ~(inside[1:] & inside[:-1]), ~(inside[1:] & inside[:-1])
        some = bounds[1:] > bounds[:-1]
        heads[bounds[:-1][some]] = tails[bounds[1:][some] - 1] = True
        for size in sorted({len(word) for word in self.short}):
            wanted = np.array([word for word in self.short if len(word) == size], f"V{size}")
            at = np.flatnonzero(heads[: max(0, len(data) - size + 1)])
            at = at[tails[at + size - 1]]
            text = np.searchsorted(bounds, at, side="right") - 1
            at, text = at[at + size <= bounds[text + 1]], text[at + size <= bounds[text + 1]]
            for begin in range(0, len(at), PAIRS):
                spots = at[begin : begin + PAIRS]
                taken = np.ascontiguousarray(data[spots[:, None] + np.arange(size)]).view(f"V{size}").ravel()
                for k in np.flatnonzero(np.isin(_sortable(taken), _sortable(wanted))).tolist():
                    t = int(text[begin + k])
                    for item in self.short.get(taken[k].tobytes(), ()):
                        yield t, item, int(spots[k] - bounds[t])

    def hits(self, data: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int, int, int, int]]]:
        """Per text (item number, edits, start, end, item start, item end), one for each item.

        The whole item counts before its segments, then fewest edits, then the first place in the text and item.
        """
        found: list[dict[int, tuple[int, int, int, int, int, int]]] = [{} for _ in range(len(bounds) - 1)]

        def offer(text: int, item: int, at: int, size: int, edits: int, start: int, end: int) -> None:
            new = (int(size < len(self.texts[item])), edits, start, end, at, at + size)
            if item not in found[text] or new < found[text][item]:
                found[text][item] = new

        for text, item, start in self.words(data, bounds):
            size = len(self.texts[item])
            offer(text, item, 0, size, 0, start, start + size)
        for text, pattern, start, end in self.regions(data, bounds):
            # A segment of items that are there as a whole need not be aligned; whole items come first.
            places = [(item, 0) for item in self.whole[pattern]]
            places += [(item, at) for item, at in self.parts[pattern] if found[text].get(item, (1,))[0]]
            got = places and self.align(data[bounds[text] : bounds[text + 1]], pattern, start, end)
            if got:
                for item, at in places:
                    offer(text, item, at, len(self.patterns[pattern]), *got)
        return [[(item, *place[1:]) for item, place in sorted(own.items())] for own in found]


def _sortable(rows: np.ndarray) -> np.ndarray:
    """Fixed-width bytes as strings whose zero bytes at the end count."""
    size = rows.dtype.itemsize
    wide = np.ones((len(rows), size + 1), np.uint8)
    wide[:, :size] = rows.view(np.uint8).reshape(len(rows), size)
    return wide.view(f"S{size + 1}").ravel()


def _summed(text: np.ndarray, group: np.ndarray, band: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows in order with the changes of equal (text, group, band) added up."""
    order = np.lexsort((band, group, text))
    text, group, band, change = text[order], group[order], band[order], change[order]
    new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (group[1:] != group[:-1]) | (band[1:] != band[:-1])][: len(text)])
    total = np.add.reduceat(change, new) if len(new) else change
    return text[new], group[new], band[new], total


def first_best_end(pattern: bytes, text: bytes, k: int) -> int | None:
    """Where the first of the parts of the text with fewest edits to the pattern ends; None above k.

    The differences down a column of the edit table are two rows of bits, so a byte of the text costs a few operations
    on whole numbers of the pattern's length; long regions of repetitive texts stay affordable.
    """
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    where = [0] * 256
    for i, byte in enumerate(pattern):
        where[byte] |= 1 << i
    up, down, cost = full, 0, len(pattern)
    best, best_end = k + 1, None
    for end, byte in enumerate(text, 1):
        same = where[byte]
        level = (((same & up) + up) ^ up) | same
        rise, fall = down | (full & ~(level | up)), up & level
        if rise & top:
            cost += 1
        elif fall & top:
            cost -= 1
            if cost < best:
                best, best_end = cost, end
        rise <<= 1
        kept = same | down
        up, down = ((fall << 1) | ~(kept | rise)) & full, rise & kept & full
    return best_end


def banded(pattern: bytes, text: bytes, k: int) -> tuple[int, int, int] | None:
    """Fewest edits between the pattern and a part of the text, its start and end; None above k.

    Column by column of the text, only rows that can stay within k are computed.
    Of equal places the first end wins, then the last start.
    """
    m = len(pattern)
    costs = list(range(m + 1))
    starts = [0] * (m + 1)
    last = min(m, k)
    best: tuple[int, int, int] | None = None
    for j, byte in enumerate(text, 1):
        diagonal, diagonal_start = costs[0], starts[0]
        costs[0], starts[0] = 0, j
        if last < m:
            costs[last + 1] = k + 1
        top = min(m, last + 1)
        last = 0
        for i in range(1, top + 1):
            up, up_start = costs[i], starts[i]
            cost, start = diagonal + (pattern[i - 1] != byte), diagonal_start
            if costs[i - 1] + 1 < cost:
                cost, start = costs[i - 1] + 1, starts[i - 1]
            if up + 1 < cost:
                cost, start = up + 1, up_start
            diagonal, diagonal_start = up, up_start
            costs[i], starts[i] = min(cost, k + 1), start
            if cost <= k:
                last = i
        if last == m and (best is None or costs[m] < best[0]):
            best = (costs[m], starts[m], j)
    return best


def benchmark_blocks(
    items: DataFrame,
    id_column: str = "item_id",
    text_column: str = "text",
    q: int = Q,
    edit_share: float = EDIT_SHARE,
    segment: int | None = SEGMENT,
    shortest: int = 1,
    block_bytes: int = BLOCK_BYTES,
) -> Iterator[Benchmark]:
    """The items in blocks of about ``block_bytes`` (an item is never divided); the driver holds one at a time."""
    rows = items.select(items[id_column].alias("i"), items[text_column].alias("t")).where("t IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    for block in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block) if blocks > 1 else rows
        yield Benchmark([(row["i"], row["t"]) for row in own.orderBy("i", "t").collect()], q, edit_share, segment, shortest=shortest)


def contaminations(df: DataFrame, benchmark: Benchmark, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per hit: the row's id, ``item_id``, ``edits`` and the byte span ``start``, ``end`` in its text (UTF-8).

    ``whole`` tells whether the item or an excerpt was found; ``item_start`` and ``item_end`` are the bytes of the item in
    comparable form that the span was compared with.
    """
    source = df.select(df[id_column].alias("id"), df[text_column].alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            raw, raw_bounds = utf8(column(part, "text"))
            data, bounds, place = in_form(raw, raw_bounds)
            rows = [
                (text, benchmark.ids[item], edits, int(place[bounds[text] + start] - raw_bounds[text]), int(place[bounds[text] + end - 1] - raw_bounds[text]) + 1, a, b, b - a == len(benchmark.texts[item]))
                for text, own in enumerate(benchmark.hits(data, bounds))
                for item, edits, start, end, a, b in own
                if end > start
            ]
            ids = column(part, "id").take(pa.array([r[0] for r in rows], pa.int64()))
            numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(1, 7)]
            names = [id_column, "item_id", "edits", "start", "end", "item_start", "item_end", "whole"]
            yield pa.RecordBatch.from_arrays([ids, *numbers, pa.array([r[7] for r in rows], pa.bool_())], names=names)

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(work, f"`{id_column}` {kind}, item_id bigint, edits bigint, start bigint, end bigint, item_start bigint, item_end bigint, whole boolean")


def without_contaminated(df: DataFrame, benchmark: Benchmark, text_column: str = "text") -> DataFrame:
    """The rows of ``df`` whose text holds no item, with all their columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, text_column):
            data, bounds, _ = in_form(*utf8(column(part, text_column)))
            yield part.filter(pa.array([not own for own in benchmark.hits(data, bounds)], pa.bool_()))

    return df.mapInArrow(work, df.schema)


def search_benchmark(df: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``contaminations`` by all of ``items``, block by block; ``options`` are those of ``benchmark_blocks``."""
    found = None
    for benchmark in benchmark_blocks(items, **options):
        block = contaminations(df, benchmark, id_column, text_column)
        # From the second block on each one's hits are written, so that no plan holds more than one block.
        found = block if found is None else staged(found, "contaminations").unionByName(staged(block, "contaminations"))
    return found


def drop_benchmark(df: DataFrame, items: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The rows of ``df`` whose text holds none of ``items``, block by block; items of fewer than q bytes are not
    searched unless ``shortest`` is given, as a single common word would take most texts with it."""
    left = df
    for number, benchmark in enumerate(benchmark_blocks(items, **{"shortest": options.get("q", Q)} | options)):
        left = without_contaminated(staged(left, "decontaminated") if number else left, benchmark, text_column)
    return left
