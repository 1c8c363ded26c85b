"""Phrase collocations: every phrase of one to four words counted in HAT-tries, then scored by its weakest cut.

Counting, in each task: a shallow trie over word ids, per language, whose leaves are hash
containers of phrase endings. A container that grows past ``BURST`` endings bursts into a
node with a container for each next word. When the trie holds ``TRIE_ENTRIES`` endings, its
largest subtrees are spilled whole until half is left: as sorted runs, cut by the prefix
partition (of the first two words) that their phrases belong to. One shuffle brings the
runs of a prefix partition together, where they are merged, a bounded number of entries at
a time, and phrases of at least ``MIN_COUNT`` occurrences leave as text. All that a result
needs occurs that often: a part of a phrase, or a longer phrase around it that counts, is
no rarer than the phrase itself needs to be.

The rest joins these frequent phrases with each other in DataFrame functions.

Null texts are empty, null languages are ``und``. Rows are counted as they are, so repeated
rows count repeatedly; ids and further columns are not looked at; empty tables give empty
results. Words and pieces of any length are whole. Counts are 64-bit, products decimal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import ragged
from .common import column, discard, staged, steps, utf8
from .words import lower, mix, span_hashes, spans

#: Words of the longest phrase; each takes BITS bits of a packed ending, so a trie knows fewer than 2 ** BITS words.
LONGEST, BITS = 4, 21
MIN_COUNT = 30
#: Endings of a container that bursts, of a trie that spills, and entries that are merged at a time.
BURST, TRIE_ENTRIES, MERGE_ENTRIES = 4_096, 1_000_000, 1_000_000
#: Bytes of text counted at a time, and prefix partitions for each partition of the input.
COUNT_BYTES, PARTS = 3_000_000, 4

_MASK = (1 << BITS) - 1
_KEYS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SPLIT, _SPACE = np.zeros(256, bool), np.zeros(256, bool)
_SPLIT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SPACE[[0x20, 0x09]] = True


class HatTrie:
    """Counts of phrases by language: word-id nodes above hash containers of packed endings."""

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.words: list[bytes] = []
        self.hashes: list[np.ndarray] = [np.zeros(1, np.uint64)]
        self.roots: dict[tuple[int, int], dict] = {}
        #: First words whose container has burst; their subtrees map the second word to a container.
        self.nodes: set[tuple[int, int]] = set()
        self.sizes: dict[tuple[int, int], int] = {}
        self.entries = 0

    def ids(self, hashes: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers from 1 of distinct words, by their hashes."""
        known, before = self.known, len(self.known)
        found = np.array([known.setdefault(h, len(known) + 1) for h in hashes.tolist()], np.int64)
        new = found > before
        self.hashes.append(hashes[new])
        self.words.extend(data[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True))
        return found

    def add(self, lang: int, first: np.ndarray, endings: np.ndarray, counts: np.ndarray) -> None:
        """Counts of distinct phrases, in order of their first words' ids."""
        cuts = np.flatnonzero(np.r_[True, first[1:] != first[:-1], True]).tolist() if len(first) else [0]
        heads, ends, ns = first[cuts[:-1]].tolist(), endings.tolist(), counts.tolist()
        for head, a, b in zip(heads, cuts, cuts[1:], strict=False):
            key = (lang, head)
            if key in self.nodes:
                subtree, before, shift = self.roots[key], self.sizes[key], BITS * (LONGEST - 2)
                low, grown = (1 << shift) - 1, 0
                for ending, n in zip(ends[a:b], ns[a:b], strict=True):
                    box = subtree.get(ending >> shift)
                    if box is None:
                        box = subtree[ending >> shift] = {}
                    ending &= low
                    old = box.get(ending)
                    if old is None:
                        box[ending] = n
                        grown += 1
                    else:
                        box[ending] = old + n
                now = before + grown
            else:
                box = self.roots.get(key)
                before = len(box) if box else 0
                if box is None:
                    box = self.roots[key] = dict(zip(ends[a:b], ns[a:b], strict=True))
                else:
                    for ending, n in zip(ends[a:b], ns[a:b], strict=True):
                        box[ending] = box.get(ending, 0) + n
                now = len(box)
                if now > self.burst:
                    self._burst(key)
            self.sizes[key] = now
            self.entries += now - before

    def _burst(self, key: tuple[int, int]) -> None:
        shift = BITS * (LONGEST - 2)
        low, subtree = (1 << shift) - 1, {}
        for ending, n in self.roots[key].items():
            subtree.setdefault(ending >> shift, {})[ending & low] = n
        self.roots[key] = subtree
        self.nodes.add(key)

    def spill(self, keep: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take out whole subtrees, the largest first, until ``keep`` entries are left: language, four word ids, count."""
        langs, firsts, lengths, seconds, boxes, ends, ns = [], [], [], [], [], [], []
        for key in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if self.entries <= keep:
                break
            subtree = self.roots.pop(key)
            for second, box in subtree.items() if key in self.nodes else ((0, subtree),):
                seconds.append(second)
                boxes.append(len(box))
                ends.extend(box)
                ns.extend(box.values())
            self.nodes.discard(key)
            langs.append(key[0])
            firsts.append(key[1])
            lengths.append(self.sizes.pop(key))
            self.entries -= lengths[-1]
        packed = np.array(ends, np.int64) + np.repeat(np.array(seconds, np.int64) << (BITS * (LONGEST - 2)), boxes)
        ids = np.empty((len(packed), LONGEST), np.int32)
        ids[:, 0] = np.repeat(np.array(firsts, np.int64), lengths)
        for k in range(1, LONGEST):
            ids[:, k] = (packed >> (BITS * (LONGEST - 1 - k))) & _MASK
        return np.repeat(np.array(langs, np.int32), lengths), ids, np.array(ns, np.int64)


def phrases_of(ids: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, packed rest and count of each distinct phrase of a run of words; ``piece`` tells what piece a word is in."""
    first, endings, counts = [], [], []
    prefix, names = ids, np.zeros((0, LONGEST), np.int64)
    for size in range(1, LONGEST + 1):
        # A phrase is its prefix, as the number of a distinct one, and its last word: one level of the trie at a time.
        key = ids if size == 1 else (prefix[: len(ids) - size + 1] << 32) | ids[size - 1 :]
        whole = piece[: len(key)] == piece[size - 1 :] if size > 1 else np.ones(len(key), bool)
        at = np.flatnonzero(whole)
        found, inverse, n = np.unique(key[at], return_inverse=True, return_counts=True)
        last = found if size == 1 else found & 0xFFFFFFFF
        own = np.zeros((len(found), LONGEST), np.int64)
        if size > 1:
            own[:, : size - 1] = names[found >> 32, : size - 1]
        own[:, size - 1] = last
        names = own
        prefix = np.zeros(len(ids), np.int64)
        prefix[at] = inverse
        packed = np.zeros(len(found), np.int64)
        for k in range(1, LONGEST):
            packed = (packed << BITS) | own[:, k]
        first.append(own[:, 0])
        endings.append(packed)
        counts.append(n)
    first, endings, counts = (np.concatenate(x) for x in (first, endings, counts))
    order = np.argsort(first, kind="stable")
    return first[order], endings[order], counts[order]


def packed_run(text: bytes, ranks: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run with its own dictionary: a line for each word, then the columns of word numbers and the counts, compressed."""
    small = counts.astype(np.uint8) if counts.max() < 256 else counts
    head = np.array([len(text), len(ranks), ranks.itemsize, small.itemsize], np.int64)
    body = head.tobytes() + text + ranks.T.tobytes() + small.tobytes()
    return np.int64(len(body)).tobytes() + pa.compress(body, "zstd", asbytes=True)


def unpacked_run(run: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lines of the dictionary, four word numbers of each phrase (from 1; 0: no word), counts."""
    body = pa.decompress(run[8:], int(np.frombuffer(run[:8], np.int64)[0]), "zstd", asbytes=True)
    size, n, wide, count_wide = np.frombuffer(body[:32], np.int64).tolist()
    at = 32 + size
    ids = np.frombuffer(body[at : at + wide * n * LONGEST], np.uint16 if wide == 2 else np.uint32)
    counts = np.frombuffer(body[at + wide * n * LONGEST :], np.uint8 if count_wide == 1 else np.int64)
    return np.frombuffer(body[32:at], np.uint8), ids.reshape(LONGEST, n).T.astype(np.int64), counts.astype(np.int64)


def lines_of(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the lines and the ends before their line breaks."""
    ends = np.flatnonzero(text == 10)
    return np.r_[0, ends[:-1] + 1][: len(ends)], ends


def runs(trie: HatTrie, langs: list[str], parts: int, keep: int = 0) -> Iterator[tuple[str, int, int, bytes]]:
    """Spilled subtrees as (language, prefix partition, occurrences of words, run).

    Every run is in order of its words' hashes, the order that all tasks share.
    """
    lang, ids, counts = trie.spill(keep)
    if not len(counts):
        return
    hashes = np.concatenate(trie.hashes)
    trie.hashes = [hashes]
    order = np.r_[0, np.argsort(hashes[1:]) + 1]
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    part = (mix(hashes[ids[:, 0]] * _KEYS[0] + hashes[ids[:, 1]] * _KEYS[1]) % np.uint64(parts)).astype(np.int64)
    ranks = place[ids]
    low = (ranks[:, 2].astype(np.int64) << 32) | ranks[:, 3]
    high = (ranks[:, 0].astype(np.int64) << 32) | ranks[:, 1]
    at = np.lexsort((low, high, (lang.astype(np.int64) << 32) | part))
    lang, part, ranks, counts = lang[at], part[at], ranks[at], counts[at]
    text = np.frombuffer(b"".join([w + b"\n" for w in trie.words]), np.uint8)
    starts, ends = lines_of(text)
    cuts = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (part[1:] != part[:-1]), True]).tolist()
    # A run costs what it holds, not what all words of the task would: only the places of its own words are set and read.
    number = np.zeros(len(order), np.uint32)
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = np.sort(ranks[a:b], axis=None)
        own = own[np.r_[own[0] > 0, own[1:] != own[:-1]]]
        number[own] = np.arange(1, len(own) + 1, dtype=np.uint32)
        numbers = number[ranks[a:b]].astype(np.uint16 if len(own) < 65_535 else np.uint32)
        words = order[own] - 1
        lines = text[ragged(starts[words], ends[words] + 1 - starts[words])].tobytes()
        single = ranks[a:b, 1] == 0
        yield langs[lang[a]], int(part[a]), int(counts[a:b][single].sum()), packed_run(lines, numbers, counts[a:b])


def count_texts(batches: Iterator[pa.RecordBatch], parts: int, entries: int = TRIE_ENTRIES, burst: int = BURST) -> Iterator[tuple[str, int, int, bytes]]:
    """The runs of a task's rows (columns ``lang`` and ``text``)."""
    trie, langs = HatTrie(burst), {}
    for batch in steps(batches, "text", COUNT_BYTES):
        names = column(batch, "lang").to_pylist()
        numbers = np.array([langs.setdefault(x, len(langs)) for x in names], np.int64)
        data, bounds = utf8(column(batch, "text"))
        data = lower(data)
        split = _SPLIT[data]
        starts, ends, text = spans(data, bounds, ~(split | _SPACE[data]))
        if not len(starts):
            continue
        hashes, at, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(trie.words) + len(at) >= _MASK:
            yield from runs(trie, list(langs), parts)
            trie.clear()
        ids = trie.ids(hashes, data.tobytes(), starts[at], ends[at])[inverse]
        # Words of one piece are in one text, with as many split marks before them.
        piece = np.cumsum(split)[starts] + text
        spoken = numbers[text]
        for number in np.unique(spoken).tolist():
            own = np.flatnonzero(spoken == number)
            trie.add(number, *phrases_of(ids[own], piece[own]))
            if trie.entries > entries:
                yield from runs(trie, list(langs), parts, entries // 2)
    yield from runs(trie, list(langs), parts)


class Merger:
    """Sums sorted runs of one prefix partition; no more than ``entries`` wait to be merged at a time."""

    def __init__(self, entries: int = MERGE_ENTRIES):
        self.limit, self.waiting = entries, 0
        #: Dictionary lines, word numbers and counts.
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, run: bytes) -> None:
        self.runs.append(unpacked_run(run))
        self.waiting += len(self.runs[-1][2])
        if self.waiting > self.limit:
            self.merge()

    def merge(self) -> None:
        text = np.concatenate([t for t, _, _ in self.runs])
        starts, ends = lines_of(text)
        _, first, number = np.unique(span_hashes(text, starts, ends), return_index=True, return_inverse=True)
        # Words keep the order of their hashes, in which the runs are sorted.
        number = np.r_[0, number + 1]
        at = np.cumsum([0, *(int((t == 10).sum()) for t, _, _ in self.runs)])
        columns = [np.concatenate([number[np.where(ids[:, k] > 0, a + ids[:, k], 0)] for a, (_, ids, _) in zip(at, self.runs, strict=False)]) for k in range(LONGEST)]
        counts = np.concatenate([c for _, _, c in self.runs])
        high, low = ((columns[k] << 32) | columns[k + 1] for k in (0, 2))
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        high, low, few = high[new], low[new], 0xFFFFFFFF
        text = text[ragged(starts[first], ends[first] + 1 - starts[first])]
        self.runs = [(text, np.stack([high >> 32, high & few, low >> 32, low & few], axis=1), np.add.reduceat(counts[order], new))]
        # What is left is held already; the next merge comes when as much again waits.
        self.waiting, self.limit = len(new), max(self.limit, 2 * len(new))

    def frequent(self, least: int) -> tuple[list[str], list[int], list[int]]:
        """Phrases, numbers of words and counts."""
        if not self.runs:
            return [], [], []
        self.merge()
        text, ids, counts = self.runs[0]
        keep = np.flatnonzero(counts >= least)
        words = [b"", *text.tobytes().split(b"\n")]
        phrases = [b" ".join([words[w] for w in row if w]).decode() for row in ids[keep].tolist()]
        return phrases, (ids[keep] > 0).sum(axis=1).tolist(), counts[keep].tolist()


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """Phrases of 1 to 4 words with at least ``min_count`` occurrences per language, written to the shared folder.

    Rows with ``phrase``, ``words`` and ``f``; one row per language and prefix partition has a null
    phrase and the word occurrences counted there.
    """
    source = docs.select(F.coalesce(docs[lang_column], F.lit("und")).alias("lang"), docs[text_column].alias("text"))
    parts = PARTS * max(1, source.rdd.getNumPartitions())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in count_texts(batches, parts):
            rows.append(row)
            if len(rows) == 64:
                yield _rows(rows)
                rows = []
        if rows:
            yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["lang", "part", "words", "run"])

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, total = Merger(), 0
        for batch in batches:
            for n, run in zip(column(batch, "words").to_pylist(), column(batch, "run"), strict=True):
                total += n
                merger.add(run.as_py())
        text, words, f = merger.frequent(min_count)
        columns = [[key[0].as_py()] * (len(f) + 1), [*text, None], [*words, 0], [*f, total]]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["lang", "phrase", "words", "f"])

    counted = source.mapInArrow(count, "lang string, part int, words long, run binary")
    return staged(counted.groupBy("lang", "part").applyInArrow(merge, "lang string, phrase string, words int, f long"), "phrases")


def score_phrases(frequent: DataFrame, min_count: int = MIN_COUNT, top: int | None = 2000) -> DataFrame:
    """Per language the phrases of ``frequent`` by score, the first ``top`` (all, if None), with the lowest-scoring cut's parts.

    Cutting after k words gives l and r, the counts of both parts, and floor(2000000 a / (l + r)). A
    phrase inside a longer candidate with 100 f(longer) >= 80 a is left out. ``n`` counts the language's words.
    """
    counts = frequent.where("phrase IS NOT NULL")
    totals = frequent.where("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    candidates = counts.where((F.col("words") > 1) & (F.col("f") >= min_count)).select("lang", "phrase", "words", F.col("f").alias("a"))
    words = F.split("phrase", " ", -1)
    cut = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), words.alias("w"))
    cut = cut.select("lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("w", F.lit(1), F.col("k"))).alias("left"), F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.lit(LONGEST))).alias("right"))
    part = counts.select("lang", "phrase", "f")
    cut = cut.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cut = cut.join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # Quotients below 2 ** 63 of exact decimals: a is at most l and r, so the score is at most a million.
    score = F.expr("(CAST(2000000 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = cut.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.concat_ws(" ", F.slice(words, at, size))),
        )
    )
    within = candidates.where("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("around"))
    within = within.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(F.coalesce(100 * wide("around") < 80 * wide("a"), F.lit(True)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"))
    ranked = flat.withColumn("rank", rank.cast("long"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = 2000) -> DataFrame:
    """The best phrases of each language; the frequent phrases stay in the shared folder for as long as the result is read."""
    frequent = frequent_phrases(docs, min_count)
    ranked = staged(score_phrases(frequent, min_count, top), "collocations")
    discard(frequent)
    return ranked


def collocations_sql() -> str:
    grams = " UNION ALL ".join(
        f"SELECT lang, {n} AS words, array_to_string(w[i:i + {n - 1}], ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {n - 2})) AS i FROM pieces)"
        for n in range(1, LONGEST + 1)
    )
    return rf"""
WITH lowered AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
cut_up AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
pieces AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM cut_up),
counts AS MATERIALIZED (SELECT lang, words, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL),
frequent AS MATERIALIZED (SELECT * FROM counts WHERE f >= {MIN_COUNT}),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang),
candidates AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE words > 1),
cuts AS (SELECT *, unnest(range(1, words)) AS k FROM candidates),
parts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
  FROM cuts c
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
weakest AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (SELECT lang, w, a, words, unnest(range(2, words)) AS size FROM candidates WHERE words > 2),
starts AS (SELECT *, unnest(range(1, words - size + 2)) AS i FROM spans),
within AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS around FROM starts GROUP BY ALL),
kept AS (SELECT p.* FROM weakest p LEFT JOIN within USING (lang, phrase) WHERE around IS NULL OR 100 * around::HUGEINT < 80 * p.a::HUGEINT),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
