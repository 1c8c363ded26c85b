"""Ranked lexical search: accumulators from short posting lists join document-at-a-time search of the long ones.

The index is a table: for each shard (a few steps of one task's texts) a row per term
with the places of its documents and how often it occurs there, and rows with the ids
and lengths of the documents. Searching joins the items' terms to it, so that only the
lists asked for travel, one shard and block of items to a task. There, per item:

* lists that are short for the shard are read term at a time and summed into
  accumulators, which from then on are one more list with one bound;
* that list and the long ones are walked document at a time, a window of documents at a
  step. Lists whose bounds together cannot reach the best scores so far are only looked
  up for documents that still can, by their bounds in the window; all else is skipped.

Skipping is exact: a document is left out only if its bound is below the score of the
last one kept. Each task keeps ``k`` documents of an item, a window over them ranks.

Scores are 64-bit integers, see ``search``. Null and empty texts have no terms: they count
nowhere and are never found. Rows with the same id are documents of their own. Documents
without an id count in the statistics but cannot be named, so they are not ranked; items
without an id are left out. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import ragged
from .common import column, discard, lists, staged, steps, strings, utf8
from .words import lower, span_hashes, spans

#: Fixed pattern of a term, with A-Z in lower case: digits, letters and all that is not ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text that are inverted at a time, and so many such steps of a task in a shard.
INDEX_BYTES, SHARD_STEPS = 2_000_000, 8
#: Items that a task searches at a time.
BLOCK_ITEMS = 4_000
#: A list is short if it holds at most one document of so many.
SHORT = 32
#: Documents of a window.
WINDOW = 1024

_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(text: Column) -> Column:
    """The distinct terms of a text, as an array; empty for null."""
    found = F.regexp_extract_all(F.translate(text, CAPITALS, SMALL), F.lit(TERM), F.lit(0))
    return F.array_distinct(F.coalesce(found, F.array().cast("array<string>")))


def invert(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of the texts, bounds of their lists, places and occurrences in the lists, and terms of each text with repeats."""
    data = lower(data)
    starts, ends, text = spans(data, bounds, _TERM_BYTE[data])
    texts = len(bounds) - 1
    lengths = np.bincount(text, minlength=texts)
    _, first, term = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    pair, tf = np.unique(term * max(texts, 1) + text, return_counts=True)
    places = pair % max(texts, 1)
    at = np.searchsorted(pair // max(texts, 1), np.arange(len(first) + 1))
    size = ends[first] - starts[first]
    names = strings(data[ragged(starts[first], size)], np.concatenate([[0], np.cumsum(size)]))
    return names, at, places, tf, lengths


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The inverted index of all rows, written to the shared folder.

    Rows with a ``term`` hold its list in one step of a shard (``df`` documents); the row
    without a term holds the ids and lengths of the step's documents.
    """
    source = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for k, part in enumerate(steps(batches, "text", INDEX_BYTES)):
            names, at, places, tf, lengths = invert(*utf8(column(part, "text")))
            n, ids = len(names) + 1, column(part, "id")
            none = np.append(np.zeros(n, np.int32), len(ids)).astype(np.int32)
            columns = [
                pa.array(np.full(n, task + k // SHARD_STEPS)),
                pa.array(np.full(n, k % SHARD_STEPS, np.int32)),
                pa.concat_arrays([names, pa.nulls(1, pa.string())]),
                pa.array(np.append(np.diff(at), int((lengths > 0).sum()))),
                lists(places.astype(np.int32), np.append(at, at[-1])),
                lists(tf.astype(np.int32), np.append(at, at[-1])),
                pa.ListArray.from_arrays(pa.array(none), ids),
                lists(lengths, none),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "step", "term", "df", "places", "tf", "ids", "lengths"])

    schema = f"shard long, step int, term string, df long, places array<int>, tf array<int>, ids array<{kind}>, lengths array<bigint>"
    return staged(source.mapInArrow(work, schema), "search-index")


@dataclass
class PostingList:
    """Places in order with what each adds to a score; the most of a window, by window."""

    places: np.ndarray
    adds: np.ndarray

    def __post_init__(self) -> None:
        self.most = int(self.adds.max(initial=0))
        self._windows: np.ndarray | None = None

    def windows(self, n: int) -> np.ndarray:
        if self._windows is None:
            self._windows = np.zeros(n, np.int64)
            np.maximum.at(self._windows, self.places // WINDOW, self.adds)
        return self._windows


def accumulated(short: list[PostingList]) -> PostingList:
    """The sum of the lists as one list."""
    places, inverse = np.unique(np.concatenate([x.places for x in short]), return_inverse=True)
    adds = np.zeros(len(places), np.int64)
    np.add.at(adds, inverse, np.concatenate([x.adds for x in short]))
    return PostingList(places, adds)


def best_places(found: list[PostingList], n_docs: int, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k documents of highest score above 0, ties by ``order`` of the place."""
    windows = -(-n_docs // WINDOW)
    short = [x for x in found if len(x.places) * SHORT <= n_docs]
    walked = [x for x in found if len(x.places) * SHORT > n_docs]
    least = 1
    if short:
        sums_ = accumulated(short)
        walked.append(sums_)
        if len(sums_.adds) >= k:
            # The whole scores of these k are at least their sums so far.
            least = max(least, int(np.partition(sums_.adds, -k)[-k]))
    walked.sort(key=lambda x: -x.most)
    rest = np.cumsum([x.most for x in walked[::-1]])[::-1]
    places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for window in range(windows):
        lead = int((rest >= least).sum())  # lists from here on only reach the best together with those before
        if not lead:
            break
        start, dense = window * WINDOW, np.zeros(WINDOW, np.int64)
        for x in walked[:lead]:
            a, b = np.searchsorted(x.places, (start, start + WINDOW))
            dense[x.places[a:b] - start] += x.adds[a:b]
        own = np.flatnonzero(dense)
        left = sum(int(x.windows(windows)[window]) for x in walked[lead:])
        for x in walked[lead:]:
            own = own[dense[own] + left >= least]
            if not len(own):
                break
            at = np.minimum(np.searchsorted(x.places, start + own), len(x.places) - 1)
            dense[own] += np.where(x.places[at] == start + own, x.adds[at], 0)
            left -= int(x.windows(windows)[window])
        own = own[dense[own] >= least]
        if len(own):
            places, scores = np.append(places, start + own), np.append(scores, dense[own])
            if len(places) > k:
                best = np.lexsort((order[places], -scores))[:k]
                places, scores = places[best], scores[best]
            if len(places) == k:
                least = max(least, int(scores.min()))
    return places, scores


def _search_shard(table: pa.Table, n_all: int, terms_all: int, k: int) -> tuple[list, list, list]:
    """Items, ids and scores of one shard and block of items."""
    heads = sorted(
        ((s, i) for i, (s, t) in enumerate(zip(table["step"].to_pylist(), table["term"].to_pylist(), strict=True)) if t is None)
    )
    if not heads:
        return [], [], []
    base, ids, lengths, total = {}, [], [], 0
    for step, i in heads:
        base[step] = total
        ids += table["ids"][i].as_py()
        lengths.append(np.asarray(table["lengths"][i].values, np.int64))
        total += len(lengths[-1])
    m = 50 + (50 * np.concatenate(lengths) * n_all) // max(terms_all, 1)
    named = np.array([x is not None for x in ids], bool)
    order = np.zeros(total, np.int64)
    order[sorted(np.flatnonzero(named).tolist(), key=lambda x: ids[x])] = np.arange(int(named.sum()))
    parts, weight, asked = defaultdict(list), {}, defaultdict(list)
    for i, term in enumerate(table["term"].to_pylist()):
        if term is None:
            continue
        if term not in weight:
            weight[term] = table["weight"][i].as_py()
            for item in table["items"][i].as_py():
                asked[item].append(term)
        step = table["step"][i].as_py()
        parts[term].append((step, base[step] + np.asarray(table["places"][i].values, np.int64), np.asarray(table["tf"][i].values, np.int64)))
    found = {}
    for term, own in parts.items():
        own.sort(key=lambda x: x[0])
        places, tf = (np.concatenate([x[j] for x in own]) for j in (1, 2))
        adds = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[places]))
        keep = named[places] & (adds > 0)
        if keep.any():
            found[term] = PostingList(places[keep], adds[keep])
    out: tuple[list, list, list] = ([], [], [])
    for item, terms in asked.items():
        own = [found[t] for t in terms if t in found]
        if own:
            places, scores = best_places(own, total, order, k)
            out[0].extend([item] * len(places))
            out[1].extend(ids[p] for p in places.tolist())
            out[2].extend(scores.tolist())
    return out


def search(
    index: DataFrame, items: DataFrame, k: int = 50, item_column: str = "item_id", text_column: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """Each item's k documents of highest score above 0, ``rank`` from 1, equal scores by ascending id.

    With N documents that have terms, L terms in all, n terms in a document, df documents
    of a term and tf occurrences: a term weighs w = floor(1000 ln((2N+2)/(2df+1))), a document
    has m = 50 + (50 n N div L), and the score sums w ((10^9 tf) div (1000 tf + 20 m)) over
    the item's distinct terms.
    """
    totals = index.where("term IS NULL").agg(F.sum("df"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n_all, terms_all = (int(x or 0) for x in totals)
    wanted = items.select(items[item_column].alias("item"), F.explode(terms_of(items[text_column])).alias("term")).where("item IS NOT NULL").distinct()
    blocks = max(1, math.ceil(items.count() / BLOCK_ITEMS))
    # Within a block a term lists each item once, so these lists are as short as a block.
    asked = staged(
        wanted.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"), "term").agg(F.collect_list("item").alias("items")), "search-terms"
    )
    counted = index.where("term IS NOT NULL").select("term", "df").join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_all + 2) / (2 * F.col("df") + 1)))
    weighed = staged(asked.join(counted, "term").select("block", "term", "items", weight.cast("long").alias("weight")), "search-weights")
    postings = index.where("term IS NOT NULL").drop("ids", "lengths", "df").join(weighed, "term")
    heads = index.where("term IS NULL").select("shard", "step", "ids", "lengths", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    item_kind, id_kind = (x.simpleString() for x in (wanted.schema["item"].dataType, index.schema["ids"].dataType.elementType))

    def work(table: pa.Table) -> pa.Table:
        found = _search_shard(table, n_all, terms_all, k)
        kinds = [table.schema.field("items").type.value_type, table.schema.field("ids").type.value_type, pa.int64()]
        return pa.table([pa.array(x, t) for x, t in zip(found, kinds, strict=True)], names=[item_column, id_column, "score"])

    both = postings.unionByName(heads, allowMissingColumns=True)
    schema = f"`{item_column}` {item_kind}, `{id_column}` {id_kind}, score bigint"
    best = both.groupBy("shard", "block").applyInArrow(work, schema)
    rank = F.row_number().over(Window.partitionBy(item_column).orderBy(F.col("score").desc(), F.col(id_column)))
    ranked = staged(best.withColumn("rank", rank).where(F.col("rank") <= k).select(item_column, "rank", id_column, "score"), "search-ranked")
    for done in (asked, weighed):
        discard(done)
    return ranked


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """Index all documents and search them for all items."""
    index = build_index(docs)
    ranked = search(index, items, k)
    discard(index)
    return ranked


def rank_documents_sql() -> str:
    return rf"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{TERM}')) AS term FROM documents),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{TERM}')) AS term FROM benchmark),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2.0 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), totals GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50"""
