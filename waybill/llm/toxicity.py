"""Toxicity scores by the nearest labelled examples under TF-IDF cosine.

Terms are words, word starts of 4 to 6 letters, words in capitals (as one term)
and runs of punctuation. Those that tell the labels apart on the labelled rows
(chi-square) span the vectors. Two more dimensions count all such terms together
and all words, so that a rare insult in a long text weighs little. Examples with equal vectors are one entry with its votes. The
entries lie in an inverted index whose postings are cut into blocks; a block's
largest weights bound the cosine of its entries from above, so blocks are opened
in order of their bound until no bound reaches the worst of the neighbours kept.
The result is the exact list of nearest entries. Their votes, weighted by
distance and smoothed by the share of label 1, are the score.

Fitted on at most ``MAX_EXAMPLES`` labelled rows (those with the smallest hash of
the id), which also bounds everything that reaches the driver or is sent to the
executors. Scoring covers every row and every word.

Defined results: null and empty texts have no words and score like a text
without any toxic term. Several labels of one id count as toxic if one is; null
labels are ignored. Without any label 1 every score is 0. Repeated rows give
repeated results, an empty table no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, staged, steps, with_field

#: Labelled rows that the index is fitted on, at most.
MAX_EXAMPLES = 20_000
MAX_TERMS = 256
#: A term needs this chi-square, so many toxic examples and so many times the share of the others.
LEAST_CHI, LEAST_TOXIC, LEAST_LIFT = 25.0, 3, 20.0
NEIGHBOURS = 25
BLOCK = 64
#: What each word adds to the dimension of all words, where a term adds 1 to that of all terms.
REST = 0.01
#: Weight of a single term beside that of all terms together.
SINGLE = 0.3
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+|[^\w\s]{2,}")
_CAPITALS = "^"


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _terms(word: str) -> list[str]:
    """The terms of a word, longest first."""
    low = word.lower()
    if not low[0].isalpha():
        return [low]
    capitals = [_CAPITALS] if len(word) > 2 and word.isupper() else []
    return [low, *(low[:n] + "*" for n in (6, 5, 4) if len(low) > n), *capitals]


def term_counts(text: str | None, known: dict[str, int]) -> tuple[Counter, int]:
    """How often each known term occurs (a word counts for its longest term), and the number of words."""
    found: Counter = Counter()
    total = 0
    for word, n in Counter(_WORD.findall(text or "")).items():
        total += n
        for term in _terms(word):
            if term in known:
                found[known[term]] += n
                break
    return found, total


def unit_vector(counts: dict[int, int], total: int, idf: np.ndarray) -> dict[int, float]:
    """TF-IDF weights of the terms, then of all terms together and of all words, at length 1."""
    mean = float(idf.mean()) if len(idf) else 1.0
    found = {t: SINGLE * n * float(idf[t]) / mean for t, n in counts.items()}
    if counts:
        found[len(idf)] = float(sum(counts.values()))
    found[len(idf) + 1] = REST * max(1, total)
    norm = math.sqrt(sum(w * w for w in found.values()))
    return {t: w / norm for t, w in found.items()}


@dataclass
class ExampleIndex:
    """Unit vectors of the entries by term, in blocks of ``BLOCK`` entries."""

    terms: dict[str, int]
    idf: np.ndarray
    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    weights: np.ndarray

    def __post_init__(self) -> None:
        n = len(self.toxic)
        self.starts = np.arange(0, n, BLOCK)
        self.most = np.maximum.reduceat(self.weights, self.starts, axis=1) if n else self.weights
        #: Postings: per term and block, the entries with a weight.
        self.postings = [
            [(e := np.flatnonzero(row[a : a + BLOCK]), row[a : a + BLOCK][e]) for a in self.starts] for row in self.weights
        ]

    @classmethod
    def fit(cls, terms: dict[str, int], idf: np.ndarray, vectors: dict[tuple, list[int]], prior: float) -> ExampleIndex:
        """``vectors`` maps (sorted term counts, words) to the numbers of clean and toxic examples."""
        entries = sorted(vectors)
        dense = np.zeros((len(idf) + 2, len(entries)))
        for k, (counts, total) in enumerate(entries):
            for term, weight in unit_vector(dict(counts), total, idf).items():
                dense[term, k] = weight
        votes = np.array([vectors[e] for e in entries], float).reshape(-1, 2)
        return cls(terms, idf, prior, votes[:, 1], votes[:, 0], dense)

    def nearest(self, query: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines, best first, until ``NEIGHBOURS`` examples are reached; ties by entry number."""
        at = list(query)
        bound = sum(query[t] * self.most[t] for t in at)
        order = np.argsort(-bound, kind="stable")
        entries, scores, worst = np.zeros(0, np.int64), np.zeros(0), -1.0
        for block in order:
            if bound[block] + 1e-9 < worst:
                break
            start = self.starts[block]
            own = np.zeros(min(BLOCK, len(self.toxic) - start))
            for t in at:
                spot, weight = self.postings[t][block]
                own[spot] += query[t] * weight
            entries, scores = np.append(entries, start + np.arange(len(own))), np.append(scores, own)
            best = np.lexsort((entries, -scores))
            entries, scores = entries[best], scores[best]
            reached = np.cumsum(self.toxic[entries] + self.clean[entries])
            keep = int(np.searchsorted(reached, NEIGHBOURS)) + 1
            if keep <= len(entries):
                worst = scores[keep - 1]
                # Equal cosines stay, so that ties do not depend on the order of blocks.
                keep = int(np.searchsorted(-scores, -worst + 1e-12, side="right"))
                entries, scores = entries[:keep], scores[:keep]
        return entries, scores

    def score(self, counts: Counter, total: int) -> float:
        if not len(self.toxic) or not len(self.idf):
            return 0.0
        entries, cosines = self.nearest(unit_vector(counts, total, self.idf))
        # At most NEIGHBOURS examples of each entry vote, so one frequent vector does not drown the others.
        size = self.toxic[entries] + self.clean[entries]
        weight = np.minimum(size, NEIGHBOURS) / size / (0.02 + np.maximum(0.0, 1 - cosines))
        yes, no = float((weight * self.toxic[entries]).sum()), float((weight * self.clean[entries]).sum())
        return min(1.0, (yes + self.prior) / (yes + no + 1))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> ExampleIndex:
    """The index of labelled rows that are not held out. ``labels`` has the id and 0 or 1."""
    marked = (
        labels.where(labels[label_column].isNotNull() & ~held_out(labels[id_column]))
        .groupBy(labels[id_column].alias("id"))
        .agg(F.max(label_column).cast("int").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(MAX_EXAMPLES)
    )
    # The limit above proves the size of the broadcast side.
    examples = staged(
        docs.select(docs[id_column].alias("id"), docs[text_column].alias("text")).join(F.broadcast(marked), "id"), "toxicity-examples"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            found = (Counter(), Counter())
            for text, y in zip(column(part, "text").to_pylist(), column(part, "y").to_pylist(), strict=True):
                found[1 if y else 0].update({t for word in set(_WORD.findall(text or "")) for t in _terms(word)})
            names = list(found[0] | found[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([found[1][t] for t in names], pa.int64()), pa.array([found[0][t] for t in names], pa.int64())],
                names=["term", "toxic", "clean"],
            )

    totals = examples.agg(F.sum(F.col("y").cast("long")).alias("toxic"), F.count("*").alias("n")).first()
    toxic, n = totals["toxic"] or 0, totals["n"]
    clean = n - toxic
    if not toxic:
        return ExampleIndex.fit({}, np.zeros(0), {}, 0.0)
    counted = examples.select("text", "y").mapInArrow(count, "term string, toxic long, clean long")
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    chi = n * (a * (clean - b) - b * (toxic - a)) ** 2 / ((a + b) * (n - a - b) * float(toxic) * max(1.0, float(clean)))
    chosen = (
        counted.groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((a >= LEAST_TOXIC) & (a * clean >= LEAST_LIFT * b * toxic) & (a + b < n) & (chi >= LEAST_CHI))
        .orderBy(chi.desc(), F.length("term").desc(), "term")
        .limit(MAX_TERMS)
        .collect()
    )
    terms = {row["term"]: k for k, row in enumerate(chosen)}
    idf = np.array([math.log((1 + n) / (1 + row["toxic"] + row["clean"])) + 1 for row in chosen])

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            rows = []
            for text in column(part, "text").to_pylist():
                counts, total = term_counts(text, terms)
                # Without any term all lengths point the same way.
                rows.append([*(x for item in sorted(counts.items()) for x in item), total if counts else 1])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64())), column(part, "y")], names=["v", "y"])

    grouped = (
        examples.select("text", "y")
        .mapInArrow(vector, "v array<bigint>, y int")
        .groupBy("v")
        .agg(F.sum(1 - F.col("y")).alias("clean"), F.sum("y").alias("toxic"))
        .collect()
    )
    vectors = {(tuple(zip(r["v"][:-1:2], r["v"][1:-1:2], strict=True)), r["v"][-1]): [r["clean"], r["toxic"]] for r in grouped}
    return ExampleIndex.fit(terms, idf, vectors, toxic / n)


def with_score(df: DataFrame, index: ExampleIndex, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1 in ``score_column``; a column of that name is replaced."""
    kept = [c for c in df.columns if c != score_column]
    rest = df.select(*(df[c] for c in kept))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = index.score(Counter(), 1)
        for part in steps(batches, text_column):
            scores = []
            for text in column(part, text_column).to_pylist():
                counts, total = term_counts(text, index.terms)
                scores.append(index.score(counts, total) if counts else plain)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*kept, score_column])

    return rest.mapInArrow(work, with_field(rest.schema, score_column, "double"))


def evidence(df: DataFrame, index: ExampleIndex, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row its id and what speaks for its score: the toxic terms found and the nearest entries with their votes."""
    source = df.select(df[id_column].alias("id"), df[text_column].alias("text"))
    names = {k: t for t, k in index.terms.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            rows = []
            for text in column(part, "text").to_pylist():
                counts, total = term_counts(text, index.terms)
                near = []
                if len(index.toxic):
                    near = [
                        {"entry": int(e), "cosine": float(c), "toxic": int(index.toxic[e]), "clean": int(index.clean[e])}
                        for e, c in zip(*index.nearest(unit_vector(counts, total, index.idf)), strict=True)
                    ]
                rows.append((sorted(names[t] for t in counts), near))
            kind = pa.list_(pa.struct([("entry", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int64()), ("clean", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [column(part, "id"), pa.array([r[0] for r in rows], pa.list_(pa.string())), pa.array([r[1] for r in rows], kind)],
                names=[id_column, "terms", "neighbours"],
            )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(
        work, f"`{id_column}` {kind}, terms array<string>, neighbours array<struct<entry: bigint, cosine: double, toxic: bigint, clean: bigint>>"
    )
