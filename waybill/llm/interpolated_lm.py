"""Log probabilities of texts under a trigram model with deleted interpolation.

P3(w|u,v) = a3 ML3 + (1 - a3) P2(w|v), P2(w|v) = a2 ML2 + (1 - a2) P1(w), P1(w) = a1 ML1 + (1 - a1) / (V + 1):
maximum-likelihood estimates from counts of n-grams, mixed by weights that depend on how
often the context occurred (a bucket for each power of two; 0 for a context never seen). The
weights maximise the likelihood of held-out counts: one training text in ``FOLDS`` is kept
apart, expectation-maximisation fits the weights to it under the counts of the others, and the
counts of all training texts then go with these weights.

On Spark: texts are dealt by hash into chunks of about ``CHUNK_BYTES``, each written as one
compressed row. A chunk asks for its distinct n-grams, as sorted hashes in one packed row per
range of hashes, with its own counts if it is trained on; the rows of a range meet in one
task, which sums the counts and answers each chunk; chunks meet their answers and score their
texts. Shorter n-grams and trigrams are asked for one after the other, so that only one lot is
on disk. So n-grams are combined before they travel, no table of the corpus' n-grams is held
anywhere, and hot n-grams cost one entry a chunk. Counts cover all training texts, whole.
N-grams are told apart by 64-bit hashes.

Null texts are empty and have one token, the end. Rows without an id are trained on and scored,
repeated rows count repeatedly, an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, discard, staged, steps, utf8
from .words import lower, mix, span_hashes, spans

#: Bytes of text in a chunk, on average; bytes hashed at a time in it.
CHUNK_BYTES, HASH_BYTES = 6_000_000, 1_000_000
#: One training text of so many is held out for the weights.
FOLDS = 8
#: Rounds of expectation-maximisation at most; it ends early when the likelihood gains less than GAIN a token.
ROUNDS, GAIN = 20, 1e-5
#: Weight of the estimate where no held-out count speaks of a bucket, and the most a weight may be.
PLAIN_WEIGHT, MOST_WEIGHT = 0.5, 1 - 1e-6
BUCKETS = 64

_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_KEYS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_LEVEL = np.uint64(3)


def held_out(id_: Column) -> Column:
    """Texts that are scored only; a null id is trained on."""
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 1, F.lit(False))


def _fold(id_: Column) -> Column:
    """0: counted, 1: held out for the weights, 2: scored only."""
    apart = F.coalesce(F.floor(F.crc32(id_.cast("string")) / 5) % FOLDS == 0, F.lit(False))
    return F.when(held_out(id_), 2).when(apart, 1).otherwise(0)


# N-grams of a chunk


@dataclass
class Tokens:
    """N-gram hashes of all tokens of some texts, the level (1 to 3) in the lowest bits."""

    one: np.ndarray
    two: np.ndarray
    three: np.ndarray
    bounds: np.ndarray

    @property
    def first(self) -> np.ndarray:
        return self.bounds[:-1]


def _hashed(level: int, *tokens: np.ndarray) -> np.ndarray:
    total = np.uint64(level) * _KEYS[2]
    for token, key in zip(tokens, _KEYS, strict=False):
        total = mix(total + token * key)
    return (total & ~_LEVEL) | np.uint64(level)


def tokens_of(texts: pa.Array | pa.ChunkedArray) -> Tokens:
    words, counts = [], []
    batch = pa.RecordBatch.from_arrays([texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts], names=["text"])
    for part in steps([batch], "text", HASH_BYTES):
        data, bounds = utf8(column(part, "text"))
        data = lower(data)
        starts, ends, text = spans(data, bounds)
        words.append(span_hashes(data, starts, ends))
        counts.append(np.bincount(text, minlength=part.num_rows))
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(n + 1)])
    token = np.full(bounds[-1], _END)
    last = np.zeros(bounds[-1], bool)
    last[bounds[1:] - 1] = True
    token[~last] = np.concatenate(words) if words else token[:0]
    first = np.zeros(bounds[-1], bool)
    first[bounds[:-1]] = True
    back = np.roll(token, 1)
    back[first] = _START
    back_two = np.roll(back, 1)
    back_two[first] = _START
    return Tokens(_hashed(1, token), _hashed(2, back, token), _hashed(3, back_two, back, token), bounds)


def grams_of(t: Tokens, lot: int) -> np.ndarray:
    """Lot 0: the single tokens, the bigrams, then a start and two starts for each text, being contexts; lot 1: the trigrams.

    A context counts as often as a token follows it, and a token other than the end is always followed.
    """
    if lot:
        return t.three
    texts, start = len(t.first), np.array([_START])
    return np.concatenate([t.one, t.two, np.repeat(_hashed(1, start), texts), np.repeat(_hashed(2, start, start), texts)])


def packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Whole numbers, as differences if ascending, in compressed planes of bytes."""
    values = values.astype(np.uint64)
    if ascending:
        values = np.diff(values, prepend=np.uint64(0))
    planes = values.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(values).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpacked(data: bytes, ascending: bool = False) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).reshape(-1)
    return np.cumsum(values, dtype=np.uint64) if ascending else values


# Counts for chunks


def _chunks(docs: DataFrame) -> DataFrame:
    """A row per chunk: its ids, and its texts in compressed Arrow form."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("text", pa.large_string())]), options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(pa.table([table["text"].cast(pa.large_string())], names=["text"]))
        ids = table["id"].combine_chunks()
        columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([sink.getvalue().to_pybytes()])]
        return pa.table(columns, names=["fold", "chunk", "ids", "texts"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.groupBy("fold", "chunk").applyInArrow(pack, f"fold int, chunk long, ids array<{kind}>, texts binary")


def _texts(packed_texts: bytes) -> pa.ChunkedArray:
    return pa.ipc.open_stream(packed_texts).read_all()["text"]


def _requests(chunks: DataFrame, ranges: int, lot: int) -> DataFrame:
    """A row per chunk and range of hashes: the chunk's distinct n-grams there, with their counts if it is trained on."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fold, chunk, texts in zip(*(column(batch, c) for c in ("fold", "chunk", "texts")), strict=True):
                grams, counts = np.unique(grams_of(tokens_of(_texts(texts.as_py())), lot), return_counts=True)
                at = np.searchsorted(((grams >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32), np.arange(ranges + 1))
                spans_ = [(k, a, b) for k, (a, b) in enumerate(zip(at, at[1:], strict=False)) if b > a]
                columns = [
                    pa.array([fold.as_py()] * len(spans_), pa.int32()),
                    pa.array([chunk.as_py()] * len(spans_), pa.int64()),
                    pa.array([k for k, _, _ in spans_], pa.int32()),
                    pa.array([packed(grams[a:b], True) for _, a, b in spans_], pa.binary()),
                    pa.array([packed(counts[a:b]) if fold.as_py() < 2 else None for _, a, b in spans_], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["fold", "chunk", "part", "grams", "counts"])

    return chunks.select("fold", "chunk", "texts").mapInArrow(ask, "fold int, chunk long, part int, grams binary, counts binary")


def _answers(requests: DataFrame) -> DataFrame:
    """For each request the counts in all training texts, and in those held out; a null chunk has tokens and distinct tokens."""

    def answer(table: pa.Table) -> pa.Table:
        folds, asked = table["fold"].to_pylist(), [unpacked(x.as_py(), True) for x in table["grams"]]
        grams, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        totals = np.zeros((2, len(grams)), np.int64)
        at = np.concatenate([[0], np.cumsum([len(x) for x in asked])]).tolist()
        for k, (fold, counts) in enumerate(zip(folds, table["counts"], strict=True)):
            if fold < 2:
                own = unpacked(counts.as_py()).astype(np.int64)
                # An n-gram occurs once in a request.
                totals[0, inverse[at[k] : at[k + 1]]] += own
                if fold == 1:
                    totals[1, inverse[at[k] : at[k + 1]]] += own
        tokens = (grams & _LEVEL == np.uint64(1)) & (grams != _hashed(1, np.array([_START]))[0])
        stats = [int(x) for x in (totals[0, tokens].sum(), totals[1, tokens].sum(), (totals[0, tokens] > 0).sum())]
        replies = [[packed(t[inverse[a:b]]) for a, b in zip(at, at[1:], strict=False)] for t in totals]
        n = len(folds)
        columns = [[*folds, None], [*table["chunk"].to_pylist(), None], [*table["part"].to_pylist(), None], [*replies[0], None], [*replies[1], None]]
        columns += [[None] * n + [x] for x in stats]
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 3)
        names = ["fold", "chunk", "part", "trained", "apart", "n_trained", "n_apart", "n_words"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "fold int, chunk long, part int, trained binary, apart binary, n_trained long, n_apart long, n_words long"
    return requests.groupBy("part").applyInArrow(answer, schema)


def _estimates(texts: pa.ChunkedArray, answers: pa.Table, held: bool) -> tuple[Tokens, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens; for each the buckets of its trigram and bigram context, its two estimates, and its own count; ``held``: without held-out texts."""
    t = tokens_of(texts)
    n, counts = len(t.one), []
    for lot in (0, 1):
        grams, inverse = np.unique(grams_of(t, lot), return_inverse=True)
        own = _in_order(answers, lot, "trained")
        if held:
            own = own - _in_order(answers, lot, "apart")
        counts.append(own.astype(np.float64)[inverse])
    one, two, three = counts[0][:n], counts[0][n : 2 * n], counts[1]
    # A token's contexts are the n-grams that ended before it, or the starts.
    context_one, context_two = np.roll(one, 1), np.roll(two, 1)
    context_one[t.first], context_two[t.first] = counts[0][2 * n : 2 * n + len(t.first)], counts[0][2 * n + len(t.first) :]
    ml3 = np.divide(three, context_two, out=np.zeros(n), where=context_two > 0)
    ml2 = np.divide(two, context_one, out=np.zeros(n), where=context_one > 0)
    return t, bucket(context_two), bucket(context_one), ml3, ml2, one


def bucket(frequency: np.ndarray) -> np.ndarray:
    """0 for 0, else 1 more than the whole binary logarithm."""
    return np.frexp(frequency)[1].clip(0, BUCKETS - 1).astype(np.uint8)


def _in_order(answers: pa.Table, lot: int, name: str) -> np.ndarray:
    """A chunk's answers of one lot as one array, aligned with its sorted n-grams."""
    lots, parts = answers["lot"].to_pylist(), answers["part"].to_pylist()
    rows = sorted((part, k) for k, (own, part) in enumerate(zip(lots, parts, strict=True)) if own == lot)
    return np.concatenate([unpacked(answers[name][k].as_py()) for _, k in rows] or [np.zeros(0, np.uint64)])


# Weights


@dataclass
class Weights:
    """Weights of the estimates: two by bucket of their context, and that of single words."""

    three: np.ndarray
    two: np.ndarray
    one: float

    @classmethod
    def plain(cls) -> Weights:
        by_bucket = np.full(BUCKETS, PLAIN_WEIGHT)
        by_bucket[0] = 0.0  # a context never seen has no estimate
        return cls(by_bucket, by_bucket.copy(), PLAIN_WEIGHT)

    def mixed(self, b3, b2, ml3, ml2, ml1, unknown: float) -> tuple[np.ndarray, ...]:  # noqa: ANN001
        """The probabilities, and what the three estimates add to them."""
        a3, a2 = self.three[b3], self.two[b2]
        parts = (a3 * ml3, (1 - a3) * a2 * ml2, (1 - a3) * (1 - a2) * self.one * ml1)
        return sum(parts) + (1 - a3) * (1 - a2) * (1 - self.one) * unknown, *parts

    def sums(self, b3, b2, ml3, ml2, ml1, unknown: float) -> np.ndarray:  # noqa: ANN001
        """Expected uses of each estimate and chances to use it, by level and bucket; the last row has tokens and log likelihood."""
        p, *parts = self.mixed(b3, b2, ml3, ml2, ml1, unknown)
        r3, r2, r1 = (x / p for x in parts)
        count = lambda b, w: np.bincount(b, w, minlength=BUCKETS)
        out = np.zeros((4, BUCKETS, 2))
        out[0, :, 0], out[0, :, 1] = count(b3, r3), count(b3, np.ones(len(b3)))
        out[1, :, 0], out[1, :, 1] = count(b2, r2), count(b2, 1 - r3)
        out[2, 0] = r1.sum(), (1 - r3 - r2).sum()
        out[3, 0] = len(p), np.log(p).sum()
        return out

    @classmethod
    def from_sums(cls, total: np.ndarray) -> Weights:
        found = cls.plain()
        for own, (use, chance) in ((found.three, total[0].T), (found.two, total[1].T)):
            seen = chance > 0
            seen[0] = False
            own[seen] = np.minimum(use[seen] / chance[seen], MOST_WEIGHT)
        if total[2, 0, 1] > 0:
            found.one = float(min(total[2, 0, 0] / total[2, 0, 1], MOST_WEIGHT))
        return found


def _estimate_rows(chunks: DataFrame, answers: DataFrame, n_counted: int) -> DataFrame:
    """The held-out texts' tokens as packed estimates under the counted texts, a row per chunk."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        _, b3, b2, ml3, ml2, c1 = _estimates(_texts(left["texts"][0].as_py()), right, True)
        columns = [x.tobytes() for x in (b3, b2, ml3, ml2, c1 / max(n_counted, 1))]
        return pa.table([pa.array([x], pa.binary()) for x in columns], names=["b3", "b2", "ml3", "ml2", "ml1"])

    apart = chunks.where("fold = 1").groupBy("fold", "chunk").cogroup(answers.where("fold = 1").groupBy("fold", "chunk"))
    return apart.applyInArrow(work, "b3 binary, b2 binary, ml3 binary, ml2 binary, ml1 binary")


def fit_weights(estimates: DataFrame, unknown: float) -> Weights:
    """Expectation-maximisation: a pass over the held-out estimates each round, of which a small table comes back."""
    weights, before = Weights.plain(), -math.inf
    for _ in range(ROUNDS):

        def expect(batches: Iterator[pa.RecordBatch], now: Weights = weights) -> Iterator[pa.RecordBatch]:
            total = np.zeros((4, BUCKETS, 2))
            for batch in batches:
                for k in range(batch.num_rows):
                    own = [np.frombuffer(column(batch, n)[k].as_py(), np.uint8 if n[0] == "b" else np.float64) for n in ("b3", "b2", "ml3", "ml2", "ml1")]
                    total += now.sums(*own, unknown)
            at = np.flatnonzero(total.any(axis=2).reshape(-1))
            flat = total.reshape(-1, 2)[at]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["at", "use", "chance"])

        rows = estimates.mapInArrow(expect, "at long, use double, chance double").groupBy("at").agg(F.sum("use"), F.sum("chance")).collect()
        total = np.zeros((4 * BUCKETS, 2))
        for at, use, chance in rows:
            total[at] = use, chance
        total = total.reshape(4, BUCKETS, 2)
        if not total[3, 0, 0]:
            break
        weights, now = Weights.from_sums(total), total[3, 0, 1] / total[3, 0, 0]
        if now - before < GAIN:
            break
        before = now
    return weights


def score_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row its id, ``held_out``, ``n_tokens``, ``n_known`` (seen in training), ``train_tokens``, ``base_score`` and ``score``.

    ``base_score`` is that of single tokens, sum of log10((c + 0.5) / (N + 0.5 (V + 1))); ``score`` is the
    interpolated model's log10 probability of the text with its end.
    """
    id_, text = docs[id_column], docs[text_column]
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, math.ceil(size / chunk_bytes))
    dealt = docs.select(id_.alias("id"), text.alias("text"), _fold(id_).alias("fold"), F.pmod(F.xxhash64(id_, text), F.lit(n)).alias("chunk"))
    chunks = staged(_chunks(dealt), "lm-chunks")
    lots = [staged(_answers(_requests(chunks, n, lot)), "lm-counts") for lot in (0, 1)]
    n_trained, n_apart, n_words = (int(x or 0) for x in lots[0].agg(F.sum("n_trained"), F.sum("n_apart"), F.sum("n_words")).first())
    unknown = 1 / (n_words + 1)
    by_lot = [x.where("part IS NOT NULL").select("fold", "chunk", F.lit(lot).alias("lot"), "part", "trained", "apart") for lot, x in enumerate(lots)]
    answers = by_lot[0].unionByName(by_lot[1])
    estimates = staged(_estimate_rows(chunks, answers, n_trained - n_apart), "lm-held-out")
    weights = fit_weights(estimates, unknown)
    discard(estimates)
    if not n_trained:
        weights.one = 0.0  # without training texts every token is as likely
    kind = dealt.schema["id"].dataType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        t, b3, b2, ml3, ml2, c1 = _estimates(_texts(left["texts"][0].as_py()), right, False)
        p = weights.mixed(b3, b2, ml3, ml2, c1 / max(n_trained, 1), unknown)[0]
        base = np.log10((c1 + 0.5) / (n_trained + 0.5 * (n_words + 1)))
        n, summed = len(t.first), lambda x: np.add.reduceat(x, t.first)
        columns = [
            left["ids"].combine_chunks().flatten(),
            pa.array([left["fold"][0].as_py() == 2] * n),
            pa.array(np.diff(t.bounds)),
            pa.array(summed((c1 > 0).astype(np.int64)), pa.int64()),
            pa.array(np.full(n, n_trained)),
            pa.array(summed(base), pa.float64()),
            pa.array(summed(np.log10(p)), pa.float64()),
        ]
        return pa.table(columns, names=[id_column, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    both = chunks.groupBy("fold", "chunk").cogroup(answers.drop("apart").groupBy("fold", "chunk"))
    schema = f"`{id_column}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = staged(both.applyInArrow(score, schema), "lm-scores")
    for done in (chunks, *lots):
        discard(done)
    return scored
