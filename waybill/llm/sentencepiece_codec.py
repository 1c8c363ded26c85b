"""SentencePiece unigram encoding and decoding with a vocabulary read from a model file.

Encoding puts a marker in front of the text and for each space, cuts the text
where a word's marker starts (no piece of the vocabulary spans such a place; the
constructor checks it) and finds, in each cut, the pieces with the largest sum
of log scores: a Viterbi search along a double-array trie. Characters outside
the vocabulary become byte pieces. Decoding joins the pieces, turns markers back
into spaces and drops the first.

The model file at hand has merge ranks for scores. They become log
probabilities by Zipf's law, ``-log(rank + 2)``, rounded to multiples of 2**-10
so that sums are exact. Of two equal sums the one whose last piece is longer wins.

Defined results: null and empty texts have no pieces and decode to an empty
text. Words of any length count in full: a long one is cut further where no piece
spans the place, which leaves the result as it is, and what is still long is
searched byte by byte. A text that holds U+2581 itself decodes to a space there, as the format
cannot tell them apart. Rows are independent of each other.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import chunks, words
from .common import column, lists, steps, strings, utf8, with_field
from .trie import DoubleArrayTrie

MARK = "▁"
#: What an unknown character costs below the worst piece, as in the public library.
UNKNOWN_PENALTY = 10.0
_SPACE = 0x20
#: Bytes of text per step; a step takes some sixty times as much memory.
STEP = 1_500_000
#: Start positions of a long span whose pieces are looked up at a time.
BLOCK = 200_000


def rank_score(rank: int) -> float:
    return round(-math.log(rank + 2) * 1024) / 1024


class UnigramModel:
    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], ids: list[int]):
        """Pieces with log scores and their ids; ``byte_ids`` are the ids of the 256 byte pieces."""
        entries = {piece.replace(MARK, " ").encode(): number for number, (piece, _) in enumerate(pieces)}
        if any(b" " in entry.lstrip(b" ") for entry in entries):
            raise ValueError("a piece has a marker behind another character")
        self.trie = DoubleArrayTrie.build(entries)
        self.score = np.array([score for _, score in pieces], np.float64)
        self.unknown = float(self.score.min()) - UNKNOWN_PENALTY
        self.longest = max(map(len, entries))
        self.ids = np.array([*ids, *byte_ids], np.int32)
        #: Bytes of each piece; the numbers behind the pieces are the 256 byte pieces.
        raw = [*entries, *(bytes([b]) for b in range(256))]
        self.n = len(pieces)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.length = np.array([len(r) for r in raw], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.number = np.full(int(self.ids.max()) + 1, -1, np.int64)
        self.number[self.ids] = np.arange(len(self.ids))

    @classmethod
    def load(cls, path: str) -> UnigramModel:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(model.is_unknown(i) for i in byte_ids):
            raise ValueError("the vocabulary has no byte pieces")
        normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        return cls([(model.id_to_piece(i), rank_score(rank)) for rank, i in enumerate(normal)], byte_ids, normal)

    def search(self, matrix: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of each row of bytes, one row after the other, and how many each has."""
        rows, width = matrix.shape
        best = np.full((rows, width + 5), -np.inf)
        best[:, 0] = 0
        came = np.zeros((rows, width + 5), np.int32)
        piece = np.full((rows, width + 5), -1, np.int32)
        wide = matrix.astype(np.int32)
        head = np.where(wide < 0x80, 1, np.where(wide < 0xE0, 2, np.where(wide < 0xF0, 3, 4)))
        for at in range(int(length.max(initial=0))):
            own = np.flatnonzero((length > at) & (best[:, at] > -np.inf))
            if not len(own):
                continue
            base = best[own, at]
            plain = np.ones(len(own), bool)  # has no piece of one character here
            live, node = np.arange(len(own)), np.zeros(len(own), np.int32)
            for to in range(at + 1, min(at + self.longest, width) + 1):
                keep = length[own[live]] >= to
                live, node = live[keep], node[keep]
                node = self.trie.step(node, wide[own[live], to - 1])
                live, node = live[node >= 0], node[node >= 0]
                if not len(live):
                    break
                found = self.trie.value[node]
                hit = live[found >= 0]
                if len(hit):
                    found = found[found >= 0]
                    plain[hit[head[own[hit], at] == to - at]] = False
                    sums = base[hit] + self.score[found]
                    better = sums > best[own[hit], to]
                    r = own[hit[better]]
                    best[r, to], came[r, to], piece[r, to] = sums[better], at, found[better]
            rest = np.flatnonzero(plain)
            if len(rest):
                r = own[rest]
                size = np.minimum(head[r, at], length[r] - at)
                sums = base[rest] + self.unknown
                better = sums > best[r, at + size]
                r, size, sums = r[better], size[better], sums[better]
                for k in range(int(size.max(initial=0))):
                    on = r[size > k]
                    came[on, at + k + 1], piece[on, at + k + 1] = at + k, self.n + wide[on, at + k]
                best[r, at + size] = sums
        taken, number = [], []
        spot, row = length.astype(np.int64).copy(), np.arange(rows)
        while len(row):
            taken.append(row)
            number.append(piece[row, spot[row]])
            spot[row] = came[row, spot[row]]
            row = row[spot[row] > 0]
        owner, number = np.concatenate(taken), np.concatenate(number)
        order = np.lexsort((-np.arange(len(owner)), owner))
        return number[order], np.bincount(owner, minlength=rows)

    def _found(self, data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of one span: their start, the bytes of the character at each position, and the pieces in them as
        start, length and number."""
        n = len(data)
        for begin in range(0, n, BLOCK):
            at = np.arange(begin, min(begin + BLOCK, n))
            byte = data[at]
            head = np.minimum(np.where(byte < 0x80, 1, np.where(byte < 0xE0, 2, np.where(byte < 0xF0, 3, 4))), n - at)
            live, node = at, np.zeros(len(at), np.int32)
            start, length, number = [], [], []
            for size in range(1, self.longest + 1):
                if live[-1] + size > n:
                    keep = live + size <= n
                    live, node = live[keep], node[keep]
                node = self.trie.step(node, data[live + size - 1].astype(np.int32))
                live, node = live[node >= 0], node[node >= 0]
                if not len(live):
                    break
                value = self.trie.value[node]
                hit = value >= 0
                start.append(live[hit])
                length.append(np.full(int(hit.sum()), size))
                number.append(value[hit])
            none = np.zeros(0, np.int64)
            yield begin, head, *(np.concatenate([none, *parts]).astype(np.int64) for parts in (start, length, number))

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Places inside a span that no piece and no character spans, so that both sides can be searched apart."""
        places, far = [], 0
        for begin, head, start, length, _ in self._found(data):
            at = np.arange(begin, begin + len(head))
            lead = (data[at] & 0xC0) != 0x80
            reach = np.where(lead, at + head, 0)
            np.maximum.at(reach, start - begin, start + length)
            before = np.maximum.accumulate(np.concatenate([[far], reach]))
            places.append(at[lead & (before[:-1] <= at)])
            far = int(before[-1])
        return np.concatenate(places)[1:] if places else np.zeros(0, np.int64)

    def search_long(self, data: np.ndarray) -> np.ndarray:
        """Piece numbers of one long span: the search of ``search`` along the list of the pieces found in it."""
        n = len(data)
        best = array("d", [-math.inf]) * (n + 1)
        came, piece = array("i", [0]) * (n + 1), array("i", [-1]) * (n + 1)
        best[0] = 0.0
        for begin, head, start, length, number in self._found(data):
            plain = np.ones(len(head), bool)
            plain[start[length == head[start - begin]] - begin] = False
            alone = np.flatnonzero(plain)
            starts = np.concatenate([start, begin + alone])
            ends = np.concatenate([start + length, begin + alone + head[alone]])
            gains = np.concatenate([self.score[number], np.full(len(alone), self.unknown)])
            numbers = np.concatenate([number, np.full(len(alone), -1)])
            order = np.argsort(starts, kind="stable")
            for a, b, gain, found in zip(*(x[order].tolist() for x in (starts, ends, gains, numbers)), strict=True):
                total = best[a] + gain
                if total > best[b]:
                    best[b], came[b], piece[b] = total, a, found
        taken, spot = [], n
        while spot:
            before = came[spot]
            taken += [piece[spot]] if piece[spot] >= 0 else (self.n + data[before:spot][::-1].astype(np.int64)).tolist()
            spot = before
        return np.array(taken[::-1], np.int64)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all texts and their n + 1 bounds. Texts are UTF-8 with a space in front."""
        texts = len(bounds) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(texts + 1, np.int64)
        space = data == _SPACE
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        wide = chunks.long_spans(starts, ends)
        if len(wide):
            starts = np.sort(np.concatenate([starts, *(a + self.cuts(data[a:b]) for a, b in zip(starts[wide], ends[wide], strict=True))]))
            ends = np.append(starts[1:], len(data))
        first, inverse = chunks.distinct(words.span_hashes(data, starts, ends))
        a, b = starts[first], ends[first]
        count, offset, found, total = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64), [], 0
        short = ((group, *self.search(matrix, (b - a)[group])) for group, matrix in chunks.matrices(data, a, b))
        longer = ((np.array([i]), self.search_long(data[a[i] : b[i]]), None) for i in chunks.long_spans(a, b))
        for group, numbers, each in (x for part in (short, longer) for x in part):
            count[group] = len(numbers) if each is None else each
            offset[group] = total + np.cumsum(count[group]) - count[group]
            found.append(numbers)
            total += len(numbers)
        numbers = np.concatenate(found)[chunks.ragged(offset[inverse], count[inverse])]
        at = np.searchsorted(starts, bounds)
        ends_at = np.concatenate([[0], np.cumsum(count[inverse])])
        return numbers, ends_at[at]

    def join(self, numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of each text's pieces, with spaces for markers, and their bounds."""
        size = self.length[numbers]
        data = self.bytes[chunks.ragged(self.start[numbers], size)] if len(numbers) else np.zeros(0, np.uint8)
        return data, np.concatenate([[0], np.cumsum(size)])[bounds]


def _led(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of the texts with one space in front of each that is not empty; U+2581 counts as a space."""
    texts = pc.replace_substring(texts, MARK, " ")
    return utf8(pc.if_else(pc.equal(pc.fill_null(texts, ""), ""), "", pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), "")))


def _decoded(model: UnigramModel, numbers: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Texts of the pieces, the first space dropped; bytes that are not UTF-8 become U+FFFD."""
    data, at = model.join(numbers, bounds)
    size = np.diff(at)
    skip = np.zeros(len(size), np.int64)
    full = size > 0
    skip[full] = data[at[:-1][full]] == _SPACE
    kept = chunks.ragged(at[:-1] + skip, size - skip)
    texts = strings(data[kept], np.concatenate([[0], np.cumsum(size - skip)]))
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        return pa.array([bytes(data[a + s : b]).decode(errors="replace") for a, s, b in zip(at[:-1], skip, at[1:], strict=True)], pa.string())
    return texts


def encode(df: DataFrame, model: UnigramModel, text_column: str = "text", ids_column: str = "piece_ids") -> DataFrame:
    """``df`` with the list of piece ids of each text; a column of that name is replaced."""
    kept = [c for c in df.columns if c != ids_column]
    rest = df.select(*(df[c] for c in kept))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, text_column, STEP):
            numbers, bounds = model.encode(*_led(column(part, text_column)))
            yield pa.RecordBatch.from_arrays([*part.columns, lists(model.ids[numbers], bounds)], names=[*kept, ids_column])

    return rest.mapInArrow(work, with_field(rest.schema, ids_column, "array<int>"))


def decode(df: DataFrame, model: UnigramModel, ids_column: str = "piece_ids", text_column: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of piece ids; ids outside the vocabulary decode to nothing."""
    kept = [c for c in df.columns if c != text_column]
    rest = df.select(*(df[c] for c in kept))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column(batch, ids_column)
            empty = pa.array([[]] * 1, ids.type)[0]
            ids = pc.fill_null(ids, empty) if ids.null_count else ids
            size = np.asarray(pc.list_value_length(ids))
            flat = np.asarray(pc.fill_null(ids.flatten(), -1)).astype(np.int64)
            number = np.where((flat >= 0) & (flat < len(model.number)), model.number[np.clip(flat, 0, len(model.number) - 1)], -1)
            bounds = np.concatenate([[0], np.cumsum(size)])
            good = np.concatenate([[0], np.cumsum(number >= 0)])[bounds]
            texts = _decoded(model, number[number >= 0], good)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*kept, text_column])

    return rest.mapInArrow(work, with_field(rest.schema, text_column, "string"))


def with_pieces(df: DataFrame, model: UnigramModel, text_column: str = "text", ids_column: str = "piece_ids", decoded_column: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``df`` with the piece ids of each text and the text they give back.

    Columns of those names are replaced.
    """
    kept = [c for c in df.columns if c not in (ids_column, decoded_column)]
    rest = df.select(*(df[c] for c in kept))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, text_column, STEP):
            numbers, bounds = model.encode(*_led(column(part, text_column)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, lists(model.ids[numbers], bounds), _decoded(model, numbers, bounds)],
                names=[*kept, ids_column, decoded_column],
            )

    return rest.mapInArrow(work, with_field(with_field(rest.schema, ids_column, "array<int>"), decoded_column, "string"))


def round_trips(df: DataFrame, model: UnigramModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row its id, ``n_pieces``, ``n_byte_pieces``, the SHA-256 of its ids (little-endian 32-bit numbers) and
    whether decoding gives the text back."""
    source = df.select(df[id_column].alias("id"), df[text_column].alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text", STEP):
            texts = column(part, "text")
            numbers, bounds = model.encode(*_led(texts))
            same = pc.equal(_decoded(model, numbers, bounds), pc.fill_null(texts, ""))
            ids = np.ascontiguousarray(model.ids[numbers])
            digest = [hashlib.sha256(ids[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [column(part, "id"), pa.array(np.diff(bounds)), pa.array(chunks.sums(numbers >= model.n, bounds)), pa.array(digest, pa.string()), same],
                names=[id_column, "n_pieces", "n_byte_pieces", "ids_sha256", "round_trip"],
            )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(work, f"`{id_column}` {kind}, n_pieces bigint, n_byte_pieces bigint, ids_sha256 string, round_trip boolean")
