"""Repeated passages: maximal repeats from common-prefix intervals of suffix arrays.

How the corpus is cut so that no task holds all of it: every window of
``min_length`` bytes has an anchor, the 24-byte string in it with the smallest
hash. Consecutive windows with one anchor form a piece of text, and equal windows
lie in pieces with equal anchors. So

1. anchors are dealt out by their hash and those of a single document end there
   (of an anchor that a task sees in several documents two rows are enough to meet
   others, the rest are known to be shared);
2. the pieces of the other anchors are placed: position, length and a hash. Where
   all pieces of an anchor are equal, all but those of the smallest document are
   repeats as a whole;
3. of the rest, each distinct piece is cut out once. Pieces with one anchor meet,
   and an enhanced suffix array of them gives the intervals of suffixes with a
   common prefix of at least ``min_length`` bytes. A stack scan finds them; those
   whose suffixes have different bytes on the left (or a piece's start) are the
   maximal repeat groups, with all occurrences;
4. each piece takes home the parts that start in a smaller document too.

Texts are UTF-8 bytes and matches stay within a document. Defined results: null
and empty texts and texts shorter than ``min_length`` have nothing removed. A
null id counts as larger than all others. Rows with the same id are one document:
they do not match each other; repeated rows give repeated results. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import chunks
from .common import column, discard, staged, steps, strings, utf8, with_field
from .words import mix, span_hashes

#: Bytes of an anchor. Shorter ones are fewer, but more of them are shared by chance.
ANCHOR = 24
LAST = (1 << 63) - 1
#: Bytes of pieces that one suffix array holds, unless a single anchor has more.
ARRAY_BYTES = 1_000_000
#: Bytes of text that are cut into pieces at a time: some ten arrays of 64-bit values of that length live at once.
PIECE_BYTES = 1_000_000


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the anchor-sized string from each place on; the last places are padded."""
    padded = np.concatenate([data, np.zeros(ANCHOR, np.uint8)])
    total = np.zeros(len(data), np.uint64)
    for at in range(0, ANCHOR, 8):
        total = (total ^ np.ndarray(len(data), "<u8", padded, at, (1,))) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    return mix(total)


def pieces(data: np.ndarray, bounds: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start, end and anchor hash of each piece; starts and ends are places in ``data``."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    n, width = len(data), min_length - ANCHOR + 1
    if n < min_length:
        return none
    hashes = _anchor_hashes(data)
    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    least, size = packed, 1
    while 2 * size <= width:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    least = np.minimum(least[: n - width + 1], least[width - size : n - size + 1])
    length = np.diff(bounds)
    windows = np.maximum(0, length - min_length + 1)
    start = chunks.ragged(bounds[:-1], windows)
    if not len(start):
        return none
    text = np.repeat(np.arange(len(length)), windows)
    anchor = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[first[1:], len(start)] - 1
    return text[first], start[first], start[last] + min_length, hashes[anchor[first]]


def _ranks(values: np.ndarray) -> np.ndarray:
    """The rank from 1 of each value among the distinct ones."""
    order = np.argsort(values)
    ordered = values[order]
    ranks = np.empty(len(values), np.int32)
    ranks[order] = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]], dtype=np.int32)
    return ranks


def _recurring(contents: list[bytes], least: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The stretches of the strings that windows of ``least`` bytes cover which occur more than once, by hash, with their
    strings and offsets.

    A repeat lies within such a stretch, with every byte that all its places share on either side.
    """
    none = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.array([len(c) for c in contents], np.int64)
    count = np.maximum(0, size - least + 1)
    if not count.any():
        return none
    joined = b"".join(contents)
    bounds = np.r_[0, np.cumsum(size)]
    start = chunks.ragged(bounds[:-1], count)
    hashes = span_hashes(np.frombuffer(joined, np.uint8), start, start + least)
    # By value, one place next to the other: windows equal to a neighbour occur again.
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    again = np.zeros(len(start), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    start = start[again]
    if not len(start):
        return none
    row = np.repeat(np.arange(len(size)), count)[again]
    head = np.flatnonzero(np.r_[True, (np.diff(start) != 1) | (np.diff(row) != 0)])
    first, end = start[head], start[np.r_[head[1:], len(start)] - 1] + least
    return [joined[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)], row[head], first - bounds[row[head]]


def maximal_repeats(contents: list[bytes], least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, string numbers and offsets of each maximal repeat of at least ``least`` bytes in the strings.

    A group holds all occurrences. Strings are equal to nothing beyond their ends. Only stretches that recur
    are sorted; what is before and after them is different everywhere.
    """
    contents, string, offset = _recurring(contents, least)
    size = np.array([len(c) for c in contents], np.int64)
    if not len(size):
        return
    stride = int(size.max()) + 1
    table = np.zeros((len(contents), stride), np.uint8)
    table[np.arange(stride)[None, :] < size[:, None]] = np.frombuffer(b"".join(contents), np.uint8)
    flat = np.concatenate([table.ravel(), np.zeros(2 * stride + 64, np.uint8)])
    n = table.size
    row = np.repeat(np.arange(len(size), dtype=np.int32), stride)
    left_over = np.repeat(size.astype(np.int32), stride) - np.tile(np.arange(stride, dtype=np.int32), len(size))

    # Ranks of the prefixes of 8, 16, ... bytes, up to the longest string; a string's end is below every byte.
    eight = np.zeros(n + stride + 1, np.uint64)
    for k in range(8):
        eight[:n] = (eight[:n] << np.uint64(8)) | flat[k : k + n]
    inside = np.flatnonzero(left_over > 0).astype(np.int32)
    ranks = np.zeros(n + stride + 1, np.int32)
    ranks[inside] = _ranks(eight[inside])
    del eight
    levels = [(8, ranks)]
    reach = 8
    while reach < stride:
        both = ranks[inside].astype(np.int64) << 32
        both |= ranks[inside + np.minimum(reach, left_over[inside])]
        wider = np.zeros(n + stride + 1, np.int32)
        wider[inside] = _ranks(both)
        ranks = wider
        reach *= 2
        levels.append((reach, ranks))

    suffix = np.flatnonzero(left_over >= least)
    suffix = suffix[np.argsort(ranks[suffix], kind="stable")]
    a, b = suffix[:-1], suffix[1:]
    limit = np.minimum(left_over[a], left_over[b]).astype(np.int64)
    common = np.zeros(len(a), np.int64)
    for width, rank in reversed(levels):
        common += np.where(rank[a + common] == rank[b + common], width, 0)
        common = np.minimum(common, limit)
    for _ in range(7):
        more = (common < limit) & (flat[a + common] == flat[b + common])
        common += more
    # Runs of suffixes that share the least length, less those that all extend to the left alike.
    before = np.where(suffix % stride > 0, flat[suffix - 1].astype(np.int64), -1)
    joined = common >= least
    edge = np.flatnonzero(np.diff(np.r_[False, joined, False].astype(np.int8)))
    for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        lefts = before[lo : hi + 1]
        if lefts[0] >= 0 and (lefts == lefts[0]).all():
            continue
        # Stack scan: (common length, first suffix) of the open intervals.
        stack: list[tuple[int, int]] = []
        for k, height in enumerate([*common[lo:hi].tolist(), 0], lo):
            start = k
            while stack and stack[-1][0] > height:
                length, start = stack.pop()
                own = before[start : k + 1]
                if own[0] < 0 or (own != own[0]).any():
                    members = suffix[start : k + 1]
                    part = row[members]
                    yield length, string[part], members - part * np.int64(stride) + offset[part]
            if height and (not stack or stack[-1][0] < height):
                stack.append((height, start))


def _spans(contents: list[bytes], firsts: np.ndarray, lasts: np.ndarray, least: int) -> list[list[tuple[int, int, int]]]:
    """Per string, parts (offset, end, smallest document) that also start in that document."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in contents]
    for k, (content, first, last) in enumerate(zip(contents, firsts.tolist(), lasts.tolist(), strict=True)):
        if last > first:
            found[k][0, len(content)] = first
    for length, rows, offsets in maximal_repeats(contents, least):
        smallest = int(firsts[rows].min())
        for k in np.flatnonzero(lasts[rows] > smallest).tolist():
            own, part = found[rows[k]], (int(offsets[k]), int(offsets[k]) + length)
            if smallest < own.get(part, LAST + 1):
                own[part] = smallest
    result = []
    for own in found:
        parts = sorted((a, -b, d) for (a, b), d in own.items())
        # A part inside another one with as small a document says nothing new.
        result.append([(a, -b, d) for k, (a, b, d) in enumerate(parts) if not any(x <= a and y <= b and e <= d and (x, y) != (a, b) for x, y, e in parts)])
    return result


def repeated_spans(docs: DataFrame, min_length: int) -> DataFrame:
    """For ``row`` (a key of id and text), ``rank`` (the id to compare by) and ``text``: the byte spans of each row that
    are covered by windows which also start in a document of smaller rank, as ``row`` and lists ``starts`` and ``ends``."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text", PIECE_BYTES):
            text, _, _, key = pieces(*utf8(column(part, "text")), min_length)
            row = column(part, "row").to_numpy()[text]
            # Rows of a key may come in any order: a row told twice is one later on.
            order = np.argsort(key)
            key, row = key[order].view(np.int64), row[order]
            if not len(key):
                continue
            new = np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])]
            key, row = key[new], row[new]
            # Of the rows of a key the first two meet those of other tasks, by route.
            third = np.r_[False, False, key[2:] == key[:-2]][: len(key)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(third, row, key)), pa.array(np.where(third, key, 0)), pa.array(row)], names=["route", "told", "row"]
            )

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of route, told and row; one passes if it is told or its key has several rows."""
        rest: pa.RecordBatch | None = None  # the last row, whose key may go on
        linked = False
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([rest, batch] if rest else [batch]).combine_chunks().to_batches()[0]
            route, told, row = (column(whole, c).to_numpy() for c in ("route", "told", "row"))
            fresh = np.r_[True, (route[1:] != route[:-1]) | (told[1:] != told[:-1]) | (row[1:] != row[:-1])]
            route, told, row = route[fresh], told[fresh], row[fresh]
            same = (route[1:] == route[:-1]) & (told[1:] == 0) & (told[:-1] == 0)
            before = np.r_[linked and rest is not None, same]
            keep = before | np.r_[same, False] | (told != 0)
            # The first row has passed already if it was told or linked; the last waits unless it is.
            sure = bool(before[-1] or told[-1] != 0)
            keep[0] &= not linked
            keep[-1] &= sure
            key = np.where(told != 0, told, route)
            yield pa.RecordBatch.from_arrays([pa.array(row[keep]), pa.array(key[keep])], names=["row", "key"])
            linked, rest = sure, batch.slice(batch.num_rows - 1)

    asked = docs.where(F.octet_length("text") >= min_length).select("row", "rank", "text")
    found = asked.select("row", "text").mapInArrow(anchors, "route long, told long, row long")
    meeting = found.repartition("route").sortWithinPartitions("route", "told", "row")
    keys = staged(meeting.mapInArrow(shared, "row long, key long"), "repeat-anchors")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text", PIECE_BYTES):
            data, bounds = utf8(column(part, "text"))
            text, start, end, key = pieces(data, bounds, min_length)
            wanted = np.unique(np.asarray(column(part, "keys").flatten()))
            on = np.isin(key.view(np.int64), wanted)
            text, start, end, key = text[on], start[on], end[on], key[on]
            piece = span_hashes(data, start, end)
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "row").take(pa.array(text)),
                    column(part, "rank").take(pa.array(text)),
                    pa.array((start - bounds[text]).astype(np.int32)),
                    pa.array((end - start).astype(np.int32)),
                    pa.array(key.view(np.int64)),
                    pa.array(piece.view(np.int64)),
                ],
                names=["row", "rank", "start", "size", "key", "piece"],
            )

    per_row = keys.groupBy("row").agg(F.collect_set("key").alias("keys"))
    found = asked.join(per_row, "row").mapInArrow(placed, "row long, rank long, start int, size int, key long, piece long")
    occurrences = staged(found, "repeat-pieces")
    discard(keys)
    groups = occurrences.groupBy("key").agg(
        F.min("rank").alias("first"), F.max("rank").alias("last"), (F.min("piece") != F.max("piece")).alias("mixed")
    )
    groups = groups.where("first < last").select("key", "first", "mixed")
    open_ = staged(occurrences.join(groups, "key").where("mixed OR rank > first"), "repeat-open")
    discard(occurrences)
    mixed = open_.where("mixed").drop("mixed", "first")
    distinct = mixed.groupBy("key", "piece").agg(
        F.min("rank").alias("first"), F.max("rank").alias("last"), F.min(F.struct("row", "start", "size")).alias("at")
    )
    place = F.struct("at.start", "at.size", "key", "piece", "first", "last")
    wanted = staged(distinct.groupBy("at.row").agg(F.collect_list(place).alias("places")), "repeat-places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            data, bounds = utf8(column(part, "text"))
            places = column(part, "places")
            flat = places.flatten()
            text = np.repeat(np.arange(part.num_rows), np.asarray(places.value_lengths()))
            start, size = flat.field("start").to_numpy() + bounds[text], flat.field("size").to_numpy().astype(np.int64)
            content = pa.Array.from_buffers(
                pa.binary(), len(size), [None, pa.py_buffer(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.py_buffer(data[chunks.ragged(start, size)])]
            )
            names = ["key", "piece", "first", "last"]
            yield pa.RecordBatch.from_arrays([*(flat.field(c) for c in names), content], names=[*names, "content"])

    contents = asked.select("row", "text").join(wanted, "row").mapInArrow(cut, "key long, piece long, first long, last long, content binary")

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: pa.Table) -> pa.RecordBatch:
            contents = rows["content"].to_pylist()
            spans = _spans(contents, rows["first"].to_numpy(), rows["last"].to_numpy(), min_length)
            some = [k for k, own in enumerate(spans) if own]
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("d", pa.int64())]))
            parts = pa.array([[dict(zip("abd", s, strict=True)) for s in spans[k]] for k in some], kind)
            at = pa.array(some, pa.int64())
            return pa.RecordBatch.from_arrays(
                [rows["key"].combine_chunks().take(at), rows["piece"].combine_chunks().take(at), parts], names=["key", "piece", "parts"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.nbytes for b in held) < ARRAY_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            key = rows["key"].to_numpy()
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.r_[0, np.cumsum(np.asarray([len(c) for c in rows["content"].to_pylist()]))]
            begin = 0
            for head in heads[1:].tolist():
                following = heads[np.searchsorted(heads, head) + 1] if head != heads[-1] else head
                if size[following] - size[begin] > ARRAY_BYTES or head == heads[-1]:
                    yield flush(rows.slice(begin, head - begin))
                    begin = head
            held = rows.slice(begin).to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))

    meeting = contents.repartition("key").sortWithinPartitions("key", "piece")
    parts = meeting.mapInArrow(arrays, "key long, piece long, parts array<struct<a: int, b: int, d: long>>")
    smaller = F.filter("parts", lambda p: p["d"] < F.col("rank"))
    partly = (
        mixed.join(staged(parts, "repeat-parts"), ["key", "piece"])
        .select("row", "start", smaller.alias("parts"))
        .where(F.size("parts") > 0)
        .select(
            "row",
            F.transform("parts", lambda p: p["a"] + F.col("start")).alias("starts"),
            F.transform("parts", lambda p: p["b"] + F.col("start")).alias("ends"),
        )
    )
    whole = open_.where("NOT mixed").select("row", F.array("start").alias("starts"), F.array(F.col("start") + F.col("size")).alias("ends"))
    spans = partly.unionByName(whole).groupBy("row")
    result = staged(spans.agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")), "repeat-spans")
    for used in (open_, wanted):
        discard(used)
    return result


def _keyed(df: DataFrame, id_column: str, text_column: str) -> tuple[Column, Column, Column]:
    text = F.coalesce(df[text_column], F.lit(""))
    rank = F.coalesce(df[id_column].cast("long"), F.lit(LAST))
    return F.xxhash64(rank, text).alias("row"), rank.alias("rank"), text.alias("text")


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    head = np.r_[True, starts[1:] > ends[:-1]]
    return starts[head], ends[np.r_[head[1:], True]]


def _kept(text: bytes, starts: list[int] | None, ends: list[int] | None) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of runs removed."""
    if not starts:
        return text, 0
    a, b = _merged(np.array(starts), np.array(ends))
    return b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True)), len(a)


def repeat_digests(df: DataFrame, min_length: int = 50, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: its id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of the bytes left."""
    keyed = df.select(df[id_column].alias("id"), *_keyed(df, id_column, text_column))
    spans = repeated_spans(keyed.select("row", "rank", "text"), min_length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            data, bounds = utf8(column(part, "text"))
            rows = []
            for k, (starts, ends) in enumerate(zip(column(part, "starts").to_pylist(), column(part, "ends").to_pylist(), strict=True)):
                text = bytes(data[bounds[k] : bounds[k + 1]])
                kept, runs = _kept(text, starts, ends)
                rows.append((len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [column(part, "id"), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([r[3] for r in rows], pa.string())],
                names=[id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = keyed.schema["id"].dataType.simpleString()
    joined = keyed.join(spans, "row", "left").select("id", "text", "starts", "ends")
    return joined.mapInArrow(work, f"`{id_column}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(df: DataFrame, min_length: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``df`` with repeated passages cut from its texts; rows of which nothing but white space is left go.

    A character that a cut splits goes as a whole. Rows that lose nothing stay as they are.
    """
    columns = df.columns
    row, rank, text = _keyed(df, id_column, text_column)
    spans = repeated_spans(df.select(row, rank, text), min_length)
    packed = df.select(row, F.struct(*(df[c] for c in columns)).alias("own"), df[text_column].alias("text"))
    joined = packed.join(spans, "row", "left").select("own", "text", "starts", "ends")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            texts, keep = [], []
            for text, starts, ends in zip(*(column(part, c).to_pylist() for c in ("text", "starts", "ends")), strict=True):
                left = _kept(text.encode(), starts, ends)[0].decode(errors="ignore") if starts else text
                texts.append(left)
                keep.append(not starts or not left.isspace() and left != "")
            batch = pa.RecordBatch.from_arrays([column(part, "own"), pa.array(texts, pa.string())], names=["own", "left"])
            yield batch.filter(pa.array(keep, pa.bool_()))

    cut = joined.mapInArrow(work, with_field(packed.select("own").schema, "left", "string"))
    return cut.select(*(F.col("left").alias(c) if c == text_column else F.col("own").getField(c).alias(c) for c in columns))
