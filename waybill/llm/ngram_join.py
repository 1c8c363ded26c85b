"""N-gram Jaccard join: prefix keys, size-banded tiles, bitmap bounds, exact intersections.

Two documents link when the Jaccard similarity of their sets of word shingles is
at least ``percent`` / 100. The join is exact (up to equal 64-bit hashes):

1. Documents with equal sets form a class; only classes go on.
2. A class offers the rarest ``n - ceil(t n) + 1`` of its shingles as keys. Two
   classes that link share a key. Shingles that are frequent anywhere are last in
   that order, so common passages seldom become keys.
3. Of the classes under a key, those next to each other by size are compared
   first. That joins most families; what is left are keys with classes of several
   components.
4. The classes under such a key are cut into tiles of ``TILE`` and compared tile
   by tile, only classes of different components and of sizes and places of the key
   that can link; rows without such a partner go before bitmaps are joined to the rest. Bitmaps of hashed shingles, with widths by size band, bound the overlap from
   above by bit counts; what passes is settled by intersecting the sorted sets. A
   set of classes that passes is settled once, under whatever keys it met, and returns
   the links that join components, no more than it has classes.

Defined results: null, empty and blank texts have an empty set and link with
nothing. A null id takes part and is never the component's id unless all are
null. Rows are not merged by id; repeated rows are copies, which link. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, discard, staged, steps, utf8
from .components import components
from .words import mix, shingle_sets

TILE = 2048
#: The list of frequent shingles decides an order only, never a result; its size is bounded.
FREQUENT_SHINGLES = 200_000
#: A task lists a shingle that this many documents of a step have.
FREQUENT_IN_STEP = 4
#: Bits of a bitmap per shingle before rounding up to a power of two. Two turn away sets of which less than about
#: half is common and are what travels; next to the sets themselves finer ones cost nothing.
BITS_PER_SHINGLE, FINE_BITS = 2, 16
WIDEST = 1 << 16


def _digest(shingles: np.ndarray) -> int:
    """A 64-bit digest of a set."""
    if not len(shingles):
        return 0
    parts = np.array([mix(shingles).sum(dtype=np.uint64), np.bitwise_xor.reduce(shingles)])
    return int(mix(parts * np.array([1, 2 * len(shingles) + 1], np.uint64)).sum(keepdims=True).view(np.int64)[0])


def bitmap(shingles: np.ndarray, per_shingle: int = BITS_PER_SHINGLE) -> np.ndarray:
    """64-bit words of a bitmap whose width depends on the size band."""
    width = 64
    while width < min(WIDEST, per_shingle * len(shingles)):
        width *= 2
    bits = np.zeros(width, np.uint8)
    bits[(shingles >> np.uint64(20)).astype(np.int64) & (width - 1)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of sets of these sizes that links them."""
    return -(-percent * (a + b) // (100 + percent))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    spot = np.searchsorted(b, a)
    return int((b[np.minimum(spot, len(b) - 1)] == a).sum()) if len(b) else 0


def _folded(maps: list[np.ndarray], words: int) -> np.ndarray:
    """Bitmaps brought to one width; a wide one is folded, its halves OR-ed."""
    rows = np.empty((len(maps), words), np.uint64)
    for k, own in enumerate(maps):
        while len(own) > words:
            own = own[: len(own) // 2] | own[len(own) // 2 :]
        rows[k] = own
    return rows


def tile_pairs(n: np.ndarray, pos: np.ndarray, label: np.ndarray, side: np.ndarray, maps: list[np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs that may link, by size, place of the key and bitmap bound; rows of one side are not paired unless side is 2."""
    words = np.array([len(m) for m in maps])
    bands = [(w, np.flatnonzero(words == w)) for w in np.unique(words)]
    for x, (narrow, first) in enumerate(bands):
        for _, second in bands[x:]:
            if 100 * n[first].max() < percent * n[second].min():
                continue
            left, right = _folded([maps[k] for k in first], narrow), _folded([maps[k] for k in second], narrow)
            own_left, own_right = np.bitwise_count(left).sum(axis=1), np.bitwise_count(right).sum(axis=1)
            for start in range(0, len(first), 256):
                a = first[start : start + 256]
                na, nb = n[a][:, None], n[second][None, :]
                need = needed(na, nb, percent)
                fits = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (label[a][:, None] != label[second][None, :])
                fits &= np.minimum(na - pos[a][:, None], nb - pos[second][None, :]) >= need
                fits &= (side[a][:, None] != side[second][None, :]) | (side[a][:, None] == 2)
                if first is second:
                    fits &= a[:, None] < second[None, :]
                i, j = np.nonzero(fits)
                for part in np.array_split(np.arange(len(i)), max(1, len(i) * narrow // 2_000_000)):
                    p, q = i[part], j[part]
                    both = np.bitwise_count(left[start + p] & right[q]).sum(axis=1).astype(np.int64)
                    hidden = np.minimum(n[a[p]] - own_left[start + p], n[second[q]] - own_right[q])
                    passes = both + hidden >= need[p, q]
                    yield a[p[passes]], second[q[passes]]


def comparable(group: np.ndarray, n: np.ndarray, pos: np.ndarray, label: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """Which rows have a partner in their group by all that ``tile_pairs`` asks but the bitmaps; rows in order of group and ``n``."""
    found, at, ahead = np.zeros(len(n), bool), np.arange(len(n)), 0
    while len(at):
        ahead += 1
        at = at[at + ahead < len(n)]
        # A row too large to link is followed by larger ones.
        at = at[(group[at] == group[at + ahead]) & (100 * n[at] >= percent * n[at + ahead])]
        to = at + ahead
        fits = (label[at] != label[to]) & ((side[at] != side[to]) | (side[at] == 2))
        fits &= np.minimum(n[at] - pos[at], n[to] - pos[to]) >= needed(n[at], n[to], percent)
        found[at[fits]] = found[to[fits]] = True
    return found


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows in lots of whole groups, with the number of each row's group."""

    def numbered(lot: pa.Table) -> np.ndarray:
        change = np.zeros(lot.num_rows, np.int64)
        for k in keys:
            value = lot[k].to_numpy()
            change[1:] |= value[1:] != value[:-1]
        return np.cumsum(change)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        lot = pa.Table.from_batches([*held, batch])
        group = numbered(lot)
        whole = int(np.searchsorted(group, group[-1]))
        if whole:
            yield lot.slice(0, whole), group[:whole]
        held = lot.slice(whole).to_batches()
    if held:
        lot = pa.Table.from_batches(held)
        yield lot, numbered(lot)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, which come one after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [column(batch, k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        change[0] = last is not None and last != tuple(v[0] for v in values)
        cuts = np.flatnonzero(change)
        begin = 0
        for cut in cuts.tolist():
            held.append(batch.slice(begin, cut - begin))
            yield pa.Table.from_batches(held)
            held, begin = [], cut
        held.append(batch.slice(begin))
        last = tuple(v[-1] for v in values)
    if held:
        yield pa.Table.from_batches(held)


def _keyed(df: DataFrame, id_column: str, text_column: str) -> tuple[Column, Column]:
    text = F.coalesce(df[text_column], F.lit(""))
    return F.xxhash64(df[id_column], text).alias("row"), text.alias("text")


class _Join:
    def __init__(self, docs: DataFrame, size: int, percent: int):
        """``docs`` has ``row``, ``id`` and ``text``."""
        self.docs, self.size, self.percent = docs, size, percent
        self.texts = docs.select("row", "text")

    def summaries(self) -> DataFrame:
        size = self.size

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in steps(batches, "text"):
                sets = shingle_sets(*utf8(column(part, "text")), size)
                yield pa.RecordBatch.from_arrays(
                    [column(part, "row"), column(part, "id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.int64()), pa.array([bitmap(s).tobytes() for s in sets], pa.binary())],
                    names=["row", "id", "n", "cls", "bits"],
                )

        source = self.docs.select("row", "id", "text")
        return source.mapInArrow(work, f"row long, id {source.schema['id'].dataType.simpleString()}, n long, cls long, bits binary")

    def frequent(self) -> tuple[np.ndarray, np.ndarray]:
        """Frequent shingles in hash order with their counts: what every task finds in its steps, added up."""
        size = self.size

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in steps(batches, "text"):
                sets = shingle_sets(*utf8(column(part, "text")), size)
                values, counts = np.unique(np.concatenate(sets), return_counts=True)
                often = counts >= FREQUENT_IN_STEP
                yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], names=["s", "c"])

        listed = self.texts.select("text").mapInArrow(work, "s long, c long").groupBy("s").agg(F.sum("c").alias("c"))
        rows = listed.orderBy(F.desc("c"), "s").limit(FREQUENT_SHINGLES).toArrow()
        shingles, counts = rows["s"].to_numpy().view(np.uint64), rows["c"].to_numpy()
        order = np.argsort(shingles)
        return shingles[order], counts[order]

    def keys(self) -> DataFrame:
        """(key, cls, n, pos) of the prefixes; a class that a step sees again is left out."""
        size, percent = self.size, self.percent
        listed, counts = self.frequent()

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in steps(batches, "text"):
                once = {_digest(s): s for s in shingle_sets(*utf8(column(part, "text")), size) if len(s)}
                out: list[tuple[np.ndarray, int, int]] = []
                for digest, own in once.items():
                    take = len(own) - (percent * len(own) + 99) // 100 + 1
                    if len(listed):
                        spot = np.minimum(np.searchsorted(listed, own), len(listed) - 1)
                        own = own[np.argsort(np.where(listed[spot] == own, counts[spot], 0), kind="stable")]
                    out.append((own[:take], digest, len(own)))
                lengths = [len(k) for k, _, _ in out]
                keys = np.concatenate([k for k, _, _ in out]) if out else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(np.repeat(np.array([d for _, d, _ in out], np.int64), lengths)),
                        pa.array(np.repeat(np.array([n for _, _, n in out], np.int32), lengths)),
                        pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths]) if out else np.zeros(0, np.int32)),
                    ],
                    names=["key", "cls", "n", "pos"],
                )

        return self.texts.select("text").mapInArrow(work, "key long, cls long, n int, pos int")

    def shared_keys(self) -> DataFrame:
        """The rows of keys that several classes have, each with its neighbour of next smaller size (or null)."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rest: pa.RecordBatch | None = None  # the last row, whose key may go on
            linked = False
            names = ["key", "cls", "n", "pos", "near"]

            def told(key, cls, n, pos, near, keep) -> pa.RecordBatch:
                batch = pa.RecordBatch.from_arrays([pa.array(key), pa.array(cls), pa.array(n), pa.array(pos), pa.array(near, mask=near == 0)], names=names)
                return batch.filter(pa.array(keep))

            for batch in batches:
                if not batch.num_rows:
                    continue
                whole = pa.Table.from_batches([rest, batch] if rest else [batch]).combine_chunks().to_batches()[0]
                key, cls, n, pos = (column(whole, c).to_numpy() for c in ("key", "cls", "n", "pos"))
                fresh = np.r_[True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])]
                key, cls, n, pos = key[fresh], cls[fresh], n[fresh], pos[fresh]
                same = key[1:] == key[:-1]
                near = np.r_[0, np.where(same, cls[:-1], 0)]
                before = np.r_[linked and rest is not None, same]
                keep = before | np.r_[same, False]
                # The first row was told already if its key had gone on; the last one waits unless it has a neighbour.
                keep[0] &= not linked
                yield told(key, cls, n, pos, near, keep & np.r_[np.ones(len(key) - 1, bool), before[-1]])
                linked = bool(before[-1])
                rest = batch.slice(batch.num_rows - 1)

        found = self.keys().repartition("key").sortWithinPartitions("key", "n", "cls")
        return found.mapInArrow(work, "key long, cls long, n int, pos int, near long")

    def sets(self, classes: DataFrame, summaries: DataFrame) -> DataFrame:
        """(cls, shingles) of the classes in ``classes``: the sorted set as bytes."""
        size = self.size

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in steps(batches, "text"):
                sets = shingle_sets(*utf8(column(part, "text")), size)
                yield pa.RecordBatch.from_arrays([column(part, "cls"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "shingles"])

        one = summaries.join(classes.distinct(), "cls").groupBy("cls").agg(F.min("row").alias("row"))
        texts = self.texts.join(one, "row").dropDuplicates(["row"]).select("cls", "text")
        return staged(texts.mapInArrow(work, "cls long, shingles binary"), "ngram-sets")

    def neighbour_links(self, rows: DataFrame, summaries: DataFrame) -> DataFrame:
        """Links between classes that follow each other under a key."""
        percent = self.percent
        maps = summaries.groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
        pairs = rows.where("near is not null").select(F.least("cls", "near").alias("a"), F.greatest("cls", "near").alias("b")).distinct()
        side = lambda c: maps.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))

        def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = column(batch, "n_a").to_numpy(), column(batch, "n_b").to_numpy()
                need = needed(a, b, percent)
                keep = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
                for k in np.flatnonzero(keep).tolist():
                    x, y = (np.frombuffer(column(batch, c)[k].as_py(), np.uint64) for c in ("bits_a", "bits_b"))
                    x, y = _folded([x, y], min(len(x), len(y)))
                    hidden = min(a[k] - int(np.bitwise_count(x).sum()), b[k] - int(np.bitwise_count(y).sum()))
                    keep[k] = int(np.bitwise_count(x & y).sum()) + hidden >= need[k]
                yield batch.select(["a", "b"]).filter(pa.array(keep))

        likely = staged(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(bound, "a long, b long"), "ngram-pairs")
        sets = self.sets(likely.select(F.explode(F.array("a", "b")).alias("cls")), summaries)

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = ([np.frombuffer(v, np.uint64) for v in column(batch, c).to_pylist()] for c in ("shingles_a", "shingles_b"))
                keep = [100 * (o := overlap(p, q)) >= percent * (len(p) + len(q) - o) for p, q in zip(x, y, strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        side = lambda c: sets.select(F.col("cls").alias(c), F.col("shingles").alias(f"shingles_{c}"))
        found = staged(likely.join(side("a"), "a").join(side("b"), "b").mapInArrow(exact, "a long, b long"), "ngram-links")
        for used in (likely, sets):
            discard(used)
        return found

    def tile_links(self, rows: DataFrame, labels: DataFrame, summaries: DataFrame) -> DataFrame:
        """Links between components that the neighbours left apart."""
        percent = self.percent
        rows = rows.drop("near").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
        rows = labelled = staged(rows, "ngram-rows")
        open_keys = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("rows")).where("low < high")
        tiles = F.ceil(F.col("rows") / TILE).cast("int")
        rows = rows.join(open_keys.select("key", tiles.alias("tiles")), "key").withColumn("tile", F.pmod(F.xxhash64("cls"), "tiles").cast("int"))
        others = F.sequence(F.lit(0), F.col("tiles") - 1)
        rows = rows.withColumn("other", F.explode(others)).select(
            "key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "cls", "n", "pos", "label", "tile"
        )
        schema = "team long, cls long, n int, label long"

        def partnered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for lot, group in _whole_groups(batches, ["key", "i", "j"]):
                yield from lot.filter(pa.array(comparable(group, *_sides(lot), percent))).to_batches()

        def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in _groups(batches, ["key", "i", "j"]):
                found = np.zeros(group.num_rows, bool)
                maps = [np.frombuffer(b, np.uint64) for b in group["bits"].to_pylist()]
                for a, b in tile_pairs(*_sides(group), maps, percent):
                    found[a] = found[b] = True
                if found.any():
                    # Two that are close meet under many keys: equal teams are one.
                    team = group.select(["cls", "n", "label"]).filter(pa.array(found)).combine_chunks()
                    name = np.full(team.num_rows, _digest(np.sort(team["cls"].to_numpy().view(np.uint64))))
                    yield from team.add_column(0, "team", pa.array(name)).to_batches()

        def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in _groups(batches, ["team"]):
                sets = [np.frombuffer(b, np.uint64) for b in group["shingles"].to_pylist()]
                cls, label = group["cls"].to_numpy(), group["label"].to_numpy()
                above = {x: x for x in label.tolist()}

                def top(x: int, above: dict[int, int] = above) -> int:
                    while above[x] != x:
                        above[x] = above[above[x]]
                        x = above[x]
                    return x

                out = []
                # The place of a key does not matter any more, nor do sides.
                n, same = np.array([len(s) for s in sets]), np.full(len(sets), 2)
                for left, right in tile_pairs(n, 0 * n, label, same, [bitmap(s, FINE_BITS) for s in sets], percent):
                    for a, b in zip(left.tolist(), right.tolist(), strict=True):
                        x, y = top(int(label[a])), top(int(label[b]))
                        if x != y:
                            o = overlap(sets[a], sets[b])
                            if 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
                                above[max(x, y)] = min(x, y)
                                out.append((int(cls[a]), int(cls[b])))
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

        maps = summaries.groupBy("cls").agg(F.first("bits").alias("bits"))
        ordered = lambda df: df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "cls")
        rows = staged(ordered(rows).mapInArrow(partnered, rows.schema), "ngram-partnered")
        discard(labelled)
        likely = ordered(rows.join(maps, "cls").select(*rows.columns, "bits")).mapInArrow(candidates, schema)
        likely = staged(likely.dropDuplicates(["team", "cls"]), "ngram-teams")
        discard(rows)
        sets = self.sets(likely.select("cls"), summaries)
        teams = likely.join(sets, "cls").repartition("team").sortWithinPartitions("team", "n", "cls")
        found = staged(teams.mapInArrow(links, "a long, b long"), "ngram-tile-links")
        for used in (likely, sets):
            discard(used)
        return found


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, places of the key, components and sides of a pair of tiles; in a tile paired with itself all sides are 2."""
    i, j, tile = (group[c].to_numpy() for c in ("i", "j", "tile"))
    side = np.where(i == j, 2, (tile == j).astype(np.int64))
    return group["n"].to_numpy().astype(np.int64), group["pos"].to_numpy().astype(np.int64), group["label"].to_numpy(), side


def shingle_components(df: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: ``row`` (a key of id and text), its id, ``n_shingles``, ``component_id``, the smallest id it is linked to,
    and ``keeper``, the row that stands for the component (of equal ids any one, but one; null for empty sets)."""
    row, text = _keyed(df, id_column, text_column)
    join = _Join(df.select(row, df[id_column].alias("id"), text), size, percent)
    summaries = staged(join.summaries(), "ngram-summaries")
    rows = staged(join.shared_keys(), "ngram-keys")
    near = join.neighbour_links(rows, summaries)
    links = near.unionByName(join.tile_links(rows, components(near), summaries))
    discard(rows)
    labels = components(links).withColumnRenamed("node", "cls")
    labelled = summaries.select("row", "id", "n", "cls").join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("first")
    joined = labelled.join(labelled.where("n > 0").groupBy("label").agg(first), "label", "left")
    full = F.col("n") > 0
    component = F.when(full, F.col("first.id")).otherwise(F.col("id"))
    return joined.select(
        "row", F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), F.when(full, F.col("first.row")).alias("keeper")
    )


def one_of_each(df: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` that stay when one document of each component does: the one with the smallest id.

    Of repeated rows one stays; rows with empty sets all stay.
    """
    found = shingle_components(df, size, percent, id_column, text_column)
    stays = found.where((F.col("n_shingles") == 0) | (F.col("row") == F.col("keeper")))
    stays = stays.groupBy("row").agg(F.first("n_shingles").alias("n"))
    row, _ = _keyed(df, id_column, text_column)
    joined = df.select(row, F.struct(*(df[c] for c in df.columns)).alias("own")).join(stays, "row")
    # Repeated rows of one key are copies of each other; only their other columns can differ.
    once = joined.where("n > 0").groupBy("row").agg(F.first("own").alias("own"))
    kept = once.select("own").unionByName(joined.where("n = 0").select("own"))
    return kept.select(*(F.col("own").getField(c).alias(c) for c in df.columns))
