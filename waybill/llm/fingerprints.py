"""Document fingerprints: invertible Bloom lookup sketches of paragraphs, in DataFrame functions only.

A text is a list of short paragraphs: its lines, cut after every 100 characters. A
paragraph's digest is 64 bits. A sketch has cells; each digest goes into one cell
of each of three parts, where the cell keeps a count, the XOR of the digests and
the XOR of their checks. Cells of two sketches subtract; what they have in common
is gone. A cell of one digest with a fitting check then gives it away, and taking
it out of its other cells frees more (peeling). When all cells are empty, the
digests on either side are known and the likeness is the share of common ones:
``common / (common + differing)``. If peeling stops early the pair is sketched
again with more cells; beyond ``CELLS`` the digests themselves are compared.

To keep sketches small at any length, digests are dealt into sub-sketches of
about four digests a side, one row each, which peel by themselves and together
take time in proportion to the text; both sides of a pair have the same number.
Subtracting cell by cell is the same as entering one side's digests with a minus
sign, and that is how a pair's cells are filled.

The fingerprint in the output is the SHA-256 of a small sketch of the text alone:
equal paragraph sets give equal fingerprints, so equal texts do. Paragraphs count
once each; how often one repeats does not matter.

Defined results: a null text counts as empty; an empty text has no paragraphs and
two such texts have likeness 1. The neighbour of a row is the next one in
descending order of id, then text, nulls last; after the last row comes the first.
A single row is its own neighbour; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

#: Characters of a paragraph at most.
WIDTH = 100
PER_SKETCH = 4
#: Cells per part of a sub-sketch, one attempt after the other.
CELLS = (8, 24)
#: Cells per part of the sketch that the fingerprint is made of.
OWN_CELLS = 4
_SALTS = (11, 23, 47)
#: Rows of a range of the order, and the most ranges.
RANGE_ROWS, MOST_RANGES = 4_000, 10_000
_ITEM = "struct<d: bigint, n: int, k: bigint, x: int, y: int, z: int>"


def paragraphs(text: Column) -> Column:
    """Sorted distinct digests of the lines of a text, cut after every ``WIDTH`` characters; blank pieces do not count."""

    def pieces(line: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(line)), F.lit(WIDTH))
        return F.when(F.length(line) <= WIDTH, F.array(line)).otherwise(F.transform(places, lambda at: F.substring(line, at, F.lit(WIDTH))))

    lines = F.flatten(F.transform(F.split(text, "\n"), pieces))
    full = F.filter(lines, lambda piece: F.trim(piece) != "")
    return F.array_sort(F.array_distinct(F.transform(full, lambda piece: F.xxhash64(piece))))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(101))


def _item(digest: Column, n: Column, cells: int) -> Column:
    """A digest with its sign, its check and its cell in each of the three parts."""
    spot = lambda part: (F.pmod(F.xxhash64(digest, F.lit(_SALTS[part])), F.lit(cells)) + part * cells).cast("int")
    return F.struct(digest.alias("d"), n.alias("n"), _check(digest).alias("k"), spot(0).alias("x"), spot(1).alias("y"), spot(2).alias("z"))


def _into(items: Column, at: Column) -> Column:
    return F.filter(items, lambda i: (i["x"] == at) | (i["y"] == at) | (i["z"] == at))


def cells_of(signed: Column, cells: int) -> Column:
    """Cells of digests with signs (structs of d and n): sum of signs, XOR of digests, XOR of checks."""
    items = F.transform(signed, lambda s: _item(s["d"], s["n"], cells))

    def cell(at: Column, items: Column) -> Column:
        return F.aggregate(
            _into(items, at),
            F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check")),
            lambda c, i: F.struct((c["n"] + i["n"]).alias("n"), c["key"].bitwiseXOR(i["d"]).alias("key"), c["check"].bitwiseXOR(i["k"]).alias("check")),
        )

    places = F.sequence(F.lit(0), F.lit(3 * cells - 1))
    return F.transform(F.array(items), lambda items: F.transform(places, lambda at: cell(at, items)))[0]


def peel(cells: Column, per_part: int, rounds: int = 8) -> Column:
    """``out``, the digests recovered from the cells of a difference, and ``clear``, whether that is all of them.

    A round takes out what single cells hold. Of a sub-sketch that is not too
    full two or three rounds are left; the others go to a larger sketch.
    """
    nothing = F.array().cast(f"array<{_ITEM}>")

    def pure(table: Column) -> Column:
        alone = F.filter(table, lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"])))
        return F.array_distinct(F.transform(alone, lambda c: _item(c["key"], c["n"], per_part)))

    def without(table: Column, found: Column) -> Column:
        def cell(c: Column, at: Column) -> Column:
            return F.aggregate(
                _into(found, at),
                c,
                lambda c, i: F.struct((c["n"] - i["n"]).alias("n"), c["key"].bitwiseXOR(i["d"]).alias("key"), c["check"].bitwiseXOR(i["k"]).alias("check")),
            )

        return F.transform(table, cell)

    def step(state: Column, _: Column) -> Column:
        def taken(found: Column) -> Column:
            rest = F.struct(without(state["table"], found).alias("table"), F.concat(state["out"], found).alias("out"))
            return F.when(F.size(found) == 0, state).otherwise(rest)

        return F.transform(F.array(pure(state["table"])), taken)[0]

    end = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.struct(cells.alias("table"), nothing.alias("out")), step)
    clear = lambda table: ~F.exists(table, lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))
    return F.transform(F.array(end), lambda e: F.struct(e["out"].alias("out"), clear(e["table"]).alias("clear")))[0]


def differing(signed: Column) -> Column:
    """How many digests of a sub-sketch are on one side only; one that does not peel is sketched again, larger."""
    one_side = lambda sign: F.transform(F.filter(signed, lambda s: s["n"] == sign), lambda s: s["d"])
    count = F.size(F.array_except(one_side(1), one_side(-1))) + F.size(F.array_except(one_side(-1), one_side(1)))

    def attempt(cells: int, larger: Column) -> Column:
        return F.transform(F.array(peel(cells_of(signed, cells), cells)), lambda p: F.when(p["clear"], F.size(p["out"])).otherwise(larger))[0]

    for cells in reversed(CELLS):
        count = attempt(cells, count)
    return count


def fingerprint(digests: Column) -> Column:
    cells = cells_of(F.transform(digests, lambda d: F.struct(d.alias("d"), F.lit(1).alias("n"))), OWN_CELLS)
    return F.sha2(F.to_json(F.struct(cells.alias("cells"))), 256)


def likeness(pairs: DataFrame, left: str, rights: list[str]) -> DataFrame:
    """``key`` and one likeness for each column in ``rights``, which like ``left`` holds sorted digests: the common
    digests by all digests of both sides. ``key`` is unique."""
    sign = lambda name, n: F.transform(name, lambda d: F.struct(d.alias("d"), F.lit(n).alias("n")))
    kinds = F.array(
        *(
            F.struct(F.lit(k).alias("kind"), F.greatest(F.lit(1), F.ceil(F.greatest(F.size(left), F.size(right)) / PER_SKETCH)).alias("sketches"), F.concat(sign(left, 1), sign(right, -1)).alias("signed"))
            for k, right in enumerate(rights)
        )
    )
    # Dealt by key once; the groups below are within a key, so nothing moves again.
    dealt = pairs.select("key", left, *rights).repartition("key")
    rows = dealt.select("key", F.inline(kinds)).select("key", "kind", "sketches", F.explode("signed").alias("item"))
    part = F.pmod(F.shiftright("item.d", 7), F.col("sketches"))
    sketches = rows.groupBy("key", "kind", part.alias("part")).agg(F.collect_list("item").alias("signed"))
    counts = sketches.select("key", "kind", differing(F.col("signed")).alias("n"))
    sums = counts.groupBy("key").agg(*(F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(f"n_{k}") for k in range(len(rights))))

    def share(k: int, right: str) -> Column:
        total, n = F.col(f"size_{left}") + F.col(f"size_{right}"), F.coalesce(F.col(f"n_{k}"), F.lit(0))
        common = (total - n) / 2
        return F.when(total == 0, F.lit(1.0)).otherwise(common / (common + n)).alias(f"near_{right}")

    sizes = pairs.select("key", *(F.size(c).alias(f"size_{c}") for c in (left, *rights)))
    return sizes.join(sums, "key", "left").select("key", *(share(k, right) for k, right in enumerate(rights)))


def with_next(df: DataFrame) -> DataFrame:
    """``df`` (id, text, digests) with the text and digests of the row that follows in descending order.

    Rows are dealt by ranges of the id. Each range looks ahead within itself, its
    last row takes the first row of the next range that has one. What the driver
    sees is the bounds of at most ``MOST_RANGES`` ranges.
    """
    spark = df.sparkSession
    rows = df.select("id").count()
    wanted = max(1, min(MOST_RANGES, rows // RANGE_ROWS))
    # Any bounds give right results; these make the ranges about equal.
    steps = [k / wanted for k in range(1, wanted)]
    bounds = (df.agg(F.percentile_approx("id", steps, 20 * wanted)).first()[0] or []) if steps else []
    ranges = F.lit(0)
    if bounds:
        ordered = F.array(*(F.lit(b).cast("long") for b in sorted(set(bounds))))
        ranges = F.size(F.filter(ordered, lambda b: b < F.col("id").cast("long")))
    ranged = df.withColumn("range", F.when(F.col("id").isNull(), -1).otherwise(ranges))
    order = [F.desc_nulls_last("id"), F.desc("text")]
    within = Window.partitionBy("range").orderBy(*order)
    following = F.struct(F.col("text").alias("text"), F.col("digests").alias("digests"))
    ahead = ranged.withColumn("next", F.lead(following).over(within))
    heads = ranged.groupBy("range").agg(F.max_by(following, F.struct("id", "text")).alias("head"))
    present = sorted((row["range"] for row in ranged.select("range").distinct().collect()), reverse=True)
    turns = spark.createDataFrame([(a, b) for a, b in zip(present, [*present[1:], *present[:1]], strict=True)], "range int, next_range int")
    joints = heads.withColumnRenamed("range", "next_range").join(turns, "next_range").select("range", "head")
    inner = ahead.where("next IS NOT NULL").select("id", "text", "digests", "next")
    last = ahead.where("next IS NULL").join(joints, "range").select("id", "text", "digests", F.col("head").alias("next"))
    return inner.unionByName(last)


def compare_versions(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: its id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text has its last third replaced by the beginning of the next row's text.
    """
    text = F.coalesce(df[text_column], F.lit(""))
    rows = df.select(df[id_column].alias("id"), text.alias("text"), paragraphs(text).alias("digests"))
    cut = F.floor(F.length("text") / 3).cast("int")
    kept = F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) as int))")
    pairs = with_next(rows).withColumn("edited", F.concat(kept, F.substring(F.col("next.text"), F.lit(1), cut)))
    pairs = pairs.select(
        F.monotonically_increasing_id().alias("key"),
        "id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("digests").alias("own"),
        paragraphs(F.col("edited")).alias("edited"),
        F.col("next.digests").alias("next"),
    )
    # Written, so that the keys stay what they are.
    pairs = staged(pairs, "fingerprint-pairs")
    near = likeness(pairs, "own", ["edited", "next"])
    return pairs.join(near, "key").select(
        F.col("id").alias(id_column),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        F.col("near_edited").alias("near_edited"),
        F.col("near_next").alias("near_next"),
    )
