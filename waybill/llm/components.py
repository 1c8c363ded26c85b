"""Connected components of a link table, on Spark, without any list of links in one place."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, staged


def roots(pairs: list[tuple[int, int]]) -> dict[int, int]:
    """Smallest member of the group of each node that occurs in the pairs."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        above.setdefault(x, x)
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        if x != y:
            above[max(x, y)] = min(x, y)
    return {x: top(x) for x in above}


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for the nodes of ``links`` (columns a, b).

    Each task first joins what is linked within its batches; then large-star and
    small-star rounds repeat until nothing changes, about the logarithm of the
    number of nodes at most. Each round is written to shared storage.
    """

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = roots(list(zip(column(batch, "a").to_pylist(), column(batch, "b").to_pylist(), strict=True)))
            ends = [(x, r) for x, r in found.items() if x != r]
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in ends], pa.int64()) for k in (0, 1)], names=["u", "v"])

    edges = staged(links.select("a", "b").mapInArrow(contract, "u long, v long").distinct(), "components")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before = tuple(mark)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
