"""Hot keys and piles of copies: results stay whole and no group is gathered."""

from collections import Counter

from pyspark.sql import functions as F

from waybill.operators import aggregates, bags, locations


def test_truck_text_divides_a_busy_truck(spark):
    """One truck has 90 % of the entries, half of those one id."""
    n = 8000
    k = F.col("id")
    activity = spark.range(0, n, 1, 12).select(
        F.when(k % 10 < 9, 0).otherwise(k % 7 + 1).cast("int").alias("truck_id"),
        F.when((k % 10 < 9) & (k % 2 == 0), "SAME").otherwise(F.concat(F.lit("P"), k)).alias("package_id"),
    )
    expected = Counter(f"{r.truck_id}: {r.package_id}" for r in activity.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        text = aggregates.packages_per_truck_text(activity)
        placed = text.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    keys = [(int(t), p) for t, p in (r.line.split(": ") for r in placed)]
    assert keys == sorted(keys)
    assert Counter(r.line for r in placed) == expected
    assert max(Counter(r.task for r in placed).values()) < n // 2
    assert len({r.task for r in placed if r.line == "0: SAME"}) > 1


def test_report_text_divides_a_busy_location(spark):
    """A third and more of all rows are copies of one event, spread over input tasks."""
    n = 9000
    activity = spark.range(0, n, 1, 12).select(
        F.lit(True).alias("is_arrival"),
        F.when(F.col("id") % 10 < 9, "HOT").otherwise(F.concat(F.lit("L"), F.col("id") % 7)).alias("location"),
        F.timestamp_seconds(F.when(F.col("id") % 10 < 5, 0).otherwise(F.col("id"))).alias("event_time"),
        F.lit(1).alias("truck_id"),
        F.when(F.col("id") % 10 < 5, "SAME").otherwise(F.concat(F.lit("P"), F.col("id"))).alias("package_id"),
    )
    calls = spark.createDataFrame([("HOT", 1)], "location string, call_epoch long")
    names = spark.createDataFrame([("HOT", "Heat")], "location string, name string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        text = locations.location_report_text(locations.location_report_lines(activity, calls, names))
        placed = text.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    lines = [r.line for r in placed]
    start, end = lines.index("HOT**********"), lines.index("End HOT******")
    assert lines[start + 1 : start + 3] == ["Location: Heat", "Total # Support Calls: 1"]
    block = Counter(lines[start + 3 : end])
    assert block["Arrived: SAME"] == n // 2
    assert sum(block.values()) == n * 9 // 10
    sizes = Counter(r.task for r in placed)
    assert max(sizes.values()) < n // 2  # less than the copies alone
    copies = {r.task for r in placed if r.line == "Arrived: SAME"}
    assert len(copies) > 1


def test_keys_of_any_kind_survive_the_join(spark):
    activity = spark.createDataFrame(
        [(True, "", 1, "P"), (False, None, 1, "P"), (True, "A", 1, "P")],
        "is_arrival boolean, location string, truck_id int, package_id string",
    )
    calls = spark.createDataFrame([("", 1), ("B", 2)], "location string, call_epoch long")
    rows = locations.location_activity_with_calls(activity, calls).collect()
    assert {tuple(r) for r in rows} == {("", 1, 1, 1), (None, 1, 0, 0), ("A", 1, 1, 0), ("B", 0, 0, 1)}


def test_bags_divide_a_busy_key_and_carry_their_numbers(spark):
    """One key has nine tenths of both sides, half of it copies of one row; another key is NULL."""
    n = 6000
    key = F.when(F.col("id") % 10 < 9, "HOT").when(F.col("id") % 20 == 9, None).otherwise(F.concat(F.lit("K"), F.col("id") % 3))
    left = spark.range(0, n, 1, 12).select(key.alias("k"), F.when(F.col("id") % 2 == 0, 500).otherwise(F.col("id") % 1000).alias("at"), F.lit("x").alias("tie"))
    right = spark.range(0, n // 2, 1, 12).select(key.alias("k"), (F.col("id") % 1000).alias("then"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = bags.ordered_bags(left, right, "k", {"left": "at", "right": "then"}, ["tie"])
        busy = found.where("k = 'HOT'").withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(busy) > 2 and max(r["count"] for r in busy) < n // 2
    ours, theirs = left.collect(), right.collect()
    assert len(rows) == len(ours) + len(theirs)
    for k in {r.k for r in ours}:
        own = [r for r in rows if r.k == k and r.left is not None]
        assert sorted(r.left_number for r in own) == list(range(1, len(own) + 1))
        assert [r.left["at"] for r in sorted(own, key=lambda r: r.left_number)] == sorted(r["at"] for r in ours if r.k == k)
        calls = sorted(r.then for r in theirs if r.k == k)
        assert all(r.right_number == sum(c <= r.left["at"] for c in calls) for r in own[:200])


def test_bags_of_one_side_or_none(spark):
    left = spark.createDataFrame([("A", 2), ("A", 1)], "k string, at long")
    right = spark.createDataFrame([("B", 5)], "k string, then long")
    order = {"left": "at", "right": "then"}
    rows = {(r.k, r.left and r.left["at"], r.right and r.right["then"], r.left_number, r.right_number) for r in bags.ordered_bags(left, right, "k", order).collect()}
    assert rows == {("A", 1, None, 1, 0), ("A", 2, None, 2, 0), ("B", None, 5, 0, 1)}
    assert bags.ordered_bags(left.limit(0), right.limit(0), "k", order).count() == 0
    same = bags.ordered_bags(left, right.select(F.lit("A").alias("k"), F.lit(1).cast("long").alias("then")), "k", order, right_first=False)
    assert {(r.left["at"], r.right_number) for r in same.collect() if r.left} == {(1, 0), (2, 1)}
