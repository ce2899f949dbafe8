from __future__ import annotations

from collections import Counter
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tagwright.operators import spread
from tagwright.operators.ordering import order_rows, with_running_totals
from tagwright.operators.spread import find_hot_keys, spread_join
from tests.star import as_dicts, in_order


def skewed(spark):
    left = [(i, "hot" if i % 3 == 0 else f"k{i % 40}") for i in range(600)]
    left += [(1000 + i, None) for i in range(50)]
    right = [("hot", "x"), ("hot", "y"), ("k1", "z"), ("k2", None), (None, "n"), ("other", "o")]
    return (
        spark.createDataFrame(left, "id long, key string"),
        spark.createDataFrame(right, "key string, value string"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_the_plain_join(spark, how):
    left, right = skewed(spark)
    hot = find_hot_keys(left, ["key"], rows_per_slot=30)
    assert {r["key"]: r["_slots"] for r in hot["key"].collect()}["hot"] == 7
    got = spread_join(left, right, ["key"], how, hot=hot, spread_by=["id"])
    want = left.join(right, ["key"], how)
    assert got.columns == want.columns
    assert in_order(as_dicts(got)) == in_order(as_dicts(want))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_on_two_columns(spark, how):
    left, right = skewed(spark)
    left = left.withColumn("part", F.col("id") % 4)
    right = right.withColumn("part", F.lit(0).cast("long"))
    hot = find_hot_keys(left, ["key"], rows_per_slot=30)
    got = spread_join(left, right, ["key", "part"], how, hot=hot, spread_by=["id"])
    want = left.join(right, ["key", "part"], how)
    assert in_order(as_dicts(got)) == in_order(as_dicts(want))


def test_hot_rows_are_spread_evenly(spark):
    left, _ = skewed(spark)
    hot = find_hot_keys(left, ["key"], rows_per_slot=30)
    slots = (
        left.join(hot["key"], "key", "left")
        .withColumn("slot", spread._left_slot("key", ["id"]))
        .collect()
    )
    per_slot = Counter((r["key"], r["slot"]) for r in slots)
    assert max(per_slot.values()) <= 60  # 200 hot rows over 7 slots
    assert len([k for k in per_slot if k[0] == "hot"]) == 7


def test_unknown_join_type(spark):
    left, right = skewed(spark)
    with pytest.raises(ValueError):
        spread_join(left, right, ["key"], "full", hot={}, spread_by=["id"])


def test_columns_without_hot_values_have_no_entry(spark):
    same = spark.range(100).select(F.lit("hot").alias("key"), "id")
    assert set(find_hot_keys(same, ["key", "id"], rows_per_slot=1)) == {"key"}
    assert find_hot_keys(same, ["key", "id"], rows_per_slot=100) == {}


def test_hot_keys_come_from_a_sketch(spark, monkeypatch):
    """A third of the rows on one value, far more values than the sketch keeps."""
    monkeypatch.setattr(spread, "TRACKED", 1024)
    monkeypatch.setattr(spread, "REPORTED", 100)
    rows = spark.range(0, 90_000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"),
        F.when(F.col("id") % 2 == 0, F.lit(b"\x00\xff")).otherwise(F.encode(F.col("id").cast("string"), "utf-8")).alias("raw"),
        F.lit(None).cast("string").alias("none"),
    )
    hot = find_hot_keys(rows, ["key", "raw", "none"], rows_per_slot=10_000)
    assert set(hot) == {"key", "raw"}
    (key,), (raw,) = hot["key"].collect(), hot["raw"].collect()
    assert key["key"] == -1 and key["_slots"] in (3, 4)
    assert bytes(raw["raw"]) == b"\x00\xff" and raw["_slots"] in (5, 6)
    assert find_hot_keys(rows.limit(0), ["key", "none"], 1) == {}


@pytest.fixture()
def many_partitions(spark):
    """Small test tables would be coalesced into one range partition."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_positions_follow_the_order(spark, many_partitions):
    ids = [(i * 7919) % 5003 for i in range(5003)]
    df = spark.createDataFrame([(i, str(i)) for i in ids], "id long, text string")
    ordered = order_rows(df.repartition(7), ["id"])
    assert ordered.total == 5003 and len(ordered.parts) > 1
    got = {r["id"]: r["position"] for r in ordered.with_position().collect()}
    assert got == {i: i for i in range(5003)}
    assert ordered.rows.columns == ["id", "text"]


def test_batches_and_pages(spark, many_partitions):
    df = spark.range(0, 1000).select((F.col("id") * 2).alias("id"))
    ordered = order_rows(df, ["id"])
    sizes = Counter(r["batch_id"] for r in ordered.with_batch(300).collect())
    assert sizes == {0: 300, 1: 300, 2: 300, 3: 100}
    assert ordered.batch_count(300) == 4
    for limit, offset in [(10, 0), (10, 95), (1000, 0), (5, 998), (5, 1000), (300, 450)]:
        got = [r["id"] for r in ordered.page(limit, offset).collect()]
        assert got == [2 * i for i in range(offset, min(offset + limit, 1000))]


def test_batches_resumed_from_an_offset_keep_their_numbers(spark, many_partitions):
    ordered = order_rows(spark.range(0, 1000), ["id"])
    whole = {r["id"]: r["batch_id"] for r in ordered.with_batch(100).collect()}
    rest = {r["id"]: r["batch_id"] for r in ordered.with_batch(100, start_offset=300).collect()}
    assert rest == {i: b for i, b in whole.items() if i >= 300}


def test_text_ids_and_ties(spark, many_partitions):
    rows = [("b", 2), ("a", 1), ("b", 1), ("c", None), ("c", 0), ("a", 0)]
    ordered = order_rows(spark.createDataFrame(rows, "id string, tie int"), ["id", "tie"])
    got = [(r["id"], r["tie"]) for r in ordered.page(10).collect()]
    assert got == [("a", 0), ("a", 1), ("b", 1), ("b", 2), ("c", 0), ("c", None)]


def test_no_rows(spark):
    ordered = order_rows(spark.range(0), ["id"])
    assert ordered.total == 0 and ordered.parts == ()
    assert ordered.page(5).collect() == []
    assert ordered.with_batch(5).collect() == []


def test_pages_across_partitions(spark, many_partitions):
    ordered = order_rows(spark.range(0, 1000), ["id"])
    assert len(ordered.parts) > 2
    for limit, offset in [(1, 0), (600, 200), (1000, 0), (7, 993), (50, 990)]:
        got = [r["id"] for r in ordered.page(limit, offset).collect()]
        assert got == list(range(offset, min(offset + limit, 1000)))


@pytest.mark.parametrize("group_size", [1, 3, 1000])
def test_running_totals_across_groups(spark, group_size):
    values = [(i, (i * 37) % 11, 1) for i in range(50)]
    df = spark.createDataFrame(values, "batch_id long, a long, b long")
    totals = with_running_totals(df, "batch_id", {"sum_a": "a", "sum_b": "b"}, group_size)
    got = [(r["sum_a"], r["sum_b"]) for r in totals.orderBy("batch_id").collect()]
    want = list(zip(accumulate(v[1] for v in values), accumulate(v[2] for v in values)))
    assert got == want


def test_ordered_table_is_a_written_table(spark):
    ordered = order_rows(spark.range(10), ["id"])
    plan = ordered.page(3, 2)._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan and "PushedFilters: [IsNotNull(_slot)" in plan
    assert ordered.stored.count() == 10
