"""Operators that cut large groups into slices give what one window gives."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemill.operators.dedupe import repeated_members
from lakemill.operators.ordered import attach, end_values, ranked, scan, split_groups, tiled
from lakemill.operators.quantiles import exact_quantiles

HOT = 60
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the events belong to one group; one group is null; values tie."""
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    group = F.when(F.col("user_id") % 3 == 0, 0).when(F.col("user_id") == 5, None).otherwise(F.col("user_id"))
    return events.select(
        "event_id",
        "ts",
        "event_type",
        "value",
        group.alias("g"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
        F.round(F.col("value") / 20).alias("level"),
    )


def same(left, right):
    assert sorted(map(str, left.collect())) == sorted(map(str, right.select(*left.columns).collect()))


@pytest.mark.parametrize("group", [["g"], []])
def test_scan(rows, group):
    w = Window.partitionBy(*group).orderBy(F.col("ts").desc(), "event_id")
    expected = rows.select(
        "event_id",
        F.row_number().over(w).cast("bigint").alias("n"),
        F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
        F.lag("value").over(w).alias("before"),
        F.lead("event_type").over(w).alias("after"),
    )
    found = scan(
        rows, group, ["ts desc", "event_id"], number="n", totals={"total": "amount"},
        previous={"before": "value"}, following={"after": "event_type"}, hot_rows=HOT,
    )
    same(expected, found)


@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("dense", [False, True])
def test_ranked(rows, group, dense):
    w = Window.partitionBy(*group).orderBy(F.col("level").desc())
    function = F.dense_rank() if dense else F.rank()
    expected = rows.select("event_id", function.over(w).cast("bigint").alias("place"))
    same(expected, ranked(rows, group, ["level desc"], "place", dense=dense, hot_rows=HOT))


@pytest.mark.parametrize("group", [["g"], []])
def test_quantiles(rows, group):
    points = [0.0, 0.25, 0.5, 0.9, 1.0]
    expected = rows.groupBy(*group).agg(F.percentile("value", F.array(*[F.lit(p) for p in points])).alias("q"))
    found = exact_quantiles(rows, group, "value", points, "q", hot_rows=HOT)

    def rounded(df):
        return df.select(*group, F.transform("q", lambda x: F.round(x, 6)).alias("q"))

    same(rounded(expected), rounded(found))


@pytest.mark.parametrize("tiles", [1, 4, 7, 2000])
def test_tiled(rows, tiles):
    w = Window.orderBy(F.col("value").desc(), "event_id")
    expected = rows.select("event_id", F.ntile(tiles).over(w).cast("bigint").alias("tile"))
    same(expected, tiled(rows, ["value desc", "event_id"], tiles, "tile"))


def test_attach_keeps_null_keys_and_hot_keys(rows):
    lookup = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("most"))
    expected = rows.select("event_id", F.max("value").over(Window.partitionBy("g")).alias("most"))
    same(expected, attach(rows, lookup, ["g"], "n", hot_rows=HOT))


def test_end_values(rows):
    w = Window.partitionBy("g").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    expected = rows.select("event_id", F.first("event_type").over(w).alias("a"), F.last("event_type").over(w).alias("b"))
    same(expected, end_values(rows, ["g"], ["ts", "event_id"], first={"a": "event_type"}, last={"b": "event_type"}, hot_rows=HOT))


def test_repeated_members(rows):
    pairs = rows.select("g", "level")
    w = Window.partitionBy("g", "level")
    expected = pairs.withColumn("n", F.count(F.lit(1)).over(w)).filter("n > 1").drop("n")
    same(expected, repeated_members(pairs, hot_rows=HOT))


def test_split_keeps_every_row_once(rows):
    split = split_groups(rows, ["g"], HOT)
    assert split.hot is not None
    assert split.cold.count() + split.hot.count() == rows.count()
    assert split.hot_rows == split.hot.count()


def test_sliced_window_tasks_hold_slices_only(rows, spark):
    """No slice holds more than a few times its share of the rows."""
    from lakemill.operators.ordered import cut_slices

    sizes = cut_slices(rows, [], ["value", "event_id"], 16).groupBy("_slice").count()
    assert sizes.agg(F.max("count")).first()[0] < 4 * rows.count() / 16
