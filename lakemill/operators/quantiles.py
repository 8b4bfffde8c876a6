"""Exact quantiles, medians and the operators made from them.

A large group is reduced to its distinct values and their counts. Where these still exceed what
one task should hold, they are sorted into slices, and only the slices with the wanted ranks are
read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.operators import ordered
from lakemill.operators.dedupe import named
from lakemill.operators.ordered import SLICE, cut_slices
from lakemill.session import settle


COUNT = "_count"


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    name: str = "quantiles",
    *,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per group with an array of interpolated quantiles of the non-null values."""
    limit = ordered.HOT_ROWS if hot_rows is None else hot_rows
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    values = df.select(*named(group), F.col(f"`{value}`").cast("double").alias("_value")).filter("_value is not null")
    split = ordered.split_groups(values, group, limit)
    parts = []
    if split.cold is not None:
        parts.append(split.cold.groupBy(*named(group)).agg(F.percentile("_value", points).alias(name)))
    if split.hot is not None:
        levels = settle(split.hot.groupBy(*named(group), "_value").agg(F.count(F.lit(1)).alias(COUNT)), "levels")
        kinds = ordered.split_groups(levels, group, limit)
        if kinds.cold is not None:
            weighted = F.percentile("_value", points, F.col(COUNT))
            parts.append(kinds.cold.groupBy(*named(group)).agg(weighted.alias(name)))
        if kinds.hot is not None:
            parts.append(_sliced_quantiles(kinds.hot, group, probabilities, name, limit, kinds.hot_rows))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: The finest rank error that the sketch is asked for.
LEAST_ERROR = 1e-6


def approximate_quantiles(
    df: DataFrame, group: Sequence[str], value: str, probabilities: Sequence[float], error: float = 0.01, name: str = "quantiles"
) -> DataFrame:
    """One row per group with an array of values that occur, by sketches that tasks make and merge.

    The rank of a value is off by no more than `error` times the group's size. Groups without a
    value are left out. A hot group is as many sketches as there are tasks, and one merged.
    """
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    sketch = F.percentile_approx(F.col(f"`{value}`"), points, F.lit(int(1 / max(error, LEAST_ERROR))))
    return df.groupBy(*named(group)).agg(sketch.alias(name)).filter(F.col(name).isNotNull())


def _sliced_quantiles(levels, group, probabilities, name, limit, rows):
    """Sorts the values into slices, finds the slices that hold the wanted ranks, reads only these."""
    keys = named(group)
    sliced = cut_slices(levels, group, ["_value"], max(2, -(-rows // limit)))
    ahead = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # One row for each slice and hot group.
    segments = sliced.groupBy(SLICE, *keys).agg(F.sum(COUNT).alias("_n")).withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(ahead), F.lit(0)),
            "_size": F.sum("_n").over(Window.partitionBy(*keys)),
        }
    )
    targets = []
    for i, p in enumerate(probabilities):
        place = F.lit(float(p)) * (F.col("_size") - 1)
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            targets.append(F.struct(F.lit(f"{side}_{i}").alias("_target"), rank.cast("bigint").alias("_rank")))
    wanted = (
        segments.withColumn("_t", F.explode(F.array(*targets)))
        .select(*keys, SLICE, "_n", "_before", "_size", "_t._target", "_t._rank")
        .filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
    )
    hits = sliced.join(F.broadcast(wanted.withColumnsRenamed({g: f"_key_{i}" for i, g in enumerate(group)} | {SLICE: "_at"})), _matches(group))
    local = Window.partitionBy(SLICE, *keys, "_target").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    reached = hits.withColumn("_to", F.col("_before") + F.sum(COUNT).over(local))
    found = reached.filter((F.col("_to") > F.col("_rank")) & (F.col("_to") - F.col(COUNT) <= F.col("_rank")))
    picked = found.groupBy(*keys).agg(
        F.max("_size").alias("_size"),
        *[F.max(F.when(F.col("_target") == x, F.col("_value"))).alias(x) for i in range(len(probabilities)) for x in (f"low_{i}", f"high_{i}")],
    )
    values = []
    for i, p in enumerate(probabilities):
        place = F.lit(float(p)) * (F.col("_size") - 1)
        part = place - F.floor(place)
        values.append(F.col(f"low_{i}") * (1 - part) + F.col(f"high_{i}") * part)
    return picked.select(*keys, F.array(*values).alias(name))


def _matches(group):
    condition = F.col(SLICE) == F.col("_at")
    for i, g in enumerate(group):
        condition = condition & F.col(f"`{g}`").eqNullSafe(F.col(f"_key_{i}"))
    return condition


def medians(df: DataFrame, group: Sequence[str], value: str, name: str = "median", **options) -> DataFrame:
    found = exact_quantiles(df, group, value, [0.5], "_q", **options)
    return found.withColumn(name, F.col("_q")[0]).drop("_q")


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], **options
) -> DataFrame:
    """`column_name, quantiles` for several numeric columns in one pass."""
    long = unpivoted(df, columns)
    return exact_quantiles(long, ["column_name"], "value", probabilities, **options)


def unpivoted(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """One row per cell: `column_name, value`."""
    return df.unpivot([], [F.col(f"`{c}`").cast(kind).alias(c) for c in columns], "column_name", "value")
