"""Summary statistics of whole tables, columns and groups."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.numbers import mean_of, percent
from lakemill.operators.dedupe import named
from lakemill.operators.ordered import attach
from lakemill.operators.quantiles import column_quantiles, exact_quantiles, medians, unpivoted
from lakemill.operators.rows import beside
from lakemill.session import settle


QUARTILES = (0.25, 0.5, 0.75)


def group_summary(df: DataFrame, keys: Sequence[str], value: str, count: str = "rows") -> DataFrame:
    """Count, total, mean, minimum and maximum of a decimal column for each group."""
    c = F.col(f"`{value}`")
    summed = df.groupBy(*named(keys)).agg(
        F.count(F.lit(1)).alias(count),
        F.sum(c).alias("total"),
        F.count(c).alias("_valued"),
        F.min(c).alias("minimum"),
        F.max(c).alias("maximum"),
    )
    return summed.withColumn("mean", mean_of(F.col("total"), F.col("_valued"))).drop("_valued")


def null_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with nulls, worst first: `column_name, missing_count, missing_percent`."""
    counts = _per_column(df, columns or df.columns, lambda c: F.count_if(c.isNull()), "missing_count")
    found = counts.filter(F.col("missing_count") > 0)
    share = percent(F.col("missing_count"), F.col("row_count"))
    return found.select("column_name", "missing_count", share.alias("missing_percent")).orderBy(
        F.desc("missing_count"), "column_name"
    )


def null_cells(df: DataFrame) -> DataFrame:
    counts = _per_column(df, df.columns, lambda c: F.count_if(c.isNull()), "missing_count")
    return counts.agg(F.sum("missing_count").alias("missing_cells"))


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact number of distinct non-null values of every column.

    One narrow scan per column: each column is combined in its own type before its shuffle,
    and no task holds the values of a whole column.
    """
    out = None
    for c in df.columns:
        row = df.agg(F.lit(c).alias("column_name"), F.countDistinct(F.col(f"`{c}`")).alias("distinct_values"))
        out = row if out is None else out.unionByName(row)
    return out


def _per_column(df: DataFrame, columns: Sequence[str], measure, name: str) -> DataFrame:
    """One pass over the rows, then one row per column."""
    measured = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[measure(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias(name)) for i, c in enumerate(columns)
    ])
    return measured.select("row_count", F.explode(pairs).alias("m")).select("row_count", "m.*")


def describe_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each column."""
    base = unpivoted(df, columns).groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    points = column_quantiles(df, columns, QUARTILES, name="q")
    return base.join(F.broadcast(points), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max",
    )


def describe_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct count, most frequent value and its frequency of each column."""
    kinds = unpivoted(df, columns, "string").filter("value is not null").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("freq")
    )
    # The smallest value wins a tie: larger frequency first, then order of the value.
    first = F.min(F.struct((-F.col("freq")).alias("less"), F.col("value").alias("top")))
    found = kinds.groupBy("column_name").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"), first.alias("best")
    )
    return found.select("column_name", "count", "unique", F.col("best.top").alias("top"), (-F.col("best.less")).alias("freq"))


def value_counts(df: DataFrame, column: str, count: str = "count") -> DataFrame:
    """Rows per value, most frequent first, then by value; null is left out."""
    c = F.col(f"`{column}`")
    return df.filter(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(count)).orderBy(F.desc(count), column)


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    return value_counts(df, column, "_n").limit(n).select(column)


def with_top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose value is one of the `n` most frequent; at most `n` values are broadcast."""
    return df.join(F.broadcast(top_values(df, column, n)), column, "left_semi")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form, each pair over the rows where both are present."""
    pairs = [(a, a) for a in columns] + list(combinations(columns, 2))
    cols = {c: F.col(f"`{c}`").cast("double") for c in columns}
    found = df.agg(*[F.corr(cols[a], cols[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"r{i}").alias("correlation")))
    return found.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def histogram(df: DataFrame, value: Column, bins: int, upper: float | None = None) -> DataFrame:
    """Rows per equal-width bin from the smallest to the largest value, empty bins included."""
    v = value.cast("double") if upper is None else F.least(value.cast("double"), F.lit(float(upper)))
    values = df.select(v.alias("v")).filter("v is not null")
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ends = counts.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    place = F.floor(F.try_divide((F.col("v") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))) + 1
    spot = F.least(F.coalesce(place, F.lit(1)), F.lit(bins)).cast("bigint")
    filled = beside(counts, ends).groupBy(spot.alias("bin")).agg(F.sum("n").alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    frame = ends.select("lo", "hi", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))).alias("bin"))
    return frame.join(F.broadcast(filled), "bin", "left").select(
        "bin",
        (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_start"),
        (F.col("lo") + width * F.col("bin")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("row_count"),
    )


def box_statistics(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges, and the rows beyond them."""
    points = exact_quantiles(df, [group], value, QUARTILES, "q").select(
        group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    levels = df.filter(F.col(value).isNotNull()).groupBy(group, F.col(value).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    return levels.join(points, group).groupBy(group).agg(
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("v"))).alias("high_whisker"),
        F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"),
    )


def share_of_rows(df: DataFrame, key: str, count: str = "row_count") -> DataFrame:
    """Rows per value and their percentage of all rows."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    total = counted.agg(F.sum(count).alias("_total"))
    return beside(counted, total).withColumn(
        "share_percent", percent(F.col(count), F.col("_total"))
    ).drop("_total")


def group_medians_on_rows(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Writes the median of the row's group beside the row; a null key gets null."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    found = medians(df.filter(F.col(key).isNotNull()), [key], value, name)
    lookup = sizes.join(found, sizes[key].eqNullSafe(found[key]), "left").select(sizes[key], "_rows", name)
    return attach(df, settle(lookup, "medians"), [key], "_rows")
