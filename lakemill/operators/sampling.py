"""Ends and samples of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.operators.ordered import sort_columns


def top(df: DataFrame, order: Sequence[str], n: int, place: str | None = None) -> DataFrame:
    """First `n` rows by `order`; `place` numbers them (at most `n` rows in one task)."""
    few = df.orderBy(*sort_columns(order)).limit(n)
    if place is None:
        return few
    return few.withColumn(place, F.row_number().over(Window.orderBy(*sort_columns(order))).cast("bigint"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """`n` rows by the hash of their key and a seed: random, and the same on every run."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return top(df.withColumn("draw", draw), ["draw", key], n, "place")
