"""Repeated rows. Survivors are chosen by an explicit order, as rows have no position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.operators.ordered import attach
from lakemill.session import settle


COPIES = "_copies"


def named(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first"
) -> DataFrame:
    """The first or last row of each key by `order`, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    place = F.struct(*named(order))
    pick = F.min_by if keep == "first" else F.max_by
    chosen = df.groupBy(*named(keys)).agg(pick(F.struct(*named(rest)), place).alias("_row"))
    return chosen.select(*[F.col(f"_row.`{c}`").alias(c) if c in rest else F.col(f"`{c}`") for c in df.columns])


def copy_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows with the number of copies; nulls are equal to each other."""
    return df.groupBy(*named(columns or df.columns)).agg(F.count(F.lit(1)).alias(COPIES))


def repeated_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one."""
    extra = F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0))
    return copy_counts(df).agg(extra.alias("duplicate_rows"))


def repeated_members(df: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Every row of every group of equal rows, the first one included."""
    groups = settle(copy_counts(df).filter(F.col(COPIES) > 1), "copies")
    return attach(df, groups, df.columns, COPIES, hot_rows=hot_rows)


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def drop_business_duplicates(df: DataFrame, order: str | None = None) -> DataFrame:
    """Removes rows equal in all columns that do not start with `_`."""
    columns = business_columns(df)
    if order is None or len(columns) == len(df.columns):
        return df.dropDuplicates(columns)
    return one_per_key(df, columns, [order])
