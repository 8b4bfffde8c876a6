"""Catalog tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.text import is_true_text


def publish(df: DataFrame, table: str, flags: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Saves a frame as a table to query by name; text flags become booleans again."""
    typed = df.withColumns({c: is_true_text(F.col(c)) for c in flags if c in df.columns}) if flags else df
    writer = typed.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def publish_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def replace_table(spark: SparkSession, table: str, query: str, path: str | None = None) -> DataFrame:
    """Creates or replaces a table from a query."""
    return publish(spark.sql(query), table, path=path)
