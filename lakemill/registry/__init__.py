"""Every operator and job over the given tables, with the SQL that gives the same rows.

Keys are the inventory numbers. Columns are reduced to plain types: money as double, dates and
times as ISO text, whole numbers as bigint.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.session import fresh_folder, tune

SECTIONS = (
    "sources",
    "projection",
    "joins",
    "aggregates",
    "windows",
    "ordering",
    "scalars",
    "cleaning",
    "versions",
    "shop",
    "sales",
    "catalogue",
    "marts",
    "streams",
)


class Tables:
    """The given tables of one folder, read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, label: str) -> str:
        return fresh_folder(self.spark, label)


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def entry(name: str, sql: str | None = None):
    def add(build):
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(name, build, sql)
        return build

    return add


def plain(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(field.name))
    return df.select(*out)


def load() -> dict[str, Entry]:
    for section in SECTIONS:
        import_module(f"lakemill.registry.{section}")
    return ENTRIES


def runner(item: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(item.build(Tables(tune(spark), folder)))

    return run
