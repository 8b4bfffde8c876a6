"""Small helpers shared by the operators on texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that reach a Python worker at once; keeps a batch of long texts within a worker's memory.
BATCH_ROWS = 512


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def fold(id_col: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; an id that is null counts as the empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def text_of(name: str) -> Column:
    """A text, the empty one for null."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def fresh(name: str, columns: list[str]) -> str:
    """`name`, lengthened until no column has it, in upper or lower case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def drawn(df: DataFrame, rows: int) -> DataFrame:
    """At most `rows` rows of `df`, those with the least hashes of all their columns.

    The same rows at any partitioning. Only rows below a hash that about twice as many pass are
    sorted, so what tasks send to the driver does not grow with their number.
    """
    found = df.agg(F.count(F.lit(1))).first()[0]
    mark = F.xxhash64(F.lit(5), *[F.col(f"`{c}`") for c in df.columns])
    below = F.pmod(mark, F.lit(1 << 31)) < int((1 << 31) * min(1.0, 2 * rows / max(found, 1) + 1e-6))
    return df.where(below).orderBy(F.pmod(mark, F.lit(1 << 31)), *[F.col(f"`{c}`") for c in df.columns]).limit(rows)


def add_columns(
    df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[], Callable[[list[str]], list[pa.Array]]]
) -> DataFrame:
    """All columns of `df` and those that Python derives from the batch's texts (null: empty).

    `make` runs once in each task and returns the function from texts to new columns. A column
    of `df` that has the name of a new one is replaced by it.
    """
    prepare(df.sparkSession)
    names = {f.name.lower() for f in fields}
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])
    source = df.select(*[F.col(f"`{c}`") for c in kept.columns], F.col(f"`{text}`").alias(fresh("text_read", kept.columns)))
    schema = T.StructType([*kept.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        derive = make()
        for b in batches:
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], *derive(texts)], names=[*b.schema.names[:-1], *[f.name for f in fields]]
            )

    return source.mapInArrow(run, schema)
