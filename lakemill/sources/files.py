"""Files: typed and untyped CSV, Parquet, listings, checked copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.session import freed
from lakemill.sources import records

#: Quotes are doubled within quoted text; blanks stay.
CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
#: An empty text is quoted and a null is not. The reader takes a field without anything for its
#: null value, which has to differ from the empty text.
READ = {**CSV, "nullValue": "\0", "emptyValue": ""}
WRITE = {**CSV, "nullValue": "", "emptyValue": '""'}


MALFORMED = "_malformed"


def csv_rows(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, multi_line: bool = True
) -> DataFrame:
    """Typed rows of CSV files with their lineage (`records.LINEAGE`) and the text of malformed records.

    Quoted text may hold line breaks. Every file is read by as many tasks as it has splits; where
    quotes do not stand around whole fields, by one task. `multi_line=False` takes every line for a
    record, without a look at the quotes. Values go by the header's names, in any order; a header
    with other names is refused. `MALFORMED` is null but for records with another number of values
    than their header has names, or with values that are not of their column's type.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if multi_line:
        found = records.read_records(spark, path)
        if found is not None:
            return records.parsed(found, {f.name: f.dataType.simpleString() for f in schema.fields}, READ, MALFORMED)
    full = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    reader = spark.read.schema(full).options(**READ, multiLine=multi_line, enforceSchema=False, columnNameOfCorruptRecord=MALFORMED)
    return reader.csv(path).select(
        "*",
        F.col("_metadata.file_path").alias(records.FILE),
        F.col("_metadata.file_name").alias(records.NAME),
        F.col("_metadata.file_block_start").alias(records.SPLIT),
        F.monotonically_increasing_id().alias(records.PLACE),
    )


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, multi_line: bool = True
) -> DataFrame:
    """Typed rows of CSV files, see `csv_rows`; what a malformed record lacks is null."""
    return csv_rows(spark, path, schema, multi_line).drop(MALFORMED, *records.LINEAGE)


#: Texts that stand for a value of the type, and the type itself, the narrowest first.
INFERRED = {
    "int": r"[+-]?\d{1,10}",
    "bigint": r"[+-]?\d{1,19}",
    "double": r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|NaN|[+-]?Inf",
    "date": r"\d{4}-\d{2}-\d{2}",
    "timestamp": r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?",
    "boolean": r"(?i)true|false",
}


def inferred_schema(texts: DataFrame) -> T.StructType:
    """For each column of text the first type that all its values have, text if there is none or no value."""
    tests = []
    for k, c in enumerate(texts.columns):
        value = F.col(f"`{c}`")
        tests.append(F.count(value).alias(f"n{k}"))
        for name, pattern in INFERRED.items():
            fits = value.rlike(f"^({pattern})$") & value.try_cast(name).isNotNull()
            tests.append(F.count_if(value.isNotNull() & ~fits).alias(f"{name}{k}"))
    found = texts.agg(*tests).first()
    types = [next((t for t in INFERRED if found[f"n{k}"] and not found[f"{t}{k}"]), "string") for k in range(len(texts.columns))]
    return T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in zip(texts.columns, types)))


def read_csv_inferred(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Guesses types by a pass over all rows: for exploration only."""
    texts = read_csv_text(spark, path, multi_line)
    schema = inferred_schema(texts)
    return texts.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def header_columns(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Column names from the header line, without those of partition folders; no data row is read."""
    folders = spark.read.text(path).columns[1:]
    return [c for c in spark.read.options(**READ).csv(path).columns if c not in folders]


def read_csv_text(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Every column as text, so that no value is changed while reading."""
    return read_csv(spark, path, text_schema(header_columns(spark, path)), multi_line)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    with freed(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def stored(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Writes Parquet and reads it back with the types it was written with."""
    write_parquet(df, path, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Files of a codec that cannot be split, such as gzip, are read by one task each."""
    with freed(df.sparkSession):
        df.write.mode("overwrite").options(**WRITE, compression=compression).csv(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name, size and time of the files below a folder; contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return found.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "path",
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("last_modified"),
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def child_paths(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Paths in a folder whose names end with `suffix`, by name."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    found = [status.getPath() for status in system.listStatus(target)]
    return [p.toString() for p in sorted(found, key=lambda p: p.getName()) if p.getName().endswith(suffix)]


def fingerprint(df: DataFrame) -> list[Column]:
    """Row count and an order-free sum of row hashes, as aggregates."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("row_count"), F.sum(row_hash).alias("hash_sum")]


def copy_checked(df: DataFrame, path: str) -> DataFrame:
    """Copies a dataset and compares what was read, measured on the way, with what was written."""
    seen = Observation("copied")
    written = stored(df.observe(seen, *fingerprint(df)), path)
    read, total = seen.get["row_count"], seen.get["hash_sum"]
    same = (F.col("row_count") == read) & F.col("hash_sum").eqNullSafe(F.lit(total))
    return written.agg(*fingerprint(df)).select(
        F.lit(read).alias("rows_read"), F.col("row_count").alias("rows_written"), same.alias("verified")
    )
