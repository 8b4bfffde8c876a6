"""Streamed layers: raw ingest, cleaning with expectations, versions from a change stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.functions import dates, numbers, text
from lakemill.functions.keys import md5_key
from lakemill.operators import audit
from lakemill.operators.buckets import KeyBuckets
from lakemill.operators.dedupe import named
from lakemill.operators.ordered import scan
from lakemill.plans.marts import billing_by
from lakemill.session import settle
from lakemill.sources import files


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    kind: str = "parquet",
    pattern: str = "*",
    files_per_batch: int | None = None,
    **options,
) -> DataFrame:
    reader = spark.readStream.format(kind).schema(schema).option("pathGlobFilter", pattern).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def with_lineage(stream: DataFrame) -> DataFrame:
    return stream.withColumns(
        {"_ingestion_timestamp": F.current_timestamp(), "_source_file": F.col("_metadata.file_name")}
    )


def delivered_once(stream: DataFrame, keys: Sequence[str], within: str = "7 days") -> DataFrame:
    """Each event once, though its file came again, in the same batch or a later one.

    Events are known by their keys for the time `within` after they came. It runs on the time of
    arrival, not of the event, so no event is dropped for being late, and the state is as large as
    what arrives in that time.
    """
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(list(keys)).drop("_arrived")


def run_to_files(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Appends all available input to Parquet files and returns what was written."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(target)


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def silver_columns(stream: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """The column rules of the batch layer: case, date, amount, key.

    The amount keeps its sign in `_raw_billing`, so that a rule can still see it.
    """
    amount = numbers.to_number(F.col("Billing Amount"))
    ready = stream.withColumns(
        {
            **{c: text.title_case(text.strip(F.col(c))) for c in ("Name", "Doctor", "Hospital")},
            "Date of Admission": dates.parse_date(text.strip(F.col("`Date of Admission`")), dates.DATE_LAYOUTS),
            "Billing Amount": F.abs(amount),
            "_raw_billing": amount,
        }
    )
    return ready.withColumn("encounter_key", md5_key(named(key_columns)))


# Rules of the streamed encounter table: rows that fail the first are dropped, the second count.
def required_rules() -> dict[str, Column]:
    return {
        "valid_name": F.col("Name").isNotNull(),
        "valid_admission_date": F.col("`Date of Admission`").isNotNull(),
    }


def watched_rules() -> dict[str, Column]:
    return {"non_negative_billing": F.col("_raw_billing") >= 0}


def run_expected(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    required: Mapping[str, Column],
    watched: Mapping[str, Column],
) -> DataFrame:
    """Writes the rows that meet the required rules, and per batch the counts of every rule.

    Each batch overwrites its own folders, so a batch that is run again leaves one result.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = settle(batch, "batch")
        kept = audit.keep_expected(rows, required)
        files.write_parquet(kept, f"{target}/rows/batch={batch_id}")
        counts = audit.expectation_counts(rows, {**required, **watched})
        files.write_parquet(counts.coalesce(1), f"{target}/counts/batch={batch_id}")

    run_batches(stream, each, checkpoint)
    spark = stream.sparkSession
    written = files.child_paths(spark, f"{target}/rows")
    if not written:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*written)


def expectation_totals(spark: SparkSession, target: str) -> DataFrame:
    written = files.child_paths(spark, f"{target}/counts")
    if not written:
        return spark.createDataFrame([], "expectation string, passed long, failed long")
    counts = spark.read.parquet(*written)
    return counts.groupBy("expectation").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def rebuild_history(
    rows: DataFrame, key: str, tracked: Sequence[str], sequence: Sequence[str], **options
) -> DataFrame:
    """Versions of each key by its sequence; the last one is current.

    A version ends where the next one starts. A row equal to the one before starts none: it is
    kept with `is_version` false, as a late change in between would make it one.
    """
    hashed = rows.withColumn("hash_diff", md5_key(named(tracked)))
    marked = scan(hashed, [key], sequence, previous={"_before": "hash_diff"}, **options)
    starts = F.col("_before").isNull() | (F.col("_before") != F.col("hash_diff"))
    judged = settle(marked.withColumn("is_version", starts).drop("_before"), "versions")
    versions = scan(judged.filter("is_version"), [key], sequence, following={"end_at": sequence[0]}, **options)
    repeats = judged.filter(~F.col("is_version")).withColumn("end_at", F.lit(None).cast(judged.schema[sequence[0]].dataType))
    return versions.unionByName(repeats).withColumn("is_current", F.col("is_version") & F.col("end_at").isNull())


class VersionStore(KeyBuckets):
    """A versioned table from changes, in buckets of its key.

    A batch reads and replaces the buckets of its keys. Rows that made no version stay in the
    store, for late changes; a change that comes again is the same row and changes nothing.
    """

    def latest(self) -> DataFrame | None:
        found = self.read()
        return None if found is None else found.filter("is_version").drop("is_version")

    def apply(self, changes: DataFrame, tracked: Sequence[str], sequence: Sequence[str], **options) -> None:
        """Rebuilds the histories of the keys of `changes`."""
        columns = list(dict.fromkeys([self.key, *tracked, *sequence]))
        arrived = settle(changes.select(*named(columns)).dropDuplicates(), "batch")
        touched = self.touched(arrived)
        if not touched:
            return
        known, rest = self.read(touched), None
        if known is not None:
            keys = settle(arrived.select(self.key).distinct(), "touched-keys")
            same = known[f"`{self.key}`"].eqNullSafe(keys[f"`{self.key}`"])
            rest = known.join(keys, same, "left_anti")
            old = known.join(keys, same, "left_semi").select(*named(columns))
            arrived = settle(old.unionByName(arrived).dropDuplicates(), "touched")
        rows = rebuild_history(arrived, self.key, tracked, sequence, **options)
        self.replace(settle(rows if rest is None else rows.unionByName(rest), "bucket-rows"))


def apply_changes(
    stream: DataFrame, store: VersionStore, checkpoint: str, tracked: Sequence[str], sequence: Sequence[str], **options
) -> DataFrame:
    """Keeps a versioned table from a change stream, late changes included.

    Only the buckets of a batch's keys are read, and only its keys are rebuilt.
    """
    run_batches(stream, lambda batch, _: store.apply(batch, tracked, sequence, **options), checkpoint)
    found = store.latest()
    if found is None:  # nothing has arrived yet
        columns = list(dict.fromkeys([store.key, *tracked, *sequence]))
        none = stream.sparkSession.createDataFrame([], stream.select(*named(columns)).schema)
        return rebuild_history(none, store.key, tracked, sequence, **options).filter("is_version").drop("is_version")
    return found


def streamed_ranking(current: DataFrame) -> DataFrame:
    """Hospitals by total billing over the current rows of the streamed table."""
    return billing_by(current, "Hospital")
