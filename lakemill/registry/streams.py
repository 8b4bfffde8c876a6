"""Streams (R). The events arrive as files in no order of time; the SQL is the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.functions.numbers import money
from lakemill.operators import audit
from lakemill.operators.rows import beside
from lakemill.registry import entry, roles
from lakemill.registry.sql import dbl, half_up, mean, moment
from lakemill.streaming import changes


FILES = 3


def arriving_events(t, files_per_batch=1):
    """The events as files by hash of their id, one for each batch: every file spans all times."""
    folder = t.scratch("events")
    t.events.repartition(FILES, "event_id").write.parquet(folder)
    return changes.read_stream(t.spark, folder, t.events.schema, files_per_batch=files_per_batch)


@entry("R01", "SELECT event_id, user_id, event_type, value, props, TRUE AS has_lineage FROM events")
def stream_bronze(t):
    written = changes.run_to_files(changes.with_lineage(arriving_events(t)), t.scratch("r01"), t.scratch("r01-log"))
    lineage = F.col("_ingestion_timestamp").isNotNull() & F.col("_source_file").endswith(".parquet")
    return written.select("event_id", "user_id", "event_type", "value", "props", lineage.alias("has_lineage"))


STREAM_COLUMNS = {
    "Name": "'  ' || event_type || '-user ' || user_id",
    "Doctor": "event_type",
    "Hospital": "'ward ' || user_id",
    "Date of Admission": "CASE WHEN event_type = 'error' THEN 'unknown' ELSE {day} END",
    "Billing Amount": "CASE WHEN event_type = 'click' THEN '-' || CAST(CAST(value AS DECIMAL(12,2)) AS STRING) WHEN event_type = 'view' THEN 'free' "
    "ELSE CAST(CAST(value AS DECIMAL(12,2)) AS STRING) END",
}
KEY_COLUMNS = ["Name", "Date of Admission", "Hospital", "Doctor"]


def arriving_encounters(t, repeated=False):
    """The events as raw encounters; `repeated` ones come a second time, and are taken once."""
    stream = arriving_events(t)
    if repeated:
        again = stream.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
        stream = changes.delivered_once(again, ["event_id"])
    day = "date_format(ts, 'yyyy-MM-dd')"
    raw = stream.select("event_id", *[F.expr(e.format(day=day)).alias(c) for c, e in STREAM_COLUMNS.items()])
    return changes.silver_columns(raw, KEY_COLUMNS)


NAME_SQL = "upper(event_type[1]) || event_type[2:] || '-User ' || user_id"
DAY_SQL = "CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END"
AMOUNT_SQL = "CASE WHEN event_type <> 'view' THEN CAST(value AS DECIMAL(12,2)) END"
SILVER_SQL = f"""silver AS (SELECT event_id, event_type, {NAME_SQL} AS "Name", {DAY_SQL} AS "Date of Admission", 'Ward ' || user_id AS "Hospital",
  upper(event_type[1]) || event_type[2:] AS "Doctor", {AMOUNT_SQL} AS "Billing Amount" FROM events)"""


@entry(
    "R02",
    f"""WITH {SILVER_SQL} SELECT event_id, "Name", "Date of Admission", "Hospital", "Doctor", {dbl('"Billing Amount"')} AS "Billing Amount",
  md5("Name" || '|' || COALESCE("Date of Admission", '<null>') || '|' || "Hospital" || '|' || "Doctor") AS encounter_key FROM silver""",
)
def stream_silver(t):
    written = changes.run_to_files(arriving_encounters(t, repeated=True), t.scratch("r02"), t.scratch("r02-log"))
    return written.drop("_raw_billing")


@entry(
    "R03",
    f"""WITH {SILVER_SQL}, x AS (SELECT 'valid_name' AS expectation, "Name" IS NOT NULL AS ok FROM silver
    UNION ALL SELECT 'valid_admission_date', "Date of Admission" IS NOT NULL FROM silver
    UNION ALL SELECT 'non_negative_billing', "Billing Amount" IS NOT NULL AND event_type <> 'click' FROM silver
    UNION ALL SELECT 'kept', "Name" IS NOT NULL AND "Date of Admission" IS NOT NULL FROM silver)
  SELECT expectation, COUNT(*) FILTER (ok) AS passed, COUNT(*) FILTER (NOT ok) AS failed FROM x GROUP BY 1""",
)
def stream_expectations(t):
    target = t.scratch("r03")
    kept = changes.run_expected(
        arriving_encounters(t), target, t.scratch("r03-log"), changes.required_rules(), changes.watched_rules()
    )
    counts = changes.expectation_totals(t.spark, target)
    rows = beside(kept.agg(F.count(F.lit(1)).alias("passed")), t.events.agg(F.count(F.lit(1)).alias("n")))
    last = rows.select(F.lit("kept").alias("expectation"), "passed", (F.col("n") - F.col("passed")).alias("failed"))
    return counts.unionByName(last)


HISTORY_SQL = """seen AS (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
versions AS (SELECT user_id, event_type, ts, event_id FROM seen WHERE before IS NULL OR before <> event_type),
history AS (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_at FROM versions)"""


def versioned(t):
    stream = arriving_events(t).select("user_id", "event_type", "ts", "event_id")
    store = changes.VersionStore(t.spark, t.scratch("versions"), "user_id")
    return changes.apply_changes(stream, store, t.scratch("versions-log"), ["event_type"], ["ts", "event_id"])


@entry(
    "R04",
    f"""WITH {HISTORY_SQL} SELECT user_id, event_type, event_id, {moment("ts")} AS ts, {moment("end_at")} AS end_at, end_at IS NULL AS is_current FROM history""",
)
def stream_versions(t):
    return versioned(t).select("user_id", "event_type", "event_id", "ts", "end_at", "is_current")


@entry(
    "R05",
    f"""WITH {HISTORY_SQL} SELECT event_type AS "Hospital", COUNT(*) AS patient_count, {dbl("SUM(user_id)")} AS total_billing, {mean("SUM(user_id)", "COUNT(*)")} AS avg_billing
  FROM history WHERE end_at IS NULL GROUP BY 1""",
)
def stream_mart(t):
    """The current event type stands for the hospital, the user number for the amount."""
    current = versioned(t).filter("is_current").select(F.col("event_type").alias("Hospital"), F.col("user_id").alias("Billing Amount"))
    return changes.streamed_ranking(current)
