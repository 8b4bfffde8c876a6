"""Sources and sinks (S). Each writes to a fresh scratch folder and returns what it reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakemill.functions import dates
from lakemill.operators import clean
from lakemill.operators.statistics import share_of_rows
from lakemill.plans import layers, marts
from lakemill.registry import entry, roles
from lakemill.registry.cleaning import (
    CLEAN_ITEMS_SQL,
    CLEAN_ORDERS_SQL,
    CLEAN_PRODUCTS_SQL,
    ITEM_COUNTS_SQL,
    ORDER_COUNTS_SQL,
    PRODUCT_COUNTS_SQL,
    RUN_RECORD_SQL,
)
from lakemill.registry.roles import ENCOUNTERS_SQL
from lakemill.registry.sql import dbl, mean, month, percent
from lakemill.sources import bronze, catalog, files, reports


CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_SQL = "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"


@entry("S01", CUSTOMER_SQL)
def csv_with_schema(t):
    path = t.scratch("s01")
    files.write_csv(t.customer, path)
    return files.read_csv(t.spark, path, CUSTOMER_SCHEMA)


@entry("S02", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def csv_inferred(t):
    path = t.scratch("s02")
    files.write_csv(t.part, path)
    return files.read_csv_inferred(t.spark, path)


@entry(
    "S03",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
  CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS s_acctbal FROM supplier""",
)
def csv_as_text(t):
    path = t.scratch("s03")
    files.write_csv(t.supplier.withColumn("s_acctbal", F.col("s_acctbal").cast("decimal(12,2)")), path)
    return files.read_csv_text(t.spark, path)


@entry(
    "S04",
    "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_returnflag = 'R'",
)
def parquet_pruned(t):
    lines = files.read_parquet(t.spark, f"{t.folder}/lineitem.parquet")
    kept = (F.col("l_shipdate") >= dates.moment("2000-01-01")) & (F.col("l_returnflag") == "R")
    return lines.filter(kept).select("l_orderkey", "l_extendedprice")


@entry("S05", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def parquet_sink(t):
    path = t.scratch("s05")
    files.write_parquet(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), path, ["o_orderstatus"])
    return files.read_parquet(t.spark, path)


REMARK = """CASE WHEN lang = 'de' THEN '' WHEN lang = 'fr' THEN NULL WHEN lang = 'es' THEN 'say "' || source || '", ok '
  ELSE ' \\ ' || source END"""


@entry("S06", f"SELECT doc_id, text, {REMARK} AS remark, n_chars FROM documents")
def csv_sink(t):
    """Texts with line breaks, quotes, commas, blanks at the ends, empty texts and nulls."""
    path = t.scratch("s06")
    remark = (
        F.when(F.col("lang") == "de", "")
        .when(F.col("lang") == "fr", None)
        .when(F.col("lang") == "es", F.concat(F.lit('say "'), "source", F.lit('", ok ')))
        .otherwise(F.concat(F.lit(" \\ "), "source"))
    )
    rows = t.documents.select("doc_id", "text", remark.alias("remark"), "n_chars")
    files.write_csv(rows, path)
    return files.read_csv(t.spark, path, rows.schema)


BILLED_SQL = f"""COUNT(*) AS row_count, {dbl('SUM("Billing Amount")')} AS total_billing, {mean('SUM("Billing Amount")', 'COUNT("Billing Amount")')} AS avg_billing"""
SNAPSHOT_SCHEMA = """kpis STRUCT<total_hospitals: BIGINT, total_patients: BIGINT, total_billing: DOUBLE, avg_billing: DOUBLE>,
  condition ARRAY<STRUCT<`Medical Condition`: STRING, patient_count: BIGINT, total_billing: DOUBLE, avg_billing: DOUBLE, pct_of_patients: DOUBLE>>,
  admission_type ARRAY<STRUCT<`Admission Type`: STRING, patient_count: BIGINT, total_billing: DOUBLE, avg_billing: DOUBLE>>,
  insurance ARRAY<STRUCT<`Insurance Provider`: STRING, patient_count: BIGINT, total_billing: DOUBLE, avg_billing: DOUBLE>>,
  monthly_trend ARRAY<STRUCT<admission_month: STRING, admissions: BIGINT>>"""


@entry(
    "S07",
    f"""WITH {ENCOUNTERS_SQL}, parts AS (
  SELECT 'kpis' AS part, CAST(COUNT(DISTINCT "Hospital") AS VARCHAR) AS label, {BILLED_SQL}, NULL::DOUBLE AS share FROM cur
  UNION ALL SELECT 'condition', "Medical Condition", {BILLED_SQL}, {percent("COUNT(*)", "(SELECT COUNT(*) FROM cur)")} FROM cur GROUP BY ALL
  UNION ALL SELECT 'admission_type', "Admission Type", {BILLED_SQL}, NULL FROM cur GROUP BY ALL
  UNION ALL SELECT 'insurance', "Insurance Provider", {BILLED_SQL}, NULL FROM cur GROUP BY ALL
  UNION ALL SELECT 'monthly_trend', {month('"Date of Admission"')}, COUNT(*), NULL, NULL, NULL FROM cur GROUP BY ALL) SELECT * FROM parts""",
)
def json_snapshot(t):
    """The document's objects and lists, read back as rows."""
    current = roles.current_encounters(t)
    tables = {
        "condition": (marts.condition_contribution(current), ["Medical Condition"]),
        "admission_type": (marts.billing_by(current, "Admission Type"), ["Admission Type"]),
        "insurance": (marts.billing_by(current, "Insurance Provider"), ["Insurance Provider"]),
        "monthly_trend": (marts.monthly_admissions(current), ["admission_month"]),
    }
    path = t.scratch("s07")
    reports.write_document(reports.snapshot(tables, {"kpis": marts.key_figures(current)}), path)
    read = t.spark.read.text(path).select(F.from_json("value", SNAPSHOT_SCHEMA).alias("d")).select("d.*")

    def part(name, label, rows, total="x.total_billing", average="x.avg_billing", share="CAST(NULL AS DOUBLE)"):
        inner = read.selectExpr(f"explode({name}) AS x" if name != "kpis" else "kpis AS x")
        return inner.selectExpr(
            f"'{name}' AS part", f"CAST({label} AS STRING) AS label", f"{rows} AS row_count",
            f"{total} AS total_billing", f"{average} AS avg_billing", f"{share} AS share",
        )

    none = "CAST(NULL AS DOUBLE)"
    return (
        part("kpis", "x.total_hospitals", "x.total_patients")
        .unionAll(part("condition", "x.`Medical Condition`", "x.patient_count", share="x.pct_of_patients"))
        .unionAll(part("admission_type", "x.`Admission Type`", "x.patient_count"))
        .unionAll(part("insurance", "x.`Insurance Provider`", "x.patient_count"))
        .unionAll(part("monthly_trend", "x.admission_month", "x.admissions", none, none))
    )


@entry("S08", RUN_RECORD_SQL.format(gold="PASS", broken="(SELECT COUNT(*) FROM supplier)"))
def quality_json(t):
    """The encounters as files, and with them a record for each supplier whose name, not quoted, holds a comma."""
    raw = roles.raw_encounters(t)
    lines = raw.limit(0).unionByName(t.supplier.select(F.concat("s_name", F.lit(", annex")).alias("Hospital")), allowMissingColumns=True)
    source, target = t.scratch("s08-source"), t.scratch("s08-bronze")
    files.write_csv(raw, source, "gzip")
    lines.write.mode("append").options(**{**files.WRITE, "quote": ""}).csv(source)
    layer = bronze.ingest(t.spark, source, target)
    rows, broken = bronze.counts(t.spark, target)
    counts = clean.clean_encounters_counts(layer)
    path = t.scratch("s08")
    reports.write_metrics(
        layers.layer_metrics(t.spark, rows, rows - broken, counts, roles.encounters(t), 8, {"scd2": "PASS", "gold": "PASS"}), path
    )
    return t.spark.read.json(path).drop("timestamp")


@entry(
    "S09",
    f"""WITH {CLEAN_ORDERS_SQL}, {CLEAN_PRODUCTS_SQL}, {CLEAN_ITEMS_SQL}, o AS ({ORDER_COUNTS_SQL}), n AS ({PRODUCT_COUNTS_SQL}), i AS ({ITEM_COUNTS_SQL}),
  counted AS (SELECT 'orders' AS section, metric, found FROM (UNPIVOT o ON * INTO NAME metric VALUE found)
    UNION ALL SELECT 'products', metric, found FROM (UNPIVOT n ON * INTO NAME metric VALUE found)
    UNION ALL SELECT 'order_items', metric, found FROM (UNPIVOT i ON * INTO NAME metric VALUE found))
  SELECT '[' || section || ']   ' || metric || ': ' || found AS value FROM counted""",
)
def quality_lines(t):
    raw_items, kept = roles.raw_items(t), roles.kept_orders(t)
    lines = reports.metric_lines(
        {
            "orders": clean.clean_orders_counts(roles.raw_orders(t), roles.AS_OF),
            "products": clean.clean_products_counts(roles.raw_products(t)),
            "order_items": clean.clean_items_counts(raw_items, kept),
        }
    )
    path = t.scratch("s09")
    reports.write_lines(lines, path)
    return t.spark.read.text(path)


@entry(
    "S10",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, '"' || c_name || '",' || chr(10) AS c_name, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal,
  ROW_NUMBER() OVER (ORDER BY c_custkey) AS _bronze_row_id, TRUE AS has_lineage FROM customer""",
)
def bronze_ingest(t):
    """Files in key order, so that the row id follows the key."""
    path = t.scratch("s10")
    name = F.concat(F.lit('"'), "c_name", F.lit('",\n'))
    rows = t.customer.select("c_custkey", name.alias("c_name"), F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"))
    files.write_csv(rows.repartitionByRange(4, "c_custkey").sortWithinPartitions("c_custkey"), path)
    layer = bronze.ingest(t.spark, path, t.scratch("s10-bronze"))
    lineage = F.col("_ingestion_timestamp").isNotNull() & F.col("_source_file").endswith(".csv")
    return layer.select("c_custkey", "c_name", "c_acctbal", "_bronze_row_id", lineage.alias("has_lineage"))


@entry("S11", "SELECT o_orderkey, o_orderpriority, o_totalprice, 4::BIGINT AS batches FROM orders")
def incremental_files(t):
    path = t.scratch("s11")
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    files.write_csv(rows.repartition(4, "o_orderkey"), path)
    found = bronze.incoming_batches(t.spark, path)
    return files.read_csv(t.spark, found, rows.schema).withColumn("batches", F.lit(len(found)))


@entry("S12", "SELECT c_custkey, c_mktsegment IN ('BUILDING', 'MACHINERY') AS is_trade FROM customer")
def published(t):
    flag = F.expr("CASE c_mktsegment WHEN 'BUILDING' THEN 'True' WHEN 'MACHINERY' THEN '1' ELSE 'False' END")
    csv = t.scratch("s12-csv")
    files.write_csv(t.customer.select("c_custkey", flag.alias("is_trade")), csv)
    typed = files.read_csv(t.spark, csv, "c_custkey long, is_trade string")
    name = f"customers_{uuid.uuid4().hex}"
    catalog.publish(typed, name, flags=["is_trade"], path=t.scratch("s12"))
    return t.spark.sql(f"SELECT c_custkey, is_trade FROM {name}")


@entry(
    "S13",
    f"SELECT o_orderpriority, COUNT(*) AS orders, {dbl('SUM(CAST(o_totalprice AS DECIMAL(12,2)))')} AS revenue FROM orders GROUP BY 1",
)
def replaced(t):
    catalog.publish_views({"s13_orders": t.orders})
    name = f"priorities_{uuid.uuid4().hex}"
    query = """SELECT o_orderpriority, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS revenue
        FROM s13_orders GROUP BY o_orderpriority"""
    return catalog.replace_table(t.spark, name, query, path=t.scratch("s13"))


@entry("S14", "SELECT c_nationkey, SUM(strlen(c_name) + 1)::BIGINT AS size_bytes, TRUE AS has_name, TRUE AS has_time FROM customer GROUP BY 1")
def listing(t):
    """Customer names as text files, a folder a nation; the sizes listed are the bytes of the names and line ends."""
    path = t.scratch("s14")
    t.customer.select("c_name", "c_nationkey").write.partitionBy("c_nationkey").text(path)
    found = files.list_files(t.spark, path, "*.txt")
    return found.groupBy(F.regexp_extract("path", r"c_nationkey=(\d+)/", 1).cast("bigint").alias("c_nationkey")).agg(
        F.sum("size_bytes").alias("size_bytes"),
        F.bool_and(F.col("file_name").endswith(".txt")).alias("has_name"),
        F.bool_and(F.col("last_modified").isNotNull()).alias("has_time"),
    )


@entry("S15", "SELECT COUNT(*) AS rows_read, COUNT(*) AS rows_written, TRUE AS verified FROM lineitem")
def checked_copy(t):
    return files.copy_checked(t.lineitem, t.scratch("s15"))
