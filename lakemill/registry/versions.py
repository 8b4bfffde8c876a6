"""Keys, versions, merges (V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.functions.keys import md5_key, with_keys
from lakemill.functions.numbers import money
from lakemill.operators.rows import beside
from lakemill.operators.versions import Merge, VersionTable, dense_ids, dimension, merge_versions, place_orders
from lakemill.registry import entry, roles
from lakemill.registry.sql import big, day, dbl
from lakemill.session import settle


KEYS, TRACKED = ["c_custkey", "c_name"], ["c_acctbal", "c_nationkey", "c_mktsegment"]
KEY_SQL = "md5(c_custkey || '|' || (c_name))"
HASH_SQL = "md5(CAST({b} AS VARCHAR) || '|' || c_nationkey || '|' || c_mktsegment)"
BALANCE = "CAST(c_acctbal AS DECIMAL(12,2))"


def customers(t):
    return t.customer.withColumn("c_acctbal", money(F.col("c_acctbal")))


@entry("V01", f"SELECT c_custkey, {KEY_SQL} AS encounter_key FROM customer")
def business_key(t):
    return t.customer.select("c_custkey", md5_key([F.col(c) for c in KEYS]).alias("encounter_key"))


@entry("V02", f"SELECT c_custkey, {HASH_SQL.format(b=BALANCE)} AS hash_diff FROM customer")
def change_hash(t):
    return with_keys(customers(t), KEYS, TRACKED).select("c_custkey", "hash_diff")


SHOWN = ["c_custkey", "c_acctbal", "encounter_key", "effective_start_date", "effective_end_date", "is_current", "_scd_surrogate_key"]
DAY1, DAY2 = "2024-06-01", "2024-06-02"


def first_load(t) -> Merge:
    """All customers."""
    return merge_versions(None, customers(t), DAY1, ["c_custkey"], KEYS, TRACKED)


#: In the second batch the customers of one segment come under another name, as new ones.
RENAMED = "CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ' II' ELSE c_name END"


def second_load(t) -> Merge:
    """All customers again: those of one segment are new, one segment has a new balance, the others come unchanged."""
    raised = F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") + 10).otherwise(F.col("c_acctbal"))
    batch = customers(t).withColumns({"c_acctbal": raised.cast("decimal(12,2)"), "c_name": F.expr(RENAMED)})
    table = VersionTable(t.spark, t.scratch("versions"))
    table.merge(customers(t), DAY1, ["c_custkey"], KEYS, TRACKED)
    return table.merge(batch, DAY2, ["c_custkey"], KEYS, TRACKED)


FIRST_SQL = f"""first AS (SELECT c_custkey, {BALANCE} AS c_acctbal, {KEY_SQL} AS encounter_key, c_mktsegment,
  ROW_NUMBER() OVER (ORDER BY c_custkey) AS _scd_surrogate_key FROM customer)"""


@entry(
    "V03",
    f"""WITH {FIRST_SQL} SELECT c_custkey, {dbl("c_acctbal")} AS c_acctbal, encounter_key, '{DAY1}' AS effective_start_date,
  NULL::VARCHAR AS effective_end_date, TRUE AS is_current, _scd_surrogate_key FROM first""",
)
def initial_versions(t):
    return first_load(t).snapshot.select(*SHOWN)


@entry(
    "V04",
    f"""WITH {FIRST_SQL}, added AS (SELECT c_custkey, {BALANCE} + CASE WHEN c_mktsegment = 'MACHINERY' THEN 10 ELSE 0 END AS c_acctbal,
    {KEY_SQL.replace("c_name", RENAMED)} AS encounter_key, (SELECT MAX(_scd_surrogate_key) FROM first)
      + ROW_NUMBER() OVER (ORDER BY CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END, c_custkey) AS _scd_surrogate_key
    FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
  SELECT c_custkey, {dbl("c_acctbal")} AS c_acctbal, encounter_key, '{DAY1}' AS effective_start_date,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN '{DAY2}' END AS effective_end_date, c_mktsegment <> 'MACHINERY' AS is_current, _scd_surrogate_key FROM first
  UNION ALL SELECT c_custkey, {dbl("c_acctbal")}, encounter_key, '{DAY2}', NULL, TRUE, _scd_surrogate_key FROM added""",
)
def merged_versions(t):
    return second_load(t).snapshot.select(*SHOWN)


@entry(
    "V05",
    """SELECT COUNT(*) FILTER (c_mktsegment = 'BUILDING') AS "new", COUNT(*) FILTER (c_mktsegment = 'MACHINERY') AS changed,
  COUNT(*) FILTER (c_mktsegment = 'MACHINERY') AS expired, COUNT(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS unchanged FROM customer""",
)
def merge_statistics(t):
    return second_load(t).statistics()


FLAT_SQL = """flat AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, p_name || '-' || l_returnflag AS part_name, p_type, s_name
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


@entry(
    "V06",
    f"""WITH {FLAT_SQL} SELECT 'part' AS table_name, l_partkey AS id, MIN(part_name) AS name, COUNT(*) AS fact_rows FROM flat GROUP BY l_partkey
  UNION ALL SELECT 'supplier', l_suppkey, MIN(s_name), COUNT(*) FROM flat GROUP BY l_suppkey""",
)
def normalised(t):
    """A flat table whose part names conflict: the first name in text order is kept."""
    flat = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey", "l_partkey", "l_suppkey", F.concat("p_name", F.lit("-"), "l_returnflag").alias("part_name"), "p_type", "s_name"
        )
    )
    out = None
    for table, key, name in (("part", "l_partkey", "part_name"), ("supplier", "l_suppkey", "s_name")):
        rows = dimension(flat, key, [name], [name])
        facts = flat.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
        shown = rows.join(facts, key).select(
            F.lit(table).alias("table_name"), F.col(key).alias("id"), F.col(name).alias("name"), "fact_rows"
        )
        out = shown if out is None else out.unionByName(shown)
    return out


NEW_SQL = "o_orderdate >= TIMESTAMP '2001-07-01'"


@entry(
    "V07",
    f"""WITH o AS (SELECT o_orderkey, {NEW_SQL} AS is_new FROM orders), i AS (SELECT l_partkey, l_quantity, is_new FROM lineitem JOIN o ON l_orderkey = o_orderkey)
  SELECT p_partkey AS product_id, 10000 - {big("COALESCE(SUM(l_quantity) FILTER (is_new), 0)")} AS stock_qty,
  (SELECT COUNT(*) FROM orders) AS order_rows, (SELECT COUNT(*) FROM i) AS item_rows FROM part LEFT JOIN i ON l_partkey = p_partkey GROUP BY p_partkey""",
)
def placed_orders(t):
    """The orders of the last weeks are placed on the earlier snapshot."""
    new = F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz")
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    items = lines.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("bigint").alias("quantity"), new.alias("is_new")
    )
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"), new.alias("is_new"))
    products = t.part.select(F.col("p_partkey").alias("product_id"), F.lit(10000).cast("bigint").alias("stock_qty"))
    all_orders, all_items, stock = place_orders(
        orders.filter("not is_new"), items.filter("not is_new"), products, orders.filter("is_new"), items.filter("is_new")
    )
    order_rows = all_orders.agg(F.count(F.lit(1)).alias("order_rows"))
    item_rows = all_items.agg(F.count(F.lit(1)).alias("item_rows"))
    return beside(beside(stock, order_rows), item_rows)


@entry("V08", "SELECT o_orderkey, 1000 + ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders")
def continued_ids(t):
    return dense_ids(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "id", after=1000).drop("o_orderdate")
