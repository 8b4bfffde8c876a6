"""Joins (J). Hot keys of equi-joins are split by the adaptive planner (see session.SETTINGS)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.functions import dates
from lakemill.functions.numbers import money, percent
from lakemill.operators import clean
from lakemill.operators.ordered import numbered
from lakemill.operators.versions import classify, last_per_key
from lakemill.registry import entry, roles
from lakemill.registry.roles import RAW_ITEMS_SQL
from lakemill.registry.sql import day, dbl, percent as percent_sql
from lakemill.session import settle


JOINED = f"SELECT o_orderkey, {day('o_orderdate')} AS o_orderdate, c_name, o_totalprice FROM orders"


@entry("J01", f"{JOINED} JOIN customer ON o_custkey = c_custkey")
def inner(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "c_name", "o_totalprice"
    )


#: Earlier orders carry the key of no customer, so both sides have rows without a partner.
LATE = """(SELECT * REPLACE (CASE WHEN o_orderdate >= TIMESTAMP '2001-06-01' THEN o_custkey ELSE -1 - o_custkey END AS o_custkey)
  FROM orders)"""


def late_orders(t):
    known = F.col("o_orderdate") >= dates.moment("2001-06-01")
    return t.orders.withColumn("o_custkey", F.when(known, F.col("o_custkey")).otherwise(-1 - F.col("o_custkey")))


@entry("J02", f"SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN {LATE} o ON c_custkey = o_custkey")
def left(t):
    return t.customer.join(late_orders(t), F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "c_name", "o_orderkey", "o_totalprice"
    )


@entry(
    "J03",
    """SELECT l_orderkey, p_name, s_name, l_quantity, l_extendedprice, l_discount, o_orderstatus FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
)
def star(t):
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "p_name", "s_name", "l_quantity", "l_extendedprice", "l_discount", "o_orderstatus")
    )


@entry("J04", f"SELECT c_custkey, o_orderkey FROM {LATE} o RIGHT JOIN customer ON c_custkey = o_custkey")
def right(t):
    return late_orders(t).join(t.customer, F.col("c_custkey") == F.col("o_custkey"), "right").select("c_custkey", "o_orderkey")


@entry(
    "J05",
    """WITH a AS (SELECT o_custkey AS k, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
  b AS (SELECT CASE WHEN o_custkey % 7 = 0 THEN -o_custkey ELSE o_custkey END AS k, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
  SELECT COALESCE(a.k, b.k) AS c_custkey, a.n AS done, b.n AS open,
  CASE WHEN a.k IS NULL THEN 'right only' WHEN b.k IS NULL THEN 'left only' ELSE 'both' END AS side
  FROM a FULL JOIN b ON a.k = b.k""",
)
def full(t):
    """All orders; a seventh of the customers has other numbers on the right."""

    def counted(chosen, key, name):
        return t.orders.filter(chosen).groupBy(key.alias("c_custkey")).agg(F.count(F.lit(1)).alias(name))

    key, done = F.col("o_custkey"), F.col("o_orderstatus") == "F"
    other = F.when(key % 7 == 0, -key).otherwise(key)

    side = F.when(F.col("done").isNull(), "right only").when(F.col("open").isNull(), "left only").otherwise("both")
    return counted(done, key, "done").join(counted(~done, other, "open"), "c_custkey", "full").withColumn("side", side)


@entry(
    "J06",
    """SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT MAX(o_orderdate) FROM orders) AS DATE)) AS days_before_last
  FROM orders""",
)
def cross_with_bounds(t):
    bounds = t.orders.agg(F.max("o_orderdate").alias("last"))
    days = F.datediff(F.to_date("last"), F.to_date("o_orderdate")).alias("days_before_last")
    return t.orders.crossJoin(F.broadcast(bounds)).select("o_orderkey", days)


@entry(
    "J07",
    """WITH m AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, COUNT(*) AS n FROM orders GROUP BY 1, 2)
  SELECT a.y AS year, a.m AS month, a.n AS orders, b.n AS orders_year_before
  FROM m a LEFT JOIN m b ON b.y = a.y - 1 AND b.m = a.m""",
)
def shifted_year(t):
    monthly = t.orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    before = monthly.select((F.col("year") + 1).alias("year"), "month", F.col("orders").alias("orders_year_before"))
    return monthly.join(before, ["year", "month"], "left")


@entry(
    "J08",
    """WITH s AS (SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq FROM orders)
  SELECT a.o_custkey, a.seq, a.o_orderkey, b.o_orderkey AS next_orderkey
  FROM s a JOIN s b ON a.o_custkey = b.o_custkey AND b.seq = a.seq + 1""",
)
def next_in_sequence(t):
    """The join key holds the sequence number, so a customer with many orders stays spread."""
    placed = settle(
        numbered(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "seq")
    )
    after = placed.select("o_custkey", (F.col("seq") - 1).alias("seq"), F.col("o_orderkey").alias("next_orderkey"))
    return placed.join(after, ["o_custkey", "seq"]).select("o_custkey", "seq", "o_orderkey", "next_orderkey")


@entry(
    "J09",
    f"""WITH {RAW_ITEMS_SQL} SELECT order_id, product_id, unit_price FROM raw_items
  WHERE order_id NOT IN (SELECT order_id FROM kept_orders)""",
)
def anti(t):
    return clean.orphans(roles.raw_items(t), roles.kept_orders(t), "order_id").select("order_id", "product_id", "unit_price")


@entry(
    "J10",
    f"""WITH {RAW_ITEMS_SQL} SELECT order_id, product_id, unit_price FROM raw_items
  WHERE order_id IN (SELECT order_id FROM kept_orders)""",
)
def semi(t):
    return (
        roles.raw_items(t)
        .join(roles.kept_orders(t), "order_id", "left_semi")
        .select("order_id", "product_id", "unit_price")
    )


@entry(
    "J11",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'new' WHEN c_mktsegment = 'MACHINERY' THEN 'changed' ELSE 'unchanged' END
  AS change_type FROM customer""",
)
def change_detection(t):
    """Table and batch hold all customers; in the batch one segment has other names, one a new balance."""
    ready = t.customer.withColumn("c_acctbal", money(F.col("c_acctbal")))
    renamed = F.when(F.col("c_mktsegment") == "BUILDING", F.concat("c_name", F.lit(" II"))).otherwise(F.col("c_name"))
    changed = F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") + 10).otherwise(F.col("c_acctbal"))
    keys, tracked = ["c_custkey", "c_name"], ["c_acctbal", "c_nationkey"]
    current = last_per_key(ready, ["c_custkey"], keys, tracked)
    incoming = ready.withColumns({"c_acctbal": changed.cast("decimal(12,2)"), "c_name": renamed})
    batch = last_per_key(incoming, ["c_custkey"], keys, tracked)
    return classify(batch, current).select("c_custkey", "change_type")
