"""Projection, filter, predicate (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.functions import dates, numbers, text
from lakemill.operators import statistics
from lakemill.operators.clean import orphans
from lakemill.plans import sales as sales_plans
from lakemill.registry import entry
from lakemill.registry import roles
from lakemill.registry.roles import ENCOUNTERS_SQL, RAW_CUSTOMERS_SQL, RAW_ORDERS_SQL
from lakemill.registry.sql import big, day, dbl, half_up


@entry("P01", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def all_columns(t):
    return t.customer.select("*")


@entry("P02", "SELECT c_name, c_mktsegment FROM customer")
def some_columns(t):
    return t.customer.select("c_name", "c_mktsegment")


@entry("P03", "SELECT o_orderkey AS order_id, o_totalprice AS revenue FROM orders")
def renamed(t):
    return (
        t.orders.select("o_orderkey", "o_totalprice")
        .withColumnRenamed("o_orderkey", "order_id")
        .withColumnRenamed("o_totalprice", "revenue")
    )


@entry("P04", "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey FROM supplier")
def dropped(t):
    return t.supplier.drop("s_acctbal")


@entry(
    "P05",
    f"""SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  {dbl("CAST(l_quantity AS DECIMAL(9,0)) * CAST(l_extendedprice AS DECIMAL(12,2))")} AS total_amount FROM lineitem""",
)
def derived(t):
    total = F.col("l_quantity").cast("decimal(9,0)") * numbers.money(F.col("l_extendedprice"))
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", total.alias("total_amount"))


@entry(
    "P06",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'",
)
def equal_and_unequal(t):
    kept = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW"))
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@entry("P07", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_tax < 0.05 AND l_discount >= 0.05")
def compared(t):
    kept = t.lineitem.filter((F.col("l_quantity") > 45) & (F.col("l_tax") < 0.05) & (F.col("l_discount") >= 0.05))
    return kept.select("l_orderkey", "l_partkey", "l_quantity")


@entry("P08", "SELECT p_partkey, p_name, p_type, p_retailprice FROM part WHERE p_type = 'ECONOMY' AND p_retailprice > 950")
def conjunction(t):
    kept = t.part.filter((F.col("p_type") == "ECONOMY") & (F.col("p_retailprice") > 950))
    return kept.select("p_partkey", "p_name", "p_type", "p_retailprice")


@entry(
    "P09",
    f"""SELECT o_orderkey, {day("o_orderdate")} AS o_orderdate FROM orders
  WHERE o_orderdate BETWEEN TIMESTAMP '1997-08-10' AND TIMESTAMP '1997-08-25' AND o_orderstatus <> 'P'""",
)
def between(t):
    span = F.col("o_orderdate").between(dates.moment("1997-08-10"), dates.moment("1997-08-25"))
    return t.orders.filter(span & (F.col("o_orderstatus") != "P")).select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))


@entry("P10", f"SELECT o_orderkey, {day('o_orderdate')} AS o_orderdate FROM orders WHERE year(o_orderdate) = 1998")
def whole_year(t):
    """A year as a range on the raw column, which reaches the scan; `year(column)` would not."""
    c = F.col("o_orderdate")
    kept = t.orders.filter((c >= dates.moment("1998-01-01")) & (c < dates.moment("1999-01-01")))
    return kept.select("o_orderkey", F.to_date(c).alias("o_orderdate"))


@entry("P11", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def in_list(t):
    return t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@entry(
    "P12",
    f"""WITH {RAW_CUSTOMERS_SQL} SELECT email IS NULL AS without_email, COUNT(*) AS row_count
  FROM raw_customers GROUP BY ALL""",
)
def null_tests(t):
    raw = roles.raw_customers(t)
    without = raw.filter(F.col("email").isNull()).agg(F.count(F.lit(1)).alias("row_count"))
    with_it = raw.filter(F.col("email").isNotNull()).agg(F.count(F.lit(1)).alias("row_count"))
    return without.withColumn("without_email", F.lit(True)).unionByName(with_it.withColumn("without_email", F.lit(False)))


@entry(
    "P13",
    f"""WITH {RAW_ORDERS_SQL} SELECT order_id, customer_id FROM raw_orders
  WHERE order_date IS NOT NULL AND trim(customer_id) <> ''""",
)
def not_blank(t):
    kept = F.col("order_date").isNotNull() & text.not_blank(F.col("customer_id"))
    return roles.raw_orders(t).filter(kept).select("order_id", "customer_id")


@entry(
    "P14",
    f"""WITH {RAW_ORDERS_SQL} SELECT order_id, order_date FROM raw_orders
  WHERE regexp_matches(order_date, '^\\d{{2}}-\\d{{2}}-\\d{{4}}$')""",
)
def regex(t):
    return roles.raw_orders(t).filter(F.col("order_date").rlike(r"^\d{2}-\d{2}-\d{4}$")).select("order_id", "order_date")


@entry(
    "P15",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'High' WHEN o_totalprice >= 100000 THEN 'Mid' ELSE 'Low' END AS band
  FROM orders""",
)
def case_label(t):
    price = F.col("o_totalprice")
    band = F.when(price >= 300000, "High").when(price >= 100000, "Mid").otherwise("Low")
    return t.orders.select("o_orderkey", band.alias("band"))


@entry(
    "P16",
    """SELECT o_orderkey AS row_id, o_totalprice AS sales FROM orders
  WHERE CAST(o_totalprice AS DECIMAL(12,2)) * (SELECT COUNT(*) FROM orders)
        > (SELECT SUM(CAST(o_totalprice AS DECIMAL(12,2))) FROM orders)""",
)
def above_scalar(t):
    return sales_plans.above_mean(roles.sales(t)).select("row_id", "sales")


@entry(
    "P17",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
  WHERE o_totalprice = (SELECT MAX(i.o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)""",
)
def correlated_maximum(t):
    """Written as the subquery it is: the planner makes it a grouped maximum and a join."""
    return t.spark.sql(
        """SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} o
        WHERE o_totalprice = (SELECT max(i.o_totalprice) FROM {orders} i WHERE i.o_custkey = o.o_custkey)""",
        orders=t.orders,
    )


@entry(
    "P18",
    """SELECT c_custkey FROM customer WHERE c_custkey NOT IN
  (SELECT CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN o_custkey ELSE -1 - o_custkey END FROM orders
   WHERE o_custkey IS NOT NULL)""",
)
def not_in(t):
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    key = F.when(urgent, F.col("o_custkey")).otherwise(-1 - F.col("o_custkey"))
    return orphans(t.customer.select("c_custkey"), t.orders.select(key.alias("c_custkey")), "c_custkey")


@entry(
    "P19",
    """WITH best AS (SELECT p_brand FROM part GROUP BY p_brand ORDER BY COUNT(*) DESC, p_brand LIMIT 10)
  SELECT p_partkey, p_brand FROM part WHERE p_brand IN (SELECT p_brand FROM best)""",
)
def among_top(t):
    return statistics.with_top_values(t.part, "p_brand", 10).select("p_partkey", "p_brand")


@entry(
    "P20",
    f"""WITH {ENCOUNTERS_SQL} SELECT "Name", "Hospital", {day('"Date of Admission"')} AS "Date of Admission",
  {dbl('"Billing Amount"')} AS "Billing Amount" FROM cur""",
)
def current_only(t):
    return roles.current_encounters(t).select("Name", "Hospital", "Date of Admission", "Billing Amount")
