"""The given tables in the columns that the jobs expect, and dirtied forms of them.

Dirt is derived from column values, on all rows, the same way in the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.operators.rows import spread
from lakemill.registry import Tables



def customers(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category")
    )


def orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
    )


def region_orders(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    homes = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("r_name").alias("region_code")
    )
    return orders(t).join(homes, "customer_id")


def items(t: Tables) -> DataFrame:
    """Returned lines carry a negative quantity."""
    quantity = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        (F.col("l_discount").cast("decimal(4,2)") * 100).cast("decimal(5,2)").alias("discount_percent"),
    )


def sales(t: Tables) -> DataFrame:
    """One sales line per order."""
    return t.orders.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("sales"),
    )


SALES_SQL = """
customers AS (SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer),
sales AS (SELECT o_orderkey AS row_id, o_orderkey AS order_id, o_custkey AS customer_id,
  o_orderdate AS order_date, CAST(o_totalprice AS DECIMAL(12,2)) AS sales FROM orders),
totals AS (SELECT customer_id, customer_name, SUM(sales) AS total_sales
  FROM sales JOIN customers USING (customer_id) GROUP BY ALL)"""

# Raw orders: blank customers, two date layouts and unreadable dates, states in any case.
AS_OF = "2001-01-01"
RAW_CUSTOMER_ID = (
    "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN '  ' ELSE CAST(o_custkey AS STRING) END"
)
RAW_STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN ' delivered ' WHEN 'O' THEN 'Placed' ELSE 'lost' END"
)
RAW_DATE = (
    "CASE WHEN o_orderpriority = '3-MEDIUM' THEN {short} "
    "WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN 'unknown' ELSE {long} END"
)


def raw_orders(t: Tables) -> DataFrame:
    text = RAW_DATE.format(
        short="date_format(o_orderdate, 'dd-MM-yyyy')", long="date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"
    )
    return t.orders.selectExpr(
        "o_orderkey AS order_id", f"{RAW_CUSTOMER_ID} AS customer_id", f"{text} AS order_date", f"{RAW_STATUS} AS status"
    )


RAW_ORDERS_SQL = f"""
raw_orders AS (SELECT o_orderkey AS order_id, {RAW_CUSTOMER_ID} AS customer_id,
  {RAW_DATE.format(short="strftime(o_orderdate, '%d-%m-%Y')", long="strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')")} AS order_date,
  {RAW_STATUS} AS status FROM orders)"""

# Raw products: case and blanks, prices that are no number, and a second row for one brand.
RAW_PRICE = (
    "CASE WHEN p_size = 13 THEN 'n/a' WHEN p_size = 7 THEN '-1.50' WHEN p_size = 9 THEN '0.004' "
    "ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) END"
)
RAW_PRODUCT = (
    "CAST(p_partkey AS STRING) AS product_id, {place} AS place, {name} AS product_name, "
    f"lower(p_type) AS category, '  ' || p_brand || ' ' AS subcategory, {RAW_PRICE} AS cost_price"
)
FIRST_PRODUCT = RAW_PRODUCT.format(place="p_partkey * 2", name="'  ' || upper(p_name)")
SECOND_PRODUCT = RAW_PRODUCT.format(place="p_partkey * 2 + 1", name="p_name || '-copy'")


def raw_products(t: Tables) -> DataFrame:
    first = t.part.selectExpr(*parts(FIRST_PRODUCT))
    return first.unionByName(t.part.filter("p_brand = 'Brand#5'").selectExpr(*parts(SECOND_PRODUCT)))


RAW_PRODUCTS_SQL = f"""
raw_products AS (SELECT {FIRST_PRODUCT} FROM part
  UNION ALL SELECT {SECOND_PRODUCT} FROM part WHERE p_brand = 'Brand#5')"""


def parts(select: str) -> list[str]:
    """Splits a select list at its outer commas."""
    out, depth, start = [], 0, 0
    for i, mark in enumerate(select):
        depth += (mark == "(") - (mark == ")")
        if mark == "," and depth == 0:
            out.append(select[start:i])
            start = i + 1
    return [*out, select[start:]]


# Raw items: returns, zero and unreadable quantities, discounts out of range, no discount.
RAW_ITEM = (
    "l_orderkey AS order_id, l_partkey AS product_id, ' part ' || l_partkey || '-x ' AS product_name, "
    "CASE WHEN l_tax = 0.08 THEN 'abc' WHEN l_tax = 0.0 THEN '0' "
    "WHEN l_returnflag = 'R' THEN CAST(CAST(-l_quantity AS INT) AS STRING) "
    "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity, "
    "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) AS unit_price, "
    "CASE WHEN l_linenumber = 6 THEN '150' WHEN l_linenumber = 5 THEN '-5' WHEN l_linenumber = 4 THEN NULL "
    "ELSE CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS STRING) END AS discount_percent"
)


def raw_items(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(*parts(RAW_ITEM))


def kept_orders(t: Tables) -> DataFrame:
    """Orders of the first year are gone, so their items are orphans."""
    return t.orders.filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("order_id")
    )


RAW_ITEMS_SQL = f"""
raw_items AS (SELECT {RAW_ITEM} FROM lineitem),
kept_orders AS (SELECT o_orderkey AS order_id FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')"""

# Raw customers: names in lower case with blanks, addresses without a mark or with a blank.
RAW_EMAIL = (
    "CASE WHEN c_nationkey = 3 THEN 'c' || c_custkey || '.example.com' "
    "WHEN c_nationkey = 4 THEN 'c ' || c_custkey || '@example.com' WHEN c_nationkey = 5 THEN NULL "
    "ELSE ' c' || c_custkey || '@example.com ' END"
)
RAW_CUSTOMER = f"c_custkey AS customer_id, '  ' || lower(replace(c_name, '#', '-a')) AS customer_name, {RAW_EMAIL} AS email"


def raw_customers(t: Tables) -> DataFrame:
    return t.customer.selectExpr(*parts(RAW_CUSTOMER))


RAW_CUSTOMERS_SQL = f"raw_customers AS (SELECT {RAW_CUSTOMER} FROM customer)"

# Encounters: a line is an encounter of the customer, at the supplier, with the part's name as doctor.
ENCOUNTER_COLUMNS = {
    "Name": "c_name",
    "Age": "p_size",
    "Gender": "l_linestatus",
    "Blood Type": "l_returnflag",
    "Medical Condition": "o_orderpriority",
    "Date of Admission": "CAST(o_orderdate AS DATE)",
    "Doctor": "p_name",
    "Hospital": "s_name",
    "Insurance Provider": "c_mktsegment",
    "Billing Amount": "CAST(l_extendedprice AS DECIMAL(12,2))",
    "Room Number": "l_linenumber",
    "Admission Type": "o_orderstatus",
    "Discharge Date": "CAST(l_shipdate AS DATE)",
    "Medication": "p_brand",
    "Test Results": "l_returnflag",
}


def _lines(t: Tables) -> DataFrame:
    """Orders meet their customers first, so that the lines, the longest table, are shuffled for one join less."""
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return (
        spread(t.lineitem, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )


LINES_SQL = """lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""


def encounters(t: Tables) -> DataFrame:
    """Versioned encounters: lines of status O are current."""
    columns = [F.expr(e).alias(c) for c, e in ENCOUNTER_COLUMNS.items()]
    return _lines(t).select(*columns, (F.col("l_linestatus") == "O").alias("is_current"))


def current_encounters(t: Tables) -> DataFrame:
    return encounters(t).filter("is_current")


_ENCOUNTER_SQL = ", ".join('{} AS "{}"'.format(e, c) for c, e in ENCOUNTER_COLUMNS.items())
ENCOUNTERS_SQL = f"""
encounters AS (SELECT {_ENCOUNTER_SQL}, l_linestatus = 'O' AS is_current FROM {LINES_SQL}),
cur AS (SELECT * FROM encounters WHERE is_current)"""

# Raw encounters, all text: case and blanks, missing names, three date layouts and unreadable
# dates, negative and unreadable amounts; the lines of one status come twice.
RAW_ENCOUNTER = {
    "Name": "CASE WHEN c_nationkey = 3 THEN NULL ELSE '  ' || lower(c_name) || ' ' END",
    "Age": "CASE WHEN p_size = 50 THEN 'old' ELSE CAST(p_size AS STRING) END",
    "Medical Condition": "lower(o_orderpriority)",
    "Date of Admission": (
        "CASE o_orderpriority WHEN '3-MEDIUM' THEN {slash} WHEN '2-HIGH' THEN {dutch} "
        "WHEN '5-LOW' THEN CASE WHEN o_orderstatus = 'P' THEN 'soon' ELSE {iso} END ELSE {iso} END"
    ),
    "Doctor": "upper(p_name)",
    "Hospital": "s_name",
    "Billing Amount": (
        "CASE WHEN l_tax = 0.08 THEN 'n/a' WHEN l_returnflag = 'R' THEN '-' || "
        "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END"
    ),
    "Room Number": "CAST(l_linenumber AS STRING)",
    "Admission Type": "lower(o_orderstatus)",
    "Discharge Date": "CASE WHEN l_linenumber = 7 THEN NULL ELSE {ship} END",
    "Medication": "lower(p_brand)",
    "Test Results": "l_returnflag",
}
_SPARK_DATES = {
    "slash": "date_format(o_orderdate, 'yyyy/MM/dd')",
    "dutch": "date_format(o_orderdate, 'dd-MM-yyyy')",
    "iso": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "ship": "date_format(l_shipdate, 'yyyy-MM-dd')",
}
_SQL_DATES = {
    "slash": "strftime(o_orderdate, '%Y/%m/%d')",
    "dutch": "strftime(o_orderdate, '%d-%m-%Y')",
    "iso": "strftime(o_orderdate, '%Y-%m-%d')",
    "ship": "strftime(l_shipdate, '%Y-%m-%d')",
}


def raw_encounters(t: Tables) -> DataFrame:
    """The tables are joined once; a line of status O is made twice."""
    columns = [F.expr(e.format(**_SPARK_DATES)).alias(c) for c, e in RAW_ENCOUNTER.items()]
    copies = F.when(F.col("l_linestatus") == "O", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return _lines(t).select(*columns, F.explode(copies).alias("_copy")).drop("_copy")


_RAW_ENCOUNTER_SQL = ", ".join('{} AS "{}"'.format(e.format(**_SQL_DATES), c) for c, e in RAW_ENCOUNTER.items())
RAW_ENCOUNTERS_SQL = f"""
raw_lines AS (SELECT {_RAW_ENCOUNTER_SQL}, l_linestatus FROM {LINES_SQL}),
raw_encounters AS (SELECT * EXCLUDE l_linestatus FROM raw_lines
  UNION ALL SELECT * EXCLUDE l_linestatus FROM raw_lines WHERE l_linestatus = 'O')"""

# A catalogue: parts with the number and mean value of the lines that sold them.
def catalogue(t: Tables) -> DataFrame:
    sold = t.lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("ratings_count"),
        F.round(F.sum(F.col("l_quantity").cast("decimal(9,0)")) / F.count(F.lit(1)), 1).cast("decimal(9,1)").alias("rating"),
        F.round(F.sum(F.col("l_discount").cast("decimal(4,2)")) * 100 / F.count(F.lit(1)), 0).cast("int").alias("discount"),
    )
    path = F.concat(
        F.lit('[{"name":"Home"},{"name":"'),
        F.expr("CASE WHEN p_size <= 10 THEN 'Women' WHEN p_size <= 20 THEN 'Men' WHEN p_size <= 30 THEN 'Unisex Kids' ELSE 'Garden' END"),
        F.lit('"},{"name":"'),
        F.col("p_type"),
        F.expr("CASE WHEN p_size = 41 THEN '\"' ELSE '\"}]' END"),
    )
    return t.part.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("category"),
        F.coalesce("rating", F.lit(0)).cast("decimal(9,1)").alias("rating"),
        F.coalesce("ratings_count", F.lit(0)).alias("ratings_count"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("initial_price"),
        "discount",
        path.alias("breadcrumbs"),
    )


CATALOGUE_SQL = """
sold AS (SELECT l_partkey, COUNT(*) AS ratings_count,
  ROUND(CAST(SUM(CAST(l_quantity AS DECIMAL(9,0))) / COUNT(*) AS DECIMAL(38,8)), 1) AS rating,
  CAST(ROUND(CAST(SUM(CAST(l_discount AS DECIMAL(4,2))) * 100 / COUNT(*) AS DECIMAL(38,8)), 0) AS INTEGER) AS discount
  FROM lineitem GROUP BY l_partkey),
catalogue AS (SELECT p_partkey AS product_id, p_name AS title, p_brand AS category,
  CAST(COALESCE(rating, 0) AS DECIMAL(9,1)) AS rating, COALESCE(ratings_count, 0) AS ratings_count,
  CAST(p_retailprice AS DECIMAL(12,2)) AS initial_price, discount, p_size, p_type
  FROM part LEFT JOIN sold ON p_partkey = l_partkey)"""
