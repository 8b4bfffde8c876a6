"""Cleaning and data quality (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.functions import dates, numbers
from lakemill.functions.keys import md5_key
from lakemill.functions.numbers import money, round_half_up
from lakemill.operators import audit, clean
from lakemill.operators import statistics
from lakemill.operators.rows import beside
from lakemill.operators.sampling import top
from lakemill.plans import layers
from lakemill.registry import entry, roles
from lakemill.registry.aggregates import NULL_SUMMARY_SQL, parsed_items
from lakemill.registry.roles import (
    AS_OF,
    RAW_CUSTOMERS_SQL,
    RAW_ENCOUNTERS_SQL,
    RAW_ITEMS_SQL,
    RAW_ORDERS_SQL,
    RAW_PRODUCTS_SQL,
)
from lakemill.registry.scalars import PRICES_SQL, prices
from lakemill.registry.sql import big, day, dbl, half_up, moment, ratio, strip, title
from lakemill.session import settle


@entry("D01", NULL_SUMMARY_SQL)
def missing_values(t):
    return statistics.null_summary(parsed_items(t))


@entry(
    "D02",
    """WITH f AS (SELECT l_extendedprice, l_tax, 2.5::DOUBLE AS filled FROM lineitem),
  m AS (SELECT 'l_extendedprice' AS column_name, AVG(l_extendedprice) AS mean, quantile_cont(l_extendedprice, 0.5) AS median FROM f
    UNION ALL SELECT 'l_tax', AVG(l_tax), quantile_cont(l_tax, 0.5) FROM f UNION ALL SELECT 'filled', AVG(filled), quantile_cont(filled, 0.5) FROM f)
  SELECT * FROM m WHERE abs(mean - median) < 1e-6 AND mean <> floor(mean)""",
)
def suspected_fills(t):
    """A column filled with one broken number is found; measured columns are not."""
    filled = t.lineitem.select("l_extendedprice", "l_tax", F.lit(2.5).alias("filled"))
    return clean.suspected_fills(filled, ["l_extendedprice", "l_tax", "filled"])


HOLES = "CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey < 12 THEN NULL ELSE c_acctbal END"


def holed(t):
    return t.customer.select("c_custkey", "c_mktsegment", F.expr(HOLES).alias("c_acctbal"))


@entry(
    "D03",
    f"""WITH h AS (SELECT c_custkey, {HOLES} AS b FROM customer)
  SELECT c_custkey, {half_up("COALESCE(b, (SELECT quantile_cont(b, 0.5) FROM h))", 4)} AS c_acctbal FROM h""",
)
def fill_medians(t):
    filled = clean.fill_with_medians(holed(t), ["c_acctbal"])
    return filled.select("c_custkey", round_half_up(F.col("c_acctbal"), 4).alias("c_acctbal"))


@entry("D04", f"WITH {RAW_CUSTOMERS_SQL} SELECT customer_id, COALESCE(email, 'Not Available') AS email FROM raw_customers")
def fill_placeholder(t):
    return clean.fill_text(roles.raw_customers(t), ["email"]).select("customer_id", "email")


GROUP_HOLES = "CASE WHEN c_nationkey < 3 THEN NULL ELSE c_acctbal END"


@entry(
    "D05",
    f"""WITH h AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS seg, {GROUP_HOLES} AS b FROM customer)
  SELECT c_custkey, seg, {half_up("COALESCE(b, CASE WHEN seg IS NOT NULL THEN quantile_cont(b, 0.5) OVER (PARTITION BY seg) END)", 4)} AS balance FROM h""",
)
def fill_group_medians(t):
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("seg"),
        F.expr(GROUP_HOLES).alias("balance"),
    )
    filled = clean.fill_with_group_median(rows, "seg", "balance")
    return filled.withColumn("balance", round_half_up(F.col("balance"), 4))


@entry(
    "D06",
    f"""WITH {RAW_ITEMS_SQL} SELECT order_id, product_id, COALESCE(discount_percent, '0') AS discount_percent,
  COALESCE(TRY_CAST(quantity AS BIGINT), 1) AS quantity FROM raw_items""",
)
def fill_constants(t):
    filled = parsed_items(t).fillna({"discount_percent": "0", "quantity": 1})
    return filled.select("order_id", "product_id", "discount_percent", "quantity")


@entry(
    "D07",
    f"""WITH {RAW_ITEMS_SQL}, p AS (SELECT order_id, product_id, TRY_CAST(quantity AS BIGINT) AS quantity, discount_percent FROM raw_items)
  SELECT 'subset' AS rule, COUNT(*) AS row_count, {big("SUM(quantity)")} AS units FROM p WHERE quantity IS NOT NULL
  UNION ALL SELECT 'any', COUNT(*), {big("SUM(quantity)")} FROM p WHERE quantity IS NOT NULL AND discount_percent IS NOT NULL""",
)
def drop_nulls(t):
    rows = parsed_items(t)

    def counted(df, rule):
        return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("units")).withColumn("rule", F.lit(rule))

    return counted(rows.dropna(subset=["quantity"]), "subset").unionByName(counted(rows.dropna(), "any"))


PARSED_PRICE = (
    "COALESCE(TRY_CAST(replace(replace(replace(COALESCE(price, 'Not Available'), '₹', ''), ',', ''), '\"', '') AS DECIMAL(18,2)), "
    "CAST(o_totalprice AS DECIMAL(18,2)) + 1)"
)


@entry("D08", f"WITH {PRICES_SQL} SELECT o_orderkey, {dbl(PARSED_PRICE)} AS price FROM prices")
def price_with_fallback(t):
    """Missing text is filled before parsing, so a missing price ends as the fallback too."""
    filled = clean.fill_text(prices(t), ["price"]).withColumn("fallback", money(F.col("o_totalprice")) + 1)
    return clean.clean_price(filled, "price", "fallback").select("o_orderkey", "price")


PAIR_SQL = """pair AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS initial_price,
  CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS final_price,
  CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DOUBLE) AS listed FROM lineitem),
dist AS (SELECT *, CAST((initial_price - final_price) * 100 AS DOUBLE) / CAST(initial_price AS DOUBLE) AS computed FROM pair),
gap AS (SELECT *, abs(computed - listed) AS mismatch FROM dist)"""


def pairs(t):
    """The price after discount and tax against the listed discount alone."""
    initial = money(F.col("l_extendedprice"))
    off = F.lit(1) - F.col("l_discount").cast("decimal(4,2)") - F.col("l_tax").cast("decimal(4,2)")
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        initial.cast("decimal(18,2)").alias("initial_price"),
        F.round(initial * off, 2).cast("decimal(18,2)").alias("final_price"),
        (F.col("l_discount").cast("decimal(4,2)") * 100).alias("listed"),
    )


@entry(
    "D09",
    f"""WITH {PAIR_SQL} SELECT 0::BIGINT AS place, NULL::BIGINT AS l_orderkey, COUNT(*) FILTER (mismatch > 5) AS mismatches, NULL::DOUBLE AS mismatch FROM gap
  UNION ALL (SELECT ROW_NUMBER() OVER (ORDER BY mismatch DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber) AS place, l_orderkey, NULL, {half_up("mismatch", 4)} AS mismatch
  FROM gap QUALIFY place <= 10)""",
)
def discount_deviation(t):
    checked = clean.with_discount_check(pairs(t), "initial_price", "final_price", "listed")
    mismatch = F.col("discount_mismatch")
    count = checked.agg(F.count_if(mismatch > 5).alias("mismatches")).withColumn("place", F.lit(0).cast("bigint"))
    worst = top(checked, ["discount_mismatch desc", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], 10, "place")
    worst = worst.select("place", "l_orderkey", round_half_up(mismatch, 4).alias("mismatch"))
    return count.unionByName(worst, allowMissingColumns=True)


@entry(
    "D10",
    """WITH k AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL)
  SELECT 'lineitem' AS key_name, CAST(SUM(n) AS BIGINT) AS row_count, 0::BIGINT AS null_keys, COUNT(*) FILTER (n > 1) AS repeated_keys,
  CAST(SUM(n - 1) AS BIGINT) AS extra_rows FROM k""",
)
def primary_key(t):
    return audit.key_audit(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")


@entry(
    "D11",
    f"""WITH {RAW_CUSTOMERS_SQL}, k AS (SELECT split_part(email, '@', 2) AS host FROM raw_customers WHERE email IS NOT NULL)
  SELECT host, COUNT(*) AS row_count FROM k GROUP BY 1 HAVING COUNT(*) > 1""",
)
def unique_column(t):
    hosts = roles.raw_customers(t).select(F.coalesce(F.get(F.split("email", "@"), 1), F.when(F.col("email").isNotNull(), "")).alias("host"))
    return audit.repeated_values(hosts, "host")


@entry(
    "D12",
    f"""WITH {RAW_CUSTOMERS_SQL}, {RAW_ITEMS_SQL}
  SELECT 'customers' AS table_name, COUNT(*) AS row_count, COUNT(*) FILTER (email IS NULL) AS null_count FROM raw_customers
  UNION ALL SELECT 'items', COUNT(*), COUNT(*) FILTER (discount_percent IS NULL) FROM raw_items
  UNION ALL SELECT 'orders', COUNT(*), COUNT(*) FILTER (o_custkey IS NULL) FROM orders""",
)
def not_null(t):
    return audit.null_audit(
        {
            "customers": (roles.raw_customers(t), "email"),
            "items": (roles.raw_items(t), "discount_percent"),
            "orders": (t.orders, "o_custkey"),
        }
    )


@entry(
    "D13",
    f"""WITH {RAW_ITEMS_SQL}, p AS (SELECT TRY_CAST(quantity AS BIGINT) AS q, TRY_CAST(discount_percent AS DECIMAL(18,2)) AS d FROM raw_items)
  SELECT 'quantity > 0' AS rule, COUNT(*) FILTER (NOT q > 0) AS violations FROM p
  UNION ALL SELECT 'discount in 0-100', COUNT(*) FILTER (NOT d BETWEEN 0 AND 100) FROM p
  UNION ALL SELECT 'quantity is small', COUNT(*) FILTER (q NOT IN (1, 2, 3)) FROM p""",
)
def value_rules(t):
    rows = parsed_items(t).withColumn("d", numbers.to_number(F.col("discount_percent")))
    return audit.rule_audit(
        rows,
        {
            "quantity > 0": F.col("quantity") > 0,
            "discount in 0-100": F.col("d").between(0, 100),
            "quantity is small": F.col("quantity").isin(1, 2, 3),
        },
    )


@entry(
    "D14",
    f"""WITH {RAW_ITEMS_SQL} SELECT 'items.order_id' AS reference, COUNT(DISTINCT order_id) AS orphan_keys, COUNT(*) AS orphan_rows
  FROM raw_items WHERE order_id NOT IN (SELECT order_id FROM kept_orders)
  UNION ALL SELECT 'orders.customer', COUNT(DISTINCT o_custkey), COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def foreign_keys(t):
    first = audit.reference_audit(roles.raw_items(t), roles.kept_orders(t), "order_id", "order_id", "items.order_id")
    return first.unionByName(audit.reference_audit(t.orders, t.customer, "o_custkey", "c_custkey", "orders.customer"))


CLEAN_ORDERS_SQL = f"""{RAW_ORDERS_SQL}, clean_orders AS (SELECT order_id, CASE WHEN trim(customer_id) <> '' THEN customer_id END AS customer_id,
  trim(customer_id) = '' AS customer_id_missing, order_date AS given,
  COALESCE(try_strptime(order_date, '%Y-%m-%d %H:%M:%S'), try_strptime(order_date, '%d-%m-%Y')) AS order_date,
  COALESCE(COALESCE(try_strptime(order_date, '%Y-%m-%d %H:%M:%S'), try_strptime(order_date, '%d-%m-%Y')) > TIMESTAMP '{AS_OF}', FALSE) AS is_future_dated,
  upper(trim(status)) AS status FROM raw_orders)"""
ORDER_COUNTS_SQL = """SELECT COUNT(*) FILTER (customer_id_missing) AS orders_missing_customer_id,
  COUNT(*) FILTER (regexp_matches(given, '^\\d{2}-\\d{2}-\\d{4}$')) AS orders_wrong_date_format,
  COUNT(*) FILTER (order_date IS NULL) AS orders_unparseable_dates, COUNT(*) FILTER (is_future_dated) AS orders_future_dated,
  COUNT(*) FILTER (status NOT IN ('PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')) AS orders_invalid_status FROM clean_orders"""


@entry(
    "D15",
    f"""WITH {CLEAN_ORDERS_SQL}, n AS ({ORDER_COUNTS_SQL}) SELECT order_id, customer_id, customer_id_missing, {moment("order_date")} AS order_date,
  is_future_dated, status, n.* FROM clean_orders, n""",
)
def clean_orders(t):
    raw = roles.raw_orders(t)
    counts = clean.clean_orders_counts(raw, AS_OF)
    return beside(clean.clean_orders(raw, AS_OF), counts)


CLEAN_PRODUCTS_SQL = f"""{RAW_PRODUCTS_SQL}, named AS (SELECT product_id, place, product_name AS given, {title(strip('product_name'))} AS product_name,
  {title(strip('category'))} AS category, {title(strip('subcategory'))} AS subcategory, TRY_CAST(cost_price AS DECIMAL(28,10)) AS cost_price FROM raw_products)"""
PRODUCT_COUNTS_SQL = """SELECT COUNT(*) FILTER (given <> product_name) AS products_name_normalized,
  COUNT(*) FILTER (cost_price IS NULL) AS products_invalid_cost_price, COUNT(*) FILTER (cost_price <= 0) AS products_nonpositive_cost_price,
  COUNT(*) - COUNT(DISTINCT product_id) AS products_duplicate_ids_dropped FROM named"""


@entry(
    "D16",
    f"""WITH {CLEAN_PRODUCTS_SQL}, n AS ({PRODUCT_COUNTS_SQL}) SELECT product_id, product_name, category, subcategory, {dbl("cost_price")} AS cost_price, n.*
  FROM named, n QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY place) = 1""",
)
def clean_products(t):
    raw = roles.raw_products(t)
    return beside(clean.clean_products(raw, ["place"]).drop("place"), clean.clean_products_counts(raw))


VALID_EMAIL = "regexp_matches(COALESCE(trim(email), ''), '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')"


@entry("D17", f"WITH {RAW_CUSTOMERS_SQL} SELECT customer_id FROM raw_customers WHERE NOT {VALID_EMAIL}")
def invalid_emails(t):
    return clean.invalid_emails(roles.raw_customers(t))


@entry(
    "D18",
    f"""WITH {RAW_ITEMS_SQL} SELECT order_id, product_id, quantity FROM raw_items r
  WHERE NOT EXISTS (SELECT 1 FROM kept_orders k WHERE k.order_id = r.order_id)""",
)
def orphan_rows(t):
    return clean.orphans(roles.raw_items(t), roles.kept_orders(t), "order_id").select("order_id", "product_id", "quantity")


CLEAN_ITEMS_SQL = f"""{RAW_ITEMS_SQL}, p AS (SELECT order_id, product_id, product_name, TRY_CAST(quantity AS BIGINT) AS quantity,
  CAST(unit_price AS DECIMAL(18,2)) AS unit_price, TRY_CAST(discount_percent AS DECIMAL(18,2)) AS d FROM raw_items
  WHERE order_id IN (SELECT order_id FROM kept_orders))"""


ITEM_COUNTS_SQL = """SELECT (SELECT COUNT(*) FROM raw_items) - COUNT(*) AS order_items_orphans_removed,
    COUNT(*) FILTER (quantity < 0) AS order_items_returns, COUNT(*) FILTER (quantity = 0) AS order_items_zero_quantity,
    COUNT(*) FILTER (d > 100 OR d < 0) AS order_items_invalid_discount FROM p"""


@entry(
    "D19",
    f"""WITH {CLEAN_ITEMS_SQL}, n AS ({ITEM_COUNTS_SQL})
  SELECT order_id, product_id, {title("trim(product_name)")} AS product_name, quantity, COALESCE(quantity < 0, FALSE) AS is_return,
  {dbl("unit_price")} AS unit_price, COALESCE(d > 100 OR d < 0, FALSE) AS discount_percent_flagged_invalid,
  {dbl("CASE WHEN d IS NOT NULL THEN LEAST(GREATEST(d, 0), 100) END")} AS discount_percent, n.* FROM p, n""",
)
def clean_items(t):
    raw, orders = roles.raw_items(t), roles.kept_orders(t)
    return beside(clean.clean_items(raw, orders), clean.clean_items_counts(raw, orders))


@entry(
    "D20",
    f"""WITH {RAW_CUSTOMERS_SQL} SELECT customer_id, {title("trim(customer_name)")} AS customer_name, email, {VALID_EMAIL} AS email_valid FROM raw_customers""",
)
def clean_customers(t):
    return clean.clean_customers(roles.raw_customers(t))


def _date_sql(x):
    tries = ", ".join(f"try_strptime({x}, '{f}')" for f in ("%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y"))
    return f"CAST(COALESCE({tries}) AS DATE)"


STANDARD_SQL = f"""{RAW_ENCOUNTERS_SQL}, std AS (SELECT {title('trim("Name")')} AS "Name", TRY_CAST("Age" AS BIGINT) AS "Age",
  {title('"Medical Condition"')} AS "Medical Condition", {_date_sql('"Date of Admission"')} AS "Date of Admission", {title('"Doctor"')} AS "Doctor",
  {title('"Hospital"')} AS "Hospital", abs(TRY_CAST("Billing Amount" AS DECIMAL(18,2))) AS "Billing Amount",
  COALESCE(TRY_CAST("Billing Amount" AS DECIMAL(18,2)) < 0, FALSE) AS _dq_negative_billing, TRY_CAST("Room Number" AS BIGINT) AS "Room Number",
  {title('"Admission Type"')} AS "Admission Type", {_date_sql('"Discharge Date"')} AS "Discharge Date", {title('"Medication"')} AS "Medication",
  {title('"Test Results"')} AS "Test Results" FROM raw_encounters),
uni AS (SELECT * EXCLUDE _dq_negative_billing, COUNT(*) AS copies, BOOL_OR(_dq_negative_billing) AS neg,
  SUM(CAST("Date of Admission" IS NULL AS INT) + CAST("Discharge Date" IS NULL AS INT)) AS bad, COUNT(*) FILTER (_dq_negative_billing) AS negs FROM std GROUP BY ALL),
kept AS (SELECT * FROM uni WHERE "Name" IS NOT NULL AND "Date of Admission" IS NOT NULL AND "Hospital" IS NOT NULL AND "Billing Amount" IS NOT NULL)"""
SILVER_COUNTS_SQL = """SELECT CAST(SUM(copies) AS BIGINT) AS row_count, CAST(SUM(copies - 1) AS BIGINT) AS duplicate_count,
  COUNT(*) FILTER ("Name" IS NULL OR "Date of Admission" IS NULL OR "Hospital" IS NULL OR "Billing Amount" IS NULL) AS null_count,
  CAST(SUM(bad) AS BIGINT) AS invalid_date_count, CAST(SUM(negs) AS BIGINT) AS invalid_billing_count FROM uni"""


@entry(
    "D21",
    f"""WITH {STANDARD_SQL}, n AS ({SILVER_COUNTS_SQL}) SELECT "Name", "Age", "Medical Condition", {day('"Date of Admission"')} AS "Date of Admission",
  "Doctor", "Hospital", {dbl('"Billing Amount"')} AS "Billing Amount", "Room Number", "Admission Type", {day('"Discharge Date"')} AS "Discharge Date",
  "Medication", "Test Results", neg AS _dq_negative_billing, n.* FROM kept, n""",
)
def clean_encounters(t):
    distinct = settle(clean.distinct_encounters(roles.raw_encounters(t)), "distinct")
    return beside(clean.complete_encounters(distinct), clean.encounter_counts(distinct))


@entry(
    "D22",
    """SELECT 'not_empty' AS check_name, CAST(COUNT(*) = 0 AS BIGINT) AS failures, CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM customer
  UNION ALL SELECT 'lineage_columns', 1, 'FAIL'""",
)
def bronze_check(t):
    """Customers with two of the three lineage columns."""
    rows = t.customer.withColumns({"_ingestion_timestamp": F.current_timestamp(), "_bronze_row_id": F.col("c_custkey")})
    return audit.check_bronze(rows)


@entry(
    "D23",
    f"""WITH {STANDARD_SQL}, f AS (SELECT 'not_empty' AS check_name, CAST(COUNT(*) = 0 AS BIGINT) AS failures FROM std
  UNION ALL SELECT 'critical Name', COUNT(*) FILTER ("Name" IS NULL) FROM std
  UNION ALL SELECT 'critical Date of Admission', COUNT(*) FILTER ("Date of Admission" IS NULL) FROM std
  UNION ALL SELECT 'critical Hospital', 0 UNION ALL SELECT 'critical Billing Amount', COUNT(*) FILTER ("Billing Amount" IS NULL) FROM std
  UNION ALL SELECT 'version_columns', 3 UNION ALL SELECT 'no_negative_amount', 0
  UNION ALL SELECT 'one_current_row_per_key', COUNT(*) FILTER (n > 1) FROM (SELECT "Name", "Hospital", COUNT(*) AS n FROM std GROUP BY 1, 2) g)
  SELECT check_name, failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM f""",
)
def silver_check(t):
    """Rows that are standardised but not yet cleaned, keyed by name and hospital."""
    rows = clean.standardise_encounters(roles.raw_encounters(t)).withColumns(
        {"encounter_key": md5_key([F.col("Name"), F.col("Hospital")]), "is_current": F.lit(True)}
    )
    return audit.check_silver(rows, clean.CRITICAL_COLUMNS, clean.BILLING)


@entry(
    "D24",
    """SELECT 'orders' AS check_name, CAST(COUNT(*) = 0 AS BIGINT) AS failures, CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM orders
  UNION ALL SELECT 'none', CAST(COUNT(*) = 0 AS BIGINT), CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END FROM orders WHERE o_orderstatus = 'X'""",
)
def gold_check(t):
    return audit.check_gold({"orders": t.orders, "none": t.orders.filter("o_orderstatus = 'X'")})


RUN_RECORD_SQL = f"""WITH {STANDARD_SQL.replace("{", "{{").replace("}", "}}")}, n AS ({SILVER_COUNTS_SQL}) SELECT row_count + {{broken}} AS source_row_count, row_count AS bronze_row_count, {{broken}} AS malformed_count, duplicate_count, null_count,
  invalid_date_count, invalid_billing_count, (SELECT COUNT(*) FROM lineitem) AS silver_total_count,
  (SELECT COUNT(*) FROM lineitem WHERE l_linestatus = 'O') AS silver_current_count, (SELECT COUNT(*) FROM lineitem WHERE l_linestatus <> 'O') AS silver_historical_count,
  'PASS' AS scd2_validation, 8::BIGINT AS gold_tables_count, '{{gold}}' AS gold_validation, 'PASS' AS overall_status FROM n"""


@entry("D25", RUN_RECORD_SQL.format(gold="PENDING", broken="0::BIGINT"))
def run_metrics(t):
    """The rows are counted in the pass that cleans them."""
    counts = settle(clean.clean_encounters_counts(roles.raw_encounters(t)), "counts")
    rows = counts.first().row_count
    record = layers.layer_metrics(t.spark, rows, rows, counts, roles.encounters(t), 8, {"scd2": "PASS"})
    return record.drop("timestamp")


@entry("D26", f"WITH {CLEAN_ORDERS_SQL} SELECT order_id, given AS order_date FROM clean_orders WHERE given IS NOT NULL AND order_date IS NULL")
def failed_to_parse(t):
    parsed = dates.parse_timestamp(F.col("order_date"), dates.ORDER_TIME_LAYOUTS)
    return audit.unparsed(roles.raw_orders(t), "order_date", parsed).select("order_id", "order_date")


@entry(
    "D27",
    f"""WITH {RAW_ITEMS_SQL}, p AS (SELECT TRY_CAST(quantity AS BIGINT) AS q, TRY_CAST(discount_percent AS DECIMAL(18,2)) AS d FROM raw_items),
  x AS (SELECT 'has_quantity' AS expectation, q IS NOT NULL AS ok FROM p UNION ALL SELECT 'discount_in_range', COALESCE(d BETWEEN 0 AND 100, FALSE) FROM p
    UNION ALL SELECT 'kept', q IS NOT NULL AND COALESCE(d BETWEEN 0 AND 100, FALSE) FROM p)
  SELECT expectation, COUNT(*) FILTER (ok) AS passed, COUNT(*) FILTER (NOT ok) AS failed FROM x GROUP BY 1""",
)
def expectations(t):
    rows = parsed_items(t).withColumn("d", numbers.to_number(F.col("discount_percent")))
    rules = {"has_quantity": F.col("quantity").isNotNull(), "discount_in_range": F.col("d").between(0, 100)}
    counts = audit.expectation_counts(rows, rules)
    kept = audit.keep_expected(rows, rules).agg(F.count(F.lit(1)).alias("passed"))
    total = rows.agg(F.count(F.lit(1)).alias("n"))
    last = beside(kept, total).select(
        F.lit("kept").alias("expectation"), "passed", (F.col("n") - F.col("passed")).alias("failed")
    )
    return counts.unionByName(last)


IDENTITY = """o_orderkey AS row_no, CAST(o_custkey AS STRING) AS user_id, o_orderpriority AS transaction_date,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS sale_amount,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_custkey % 5 = 0 THEN 20 WHEN o_custkey % 5 = 4 THEN 60 ELSE 40 END AS age,
  CASE WHEN o_custkey < 40 THEN NULL ELSE 'u@example.com' END AS email,
  CASE WHEN o_custkey BETWEEN 50 AND 60 THEN '   ' ELSE 'user' END AS username"""


def identities(t):
    return t.orders.selectExpr(*roles.parts(IDENTITY))


IDENTITY_SQL = f"""ids AS (SELECT {IDENTITY} FROM orders),
one AS (SELECT * FROM ids QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, transaction_date ORDER BY row_no) = 1)"""


@entry(
    "D28",
    f"""WITH {IDENTITY_SQL} SELECT row_no, user_id, transaction_date, {dbl("COALESCE(sale_amount, 0)")} AS sale_amount,
  COALESCE(status, 'Unknown') AS status, COALESCE(age, (SELECT quantile_disc(age, 0.5) FROM one))::BIGINT AS age FROM one WHERE email IS NOT NULL AND trim(username) <> ''""",
)
def clean_identities(t):
    """A fourth of the ages is missing; most others are equal, so that the approximate median is the exact one."""
    kept = clean.clean_identities(identities(t), {"sale_amount": 0.0, "status": "Unknown"}, "age", ["row_no"])
    return kept.select("row_no", "user_id", "transaction_date", "sale_amount", "status", "age")


SALES_FILE_SQL = """f AS (SELECT l_orderkey AS order_id, l_returnflag AS category, CASE WHEN l_tax = 0.08 THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS quantity FROM lineitem),
d AS (SELECT * FROM f UNION ALL SELECT * FROM f WHERE category = 'A'),
p AS (SELECT order_id, category, COALESCE(price, quantile_cont(price, 0.5) OVER (PARTITION BY category)) AS price, COALESCE(quantity, 1) AS quantity FROM d)"""


@entry(
    "D29",
    f"""WITH {SALES_FILE_SQL} SELECT DISTINCT order_id, category, {half_up("price", 4)} AS price, quantity, {half_up("price * quantity", 4)} AS total_amount FROM p""",
)
def clean_sales(t):
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_returnflag").alias("category"),
        F.when(F.col("l_tax") != 0.08, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("bigint")).alias("quantity"),
    )
    cleaned = clean.clean_sales(rows.unionByName(rows.filter("category = 'A'")))
    return cleaned.withColumns({c: round_half_up(F.col(c), 4) for c in ("price", "total_amount")})
