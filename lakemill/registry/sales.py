"""Sales, store and staff questions (Q18 to Q39)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.functions.numbers import money
from lakemill.operators import audit, clean
from lakemill.plans import sales
from lakemill.registry import entry, roles
from lakemill.registry.cleaning import IDENTITY_SQL, identities
from lakemill.registry.roles import RAW_CUSTOMERS_SQL, SALES_SQL
from lakemill.registry.sql import REVENUE, SHOP, big, day, dbl, mean, month
from lakemill.sources import files


@entry(
    "Q18",
    f"""WITH {SHOP}, s AS (SELECT customer_id, SUM(total_amount) AS spent FROM shop_orders GROUP BY 1)
  SELECT ROW_NUMBER() OVER (ORDER BY spent DESC, customer_id) AS place, customer_id, customer_name, {dbl("spent")} AS total_spent
  FROM s JOIN customers USING (customer_id) QUALIFY place <= 3""",
)
def spend_leaders(t):
    return sales.spend_leaders(roles.orders(t), roles.customers(t))


@entry(
    "Q19",
    f"""WITH {SHOP} SELECT order_id, product_name, {big("quantity")} AS quantity, {dbl("unit_price")} AS unit_price, {dbl("discount * 100")} AS discount_percent,
  {dbl(f"ROUND({REVENUE}, 2)")} AS net_revenue FROM items JOIN products USING (product_id)""",
)
def line_net_revenue(t):
    return sales.line_net_revenue(roles.items(t), roles.products(t)).drop("product_id")


@entry(
    "Q20",
    f"""WITH {RAW_CUSTOMERS_SQL} SELECT 'customers' AS table_name, COUNT(*) AS row_count, COUNT(*) FILTER (email IS NULL) AS null_count FROM raw_customers
  UNION ALL SELECT 'products', COUNT(*), COUNT(*) FILTER (p_name IS NULL) FROM part
  UNION ALL SELECT 'orders', COUNT(*), COUNT(*) FILTER (o_custkey IS NULL) FROM orders
  UNION ALL SELECT 'order_items', COUNT(*), COUNT(*) FILTER (l_partkey IS NULL) FROM lineitem""",
)
def table_audit(t):
    return audit.null_audit(
        {
            "customers": (roles.raw_customers(t), "email"),
            "products": (t.part, "p_name"),
            "orders": (t.orders, "o_custkey"),
            "order_items": (t.lineitem, "l_partkey"),
        }
    )


@entry(
    "Q21",
    f"""WITH {SHOP} SELECT {month("order_date")} AS month, COUNT(*) AS orders, {dbl("SUM(total_amount)")} AS revenue FROM shop_orders
  WHERE status <> 'P' GROUP BY 1""",
)
def monthly_orders(t):
    return sales.monthly_orders(roles.orders(t), "P")


@entry(
    "Q22",
    """SELECT o_orderkey, CASE WHEN p < 1000 THEN 'Budget' WHEN p BETWEEN 1000 AND 3000 THEN 'Mid-Range' ELSE 'Premium' END AS price_tier
  FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) / 100 AS p FROM orders)""",
)
def price_tiers(t):
    price = (money(F.col("o_totalprice")) / 100).cast("double")
    return t.orders.select("o_orderkey", sales.price_tier(price).alias("price_tier"))


@entry(
    "Q23",
    "SELECT COUNT(*) FILTER (o_orderstatus = 'F') AS delivered, COUNT(*) FILTER (o_orderstatus <> 'F') AS not_delivered FROM orders",
)
def state_split(t):
    return sales.state_split(roles.orders(t), "F")


@entry(
    "Q24",
    f"WITH {SALES_SQL} SELECT row_id, order_id, customer_id, {dbl('sales')} AS sales FROM sales WHERE sales > (SELECT SUM(sales) / COUNT(*) FROM sales)",
)
def above_mean(t):
    return sales.above_mean(roles.sales(t))


@entry(
    "Q25",
    f"""WITH {SALES_SQL} SELECT customer_id, customer_name, order_id, row_id, {dbl("sales")} AS sales FROM sales s JOIN customers USING (customer_id)
  WHERE sales = (SELECT MAX(i.sales) FROM sales i WHERE i.customer_id = s.customer_id)""",
)
def largest_lines(t):
    return sales.largest_lines(roles.sales(t), roles.customers(t))


@entry("Q26", f"WITH {SALES_SQL} SELECT customer_id, customer_name, {dbl('total_sales')} AS total_sales FROM totals")
def customer_totals(t):
    return sales.customer_totals(roles.sales(t), roles.customers(t))


@entry(
    "Q27",
    f"""WITH {SALES_SQL} SELECT customer_id, customer_name, {dbl("total_sales")} AS total_sales FROM totals
  WHERE total_sales * (SELECT COUNT(*) FROM totals) > (SELECT SUM(total_sales) FROM totals)""",
)
def totals_above_mean(t):
    return sales.totals_above_mean(roles.sales(t), roles.customers(t))


@entry(
    "Q28",
    f"""WITH {SALES_SQL} SELECT customer_id, customer_name, {dbl("total_sales")} AS total_sales, RANK() OVER (ORDER BY total_sales DESC) AS sales_rank FROM totals""",
)
def customer_ranks(t):
    return sales.customer_ranks(roles.sales(t), roles.customers(t))


@entry(
    "Q29",
    f"""WITH {SALES_SQL} SELECT row_id, order_id, customer_id, {day("order_date")} AS order_date, {dbl("sales")} AS sales,
  ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY sales.order_date, row_id) AS order_seq_num FROM sales""",
)
def line_sequence(t):
    return sales.line_sequence(roles.sales(t)).withColumn("order_date", F.to_date("order_date"))


@entry(
    "Q30",
    f"""WITH {SALES_SQL}, r AS (SELECT *, DENSE_RANK() OVER (ORDER BY total_sales DESC) AS sales_rank FROM totals)
  SELECT customer_id, customer_name, {dbl("total_sales")} AS total_sales, sales_rank FROM r WHERE sales_rank <= 3""",
)
def leading_customers(t):
    return sales.leading_customers(roles.sales(t), roles.customers(t))


@entry(
    "Q31",
    f"""WITH {SALES_SQL}, r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY total_sales DESC, customer_id) AS a, ROW_NUMBER() OVER (ORDER BY total_sales, customer_id) AS b FROM totals)
  SELECT 'top' AS side, a AS place, customer_id, customer_name, {dbl("total_sales")} AS total_sales FROM r WHERE a <= 5
  UNION ALL SELECT 'bottom', b, customer_id, customer_name, {dbl("total_sales")} FROM r WHERE b <= 5""",
)
def extreme_customers(t):
    return sales.extreme_customers(roles.sales(t), roles.customers(t))


@entry(
    "Q32",
    f"""WITH {SALES_SQL}, dealt AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN 1 + o_orderkey % 1500 ELSE o_custkey END AS customer_id, o_orderkey AS order_id FROM orders)
  SELECT customer_id, customer_name, COUNT(DISTINCT order_id) AS order_count FROM dealt JOIN customers USING (customer_id)
  GROUP BY 1, 2 HAVING COUNT(DISTINCT order_id) = 1""",
)
def single_order_customers(t):
    """All orders; those of a third of the customers are dealt to others, so that some have one only."""
    dealt = F.when(F.col("o_custkey") % 3 == 0, 1 + F.col("o_orderkey") % 1500).otherwise(F.col("o_custkey"))
    orders = t.orders.select(dealt.alias("customer_id"), F.col("o_orderkey").alias("order_id"))
    return sales.with_order_count(orders, roles.customers(t))


NAMESAKE = "'Customer ' || c_mktsegment || ' ' || c_nationkey"


@entry(
    "Q33",
    f"""WITH {SALES_SQL} SELECT {NAMESAKE} AS customer_name, {dbl("MAX(sales)")} AS highest_order_value FROM sales JOIN customer ON c_custkey = customer_id GROUP BY 1""",
)
def largest_line_by_name(t):
    """Customers named after their segment and nation, so that names are shared."""
    named = t.customer.select(F.col("c_custkey").alias("customer_id"), F.expr(NAMESAKE).alias("customer_name"))
    return sales.largest_line_by_name(roles.sales(t), named)


LINE_REVENUE = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


@entry(
    "Q34",
    f"""WITH x AS (SELECT p_type, ROUND({LINE_REVENUE}, 2) AS revenue FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA')
  SELECT p_type AS product_category, COUNT(*) AS num_transactions, {mean("SUM(revenue)", "COUNT(*)")} AS avg_revenue, {dbl("SUM(revenue)")} AS total_revenue,
  {dbl("MIN(revenue)")} AS min_revenue, {dbl("MAX(revenue)")} AS max_revenue FROM x GROUP BY 1""",
)
def region_categories(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    homes = t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    revenue = money(F.col("l_extendedprice")) * (1 - F.col("l_discount").cast("decimal(4,2)"))
    rows = (
        t.lineitem.join(homes, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("r_name").alias("region"), F.col("p_type").alias("product_category"), F.round(revenue, 2).alias("revenue"))
    )
    return sales.region_categories(rows, "ASIA")


@entry("Q35", "SELECT l_suppkey AS city, COUNT(*) AS count FROM lineitem GROUP BY 1 HAVING COUNT(*) > 600")
def busy_places(t):
    return sales.busy_places(t.lineitem.select(F.col("l_suppkey").alias("city")), "city", 600)


@entry(
    "Q36",
    f"""WITH {IDENTITY_SQL} SELECT transaction_date AS store_id, {dbl("SUM(COALESCE(sale_amount, 0))")} AS total_revenue FROM one GROUP BY 1""",
)
def store_totals(t):
    return clean.store_totals(identities(t).withColumn("store_id", F.col("transaction_date")), ["row_no"])


@entry(
    "Q37",
    f"""SELECT c_mktsegment AS department, COUNT(*) AS headcount, {mean("SUM(CAST(c_acctbal AS DECIMAL(12,2)))", "COUNT(*)")} AS avg_salary FROM customer GROUP BY 1""",
)
def salary_by_department(t):
    return sales.salary_by_department(
        t.customer.select(F.col("c_mktsegment").alias("department"), money(F.col("c_acctbal")).alias("salary"))
    )


STAFF = {
    "emp_id": "CAST(o_orderkey AS STRING)",
    "name": "'staff ' || o_orderkey",
    "department": "o_orderpriority",
    "country": "o_orderstatus",
    "age": "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_custkey AS INT) END",
    "salary": "o_totalprice",
    "join_date": "CASE WHEN o_orderpriority = '5-LOW' THEN 'soon' ELSE {iso} END",
    "status": "CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 'Left' ELSE 'Active' END",
    "email": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'e@example.com' END",
}
_STAFF_SQL = ", ".join(f"{e.format(iso=day('o_orderdate'))} AS {c}" for c, e in STAFF.items())


@entry(
    "Q38",
    f"""WITH s AS (SELECT {_STAFF_SQL} FROM orders) SELECT emp_id AS employee_id, name, department, country, CAST(COALESCE(age, 0) AS BIGINT) AS age, salary,
  CASE WHEN join_date <> 'soon' THEN join_date END AS join_date, COALESCE(status, 'Unknown') AS status FROM s
  WHERE email IS NOT NULL AND COALESCE(status, 'Unknown') = 'Active' AND salary > 60000""",
)
def active_staff(t):
    source = t.scratch("q38-csv")
    iso = "date_format(o_orderdate, 'yyyy-MM-dd')"
    files.write_csv(t.orders.selectExpr(*[f"{e.format(iso=iso)} AS {c}" for c, e in STAFF.items()]), source)
    return sales.export_active_staff(t.spark, source, t.scratch("q38"))


@entry(
    "Q39",
    "SELECT p_partkey AS user_id, CAST(p_size AS BIGINT) AS age, p_type AS subscription FROM part WHERE p_size BETWEEN 18 AND 30 AND p_type = 'PROMO'",
)
def young_subscribers(t):
    users = t.part.select(F.col("p_partkey").alias("user_id"), F.col("p_size").alias("age"), F.col("p_type").alias("subscription"))
    return sales.young_subscribers(users, tier="PROMO")
