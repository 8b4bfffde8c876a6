"""Shop questions (Q01 to Q17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.plans import shop
from lakemill.registry import entry, roles
from lakemill.registry.sql import REVENUE, SHOP, big, day, dbl, half_up, moment, month, percent, ratio


ORDER_REVENUE = f"""{SHOP},
order_value AS (SELECT o.order_id, customer_id, order_date, status, SUM({REVENUE}) AS revenue
  FROM shop_orders o JOIN items i ON i.order_id = o.order_id GROUP BY ALL),
customer_value AS (SELECT customer_id, SUM(revenue) AS revenue FROM order_value GROUP BY 1)"""


def money(x):
    return dbl(f"ROUND({x}, 2)")


@entry("Q01", f"WITH {SHOP} SELECT category, {money(f'SUM({REVENUE})')} AS total_revenue FROM items JOIN products USING (product_id) GROUP BY 1")
def category_revenue(t):
    return shop.category_revenue(roles.items(t), roles.products(t))


@entry(
    "Q02",
    f"""WITH {ORDER_REVENUE} SELECT ROW_NUMBER() OVER (ORDER BY revenue DESC, customer_id) AS place, customer_id, customer_name,
  {money("revenue")} AS total_order_value FROM customer_value JOIN customers USING (customer_id) QUALIFY place <= 10""",
)
def top_customers(t):
    return shop.top_customers(roles.orders(t), roles.items(t), roles.customers(t))


@entry(
    "Q03",
    f"""SELECT {month("o_orderdate")} AS year_month, COUNT(DISTINCT o_orderkey) AS order_count FROM orders
  WHERE o_orderdate >= (SELECT MAX(o_orderdate) FROM orders) - INTERVAL 12 MONTH GROUP BY 1""",
)
def recent_months(t):
    return shop.recent_months(roles.orders(t))


RARE = "CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderstatus ELSE 'O' END"


@entry(
    "Q04",
    f"""WITH s AS (SELECT o_custkey, {RARE} AS status FROM orders) SELECT DISTINCT o_custkey AS customer_id, c_name AS customer_name
  FROM s JOIN customer ON c_custkey = o_custkey WHERE o_custkey NOT IN (SELECT o_custkey FROM s WHERE status = 'F')""",
)
def never_delivered(t):
    """Only urgent orders can be delivered here, so that some customers have none."""
    orders = t.orders.select(F.col("o_custkey").alias("customer_id"), F.expr(RARE).alias("status"))
    return shop.never_in_state(orders, roles.customers(t), "F")


FLOW = f"""{SHOP}, flow AS (SELECT product_id, SUM(CASE WHEN quantity > 0 THEN quantity ELSE 0 END) AS bought,
  SUM(CASE WHEN quantity < 0 THEN -quantity ELSE 0 END) AS back, SUM(abs(quantity)) AS total FROM items GROUP BY 1)"""


@entry(
    "Q05",
    f"""WITH {FLOW} SELECT product_id, product_name, {big("bought")} AS units_purchased, {big("back")} AS units_returned
  FROM flow JOIN products USING (product_id) WHERE back > bought""",
)
def mostly_returned(t):
    return shop.mostly_returned(roles.items(t), roles.products(t))


@entry(
    "Q06",
    f"""WITH {FLOW} SELECT category, {big("SUM(back)")} AS total_returned, {big("SUM(total)")} AS total_units,
  {percent("SUM(back)", "SUM(total)")} AS return_rate_percent FROM flow JOIN products USING (product_id) GROUP BY 1""",
)
def return_rates(t):
    return shop.return_rates(roles.items(t), roles.products(t))


@entry(
    "Q07",
    f"""WITH {ORDER_REVENUE}, d AS (SELECT r_name AS region_code, CAST(order_date AS DATE) AS d, SUM(revenue) AS revenue FROM order_value
    JOIN customer ON c_custkey = customer_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2)
  SELECT region_code, {day("d")} AS order_date, {money("revenue")} AS daily_revenue,
  {money("SUM(revenue) OVER (PARTITION BY region_code ORDER BY d)")} AS running_total FROM d""",
)
def region_running_total(t):
    return shop.region_running_total(roles.region_orders(t), roles.items(t))


@entry(
    "Q08",
    f"""WITH {SHOP}, v AS (SELECT category, product_id, product_name, SUM({REVENUE}) AS revenue FROM items JOIN products USING (product_id) GROUP BY ALL)
  SELECT category, product_id, product_name, {money("revenue")} AS total_revenue,
  RANK() OVER (PARTITION BY category ORDER BY revenue DESC) AS rank_in_category FROM v""",
)
def product_ranks(t):
    return shop.product_ranks(roles.items(t), roles.products(t))


@entry(
    "Q09",
    f"""WITH m AS (SELECT DISTINCT o_custkey AS customer_id, o_orderdate AS order_date FROM orders),
  g AS (SELECT *, LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date) AS previous FROM m),
  s AS (SELECT *, date_sub('day', previous, order_date) AS days_gap FROM g)
  SELECT customer_id, {moment("order_date")} AS order_date, {moment("previous")} AS previous_order_date, days_gap,
  CASE WHEN AVG(days_gap) OVER (PARTITION BY customer_id) > 30 THEN 'At Risk' ELSE 'Healthy' END AS risk_flag FROM s""",
)
def order_gaps(t):
    return shop.order_gaps(roles.orders(t))


@entry(
    "Q10",
    f"""WITH {ORDER_REVENUE}, m AS (SELECT customer_id, {month("order_date")} AS year_month, SUM(revenue) AS revenue FROM order_value GROUP BY 1, 2)
  SELECT year_month, CASE WHEN revenue > 10000 THEN 'High' WHEN revenue >= 5000 THEN 'Medium' ELSE 'Low' END AS revenue_category,
  COUNT(DISTINCT customer_id) AS customer_count FROM m GROUP BY 1, 2""",
)
def revenue_bands(t):
    return shop.revenue_bands(roles.orders(t), roles.items(t))


@entry(
    "Q11",
    f"""WITH {ORDER_REVENUE}, q AS (SELECT *, NTILE(4) OVER (ORDER BY revenue DESC, customer_id) AS quartile FROM customer_value)
  SELECT customer_id, {money("revenue")} AS total_value, quartile, ['Platinum', 'Gold', 'Silver', 'Bronze'][quartile] AS quartile_label FROM q""",
)
def value_quartiles(t):
    return shop.value_quartiles(roles.orders(t), roles.items(t))


@entry(
    "Q12",
    f"""WITH {ORDER_REVENUE}, m AS (SELECT year(order_date) AS y, month(order_date) AS m, SUM(revenue) AS revenue FROM order_value GROUP BY 1, 2)
  SELECT c.y AS year, c.m AS month, {money("c.revenue")} AS revenue, {money("p.revenue")} AS prev_year_revenue,
  {half_up(ratio("c.revenue - p.revenue", "p.revenue") + " * 100")} AS yoy_growth_percent FROM m c LEFT JOIN m p ON p.y = c.y - 1 AND p.m = c.m""",
)
def year_over_year(t):
    return shop.year_over_year(roles.orders(t), roles.items(t))


@entry(
    "Q13",
    f"""WITH {SHOP}, l AS (SELECT customer_id, order_date, order_id, product_id, category FROM shop_orders JOIN items USING (order_id) JOIN products USING (product_id)),
  w AS (SELECT DISTINCT customer_id, FIRST_VALUE(category) OVER f AS a, LAST_VALUE(category) OVER f AS b FROM l WINDOW f AS
    (PARTITION BY customer_id ORDER BY order_date, order_id, product_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  SELECT customer_id, a AS first_category, b AS most_recent_category, CASE WHEN a <> b THEN 'Yes' ELSE 'No' END AS category_shift FROM w""",
)
def category_shift(t):
    return shop.category_shift(roles.orders(t), roles.items(t), roles.products(t))


@entry(
    "Q14",
    f"""WITH {ORDER_REVENUE}, s AS (SELECT *, SUM(revenue) OVER (ORDER BY revenue DESC, customer_id) AS reached, SUM(revenue) OVER () AS total FROM customer_value)
  SELECT customer_id, {money("revenue")} AS revenue, {money("reached")} AS cumulative_revenue, {percent("reached", "total")} AS cumulative_percent FROM s""",
)
def cumulative_share(t):
    return shop.cumulative_share(roles.orders(t), roles.items(t))


@entry(
    "Q15",
    f"""WITH r AS (SELECT o_custkey AS id, date_trunc('month', MIN(o_orderdate)) AS cohort FROM orders GROUP BY 1),
  a AS (SELECT DISTINCT o_custkey AS id, date_trunc('month', o_orderdate) AS m FROM orders),
  x AS (SELECT cohort, date_diff('month', cohort, m) AS k FROM r JOIN a USING (id)),
  s AS (SELECT cohort, COUNT(*) AS size FROM r GROUP BY 1)
  SELECT {month("cohort")} AS cohort_month, size AS cohort_size, {", ".join(f"COUNT(*) FILTER (k = {i}) AS month_{i}_active" for i in range(4))},
  {", ".join(f"{percent(f'COUNT(*) FILTER (k = {i})', 'size')} AS retention_month_{i}_pct" for i in range(1, 4))}
  FROM x JOIN s USING (cohort) WHERE k >= 0 GROUP BY cohort, size""",
)
def cohort_retention(t):
    first = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.min("o_orderdate").alias("registration_date"))
    return shop.cohort_retention(first, roles.orders(t))


@entry(
    "Q16",
    f"""WITH {ORDER_REVENUE}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS seq FROM order_value)
  SELECT a.customer_id, {money("a.revenue")} AS first_order_value, {money("b.revenue")} AS second_order_value, {money("b.revenue - a.revenue")} AS value_change
  FROM n a JOIN n b ON a.customer_id = b.customer_id AND a.seq = 1 AND b.seq = 2 WHERE b.revenue > a.revenue""",
)
def better_second_order(t):
    return shop.better_second_order(roles.orders(t), roles.items(t))


SPAN = ("1998-04-01", "1998-06-30", "1997-12-31", "1998-03-31")


def _span_sql(name, start, end):
    """A span and its totals; the end day is inside."""
    inside = f"order_date >= TIMESTAMP '{start}' AND order_date < TIMESTAMP '{end}' + INTERVAL 1 DAY"
    return (
        f"{name} AS (SELECT COUNT(*) AS total_orders, ROUND(COALESCE(SUM(revenue), 0), 2) AS total_revenue, "
        f"COUNT(DISTINCT customer_id) AS unique_customers FROM order_value WHERE {inside})"
    )


BEST_SQL = f"""best AS (SELECT product_id, product_name, SUM({REVENUE}) AS revenue FROM items JOIN products USING (product_id) JOIN shop_orders USING (order_id)
  WHERE order_date >= TIMESTAMP '{SPAN[0]}' AND order_date < TIMESTAMP '{SPAN[1]}' + INTERVAL 1 DAY GROUP BY 1, 2),
placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY revenue DESC, product_id) AS place FROM best)"""


def _changes():
    return ", ".join(
        f"{half_up(ratio(f'n.{c} - p.{c}', f'p.{c}') + ' * 100')} AS {c}_change_pct" for c in ("total_orders", "total_revenue", "unique_customers")
    )


@entry(
    "Q17",
    f"""WITH {ORDER_REVENUE}, {_span_sql("n", *SPAN[:2])}, {_span_sql("p", *SPAN[2:])}, {BEST_SQL}
  SELECT n.total_orders, {dbl("n.total_revenue")} AS total_revenue, n.unique_customers, p.total_orders AS previous_total_orders,
  {dbl("p.total_revenue")} AS previous_total_revenue, p.unique_customers AS previous_unique_customers, {_changes()},
  {", ".join(f"(SELECT product_name FROM placed WHERE place = {i}) AS top_{i}_product, (SELECT {money('revenue')} FROM placed WHERE place = {i}) AS top_{i}_revenue" for i in (1, 2, 3))},
  '{SPAN[0]}' AS "start", '{SPAN[1]}' AS "end", '{SPAN[2]}' AS previous_start, '{SPAN[3]}' AS previous_end FROM n, p""",
)
def span_report(t):
    """The equal span before a quarter of 91 days starts on the last day of the year before."""
    return shop.span_report(roles.orders(t), roles.items(t), roles.products(t), SPAN[0], SPAN[1])
