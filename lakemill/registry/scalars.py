"""Scalar functions (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.functions import dates, keys, nested, numbers, text
from lakemill.operators.clean import parse_price
from lakemill.plans.catalogue import with_popularity
from lakemill.registry import entry, roles
from lakemill.registry.roles import CATALOGUE_SQL, RAW_CUSTOMERS_SQL, RAW_ITEMS_SQL, RAW_ORDERS_SQL, RAW_PRODUCTS_SQL
from lakemill.registry.sql import REVENUE, SHOP, big, day, dbl, half_up, moment, month, percent, ratio, strip, title



@entry("F01", f"WITH {RAW_PRODUCTS_SQL} SELECT product_id, place, {strip('product_name')} AS product_name, trim(subcategory) AS subcategory FROM raw_products")
def trim(t):
    return roles.raw_products(t).select(
        "product_id", "place", text.strip(F.col("product_name")).alias("product_name"), F.trim("subcategory").alias("subcategory")
    )


@entry("F02", "SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type FROM part")
def case(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("upper_name"), F.lower("p_type").alias("lower_type"))


@entry("F03", f"SELECT doc_id, md5({title('text')}) AS titled, {title('source')} AS source FROM documents")
def title_case(t):
    return t.documents.select(
        "doc_id", F.md5(text.title_case(F.col("text"))).alias("titled"), text.title_case(F.col("source")).alias("source")
    )


@entry(
    "F04",
    """SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name || '-' || p_brand || ' x'), ' '),
  lambda w: upper(w[1]) || w[2:]), ' ') AS name FROM part""",
)
def word_case(t):
    name = F.concat(F.lit(" "), F.col("p_name"), F.lit("-"), F.col("p_brand"), F.lit(" x "))
    return t.part.select("p_partkey", text.word_case(name).alias("name"))


PRICE_TEXT = """CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'N/A' WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN NULL
  ELSE '"₹' || {grouped} || '"' END"""
PRICES_SQL = f"""prices AS (SELECT o_orderkey, o_totalprice, o_orderstatus,
  {PRICE_TEXT.format(grouped="format('{:,.2f}', o_totalprice)")} AS price FROM orders)"""


def prices(t):
    price = F.expr(PRICE_TEXT.format(grouped="format_number(CAST(o_totalprice AS DECIMAL(12,2)), 2)"))
    return t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", price.alias("price"))


@entry("F05", f"WITH {PRICES_SQL} SELECT o_orderkey, replace(replace(replace(price, '₹', ''), ',', ''), '\"', '') AS price FROM prices")
def replace_marks(t):
    return prices(t).select("o_orderkey", text.drop_marks(F.col("price"), ("₹", ",", '"')).alias("price"))


@entry("F06", f"WITH {RAW_ORDERS_SQL} SELECT order_id, CASE WHEN trim(customer_id) <> '' THEN customer_id END AS customer_id FROM raw_orders")
def blank_to_null(t):
    return roles.raw_orders(t).select("order_id", text.blank_to_null(F.col("customer_id")).alias("customer_id"))


@entry("F07", "SELECT p_partkey, p_brand || '/' || p_type || '-01' AS label FROM part")
def concatenate(t):
    return t.part.select("p_partkey", F.concat("p_brand", F.lit("/"), "p_type", F.lit("-01")).alias("label"))


JOINED_TEXT = (
    "CAST(c_custkey AS VARCHAR) || '|' || c_name || '|' || CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) || '|' || "
    "COALESCE(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, '<null>')"
)


def joined_columns():
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return [F.col("c_custkey"), F.col("c_name"), numbers.money(F.col("c_acctbal")), segment]


@entry("F08", f"SELECT c_custkey, {JOINED_TEXT} AS joined FROM customer")
def delimited(t):
    return t.customer.select("c_custkey", keys.joined_text(joined_columns()).alias("joined"))


@entry("F09", f"SELECT c_custkey, md5({JOINED_TEXT}) AS digest FROM customer")
def md5_digest(t):
    return t.customer.select("c_custkey", keys.md5_key(joined_columns()).alias("digest"))


@entry("F10", f"WITH {RAW_ORDERS_SQL} SELECT order_id, {day('''CAST(try_strptime(order_date, '%d-%m-%Y') AS DATE)''')} AS parsed FROM raw_orders")
def parse_date(t):
    return roles.raw_orders(t).select("order_id", dates.parse_date(F.col("order_date"), ["dd-MM-yyyy"]).alias("parsed"))


@entry("F11", f"WITH {RAW_ORDERS_SQL} SELECT order_id, {moment('''try_strptime(order_date, '%Y-%m-%d %H:%M:%S')''')} AS parsed FROM raw_orders")
def parse_timestamp(t):
    return roles.raw_orders(t).select("order_id", dates.parse_timestamp(F.col("order_date")).alias("parsed"))


@entry(
    "F12",
    f"""WITH {RAW_ORDERS_SQL} SELECT order_id,
  {moment("COALESCE(try_strptime(order_date, '%Y-%m-%d %H:%M:%S'), try_strptime(order_date, '%d-%m-%Y'))")} AS parsed FROM raw_orders""",
)
def parse_layouts(t):
    parsed = dates.parse_timestamp(F.col("order_date"), dates.ORDER_TIME_LAYOUTS)
    return roles.raw_orders(t).select("order_id", parsed.alias("parsed"))


@entry("F13", f"SELECT o_orderkey, {month('o_orderdate')} AS year_month FROM orders")
def year_month(t):
    return t.orders.select("o_orderkey", dates.year_month(F.col("o_orderdate")).alias("year_month"))


@entry("F14", "SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders")
def year_and_month(t):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


@entry("F15", f"SELECT event_id, {day('ts')} AS day FROM events")
def to_date(t):
    return t.events.select("event_id", F.to_date("ts").alias("day"))


@entry("F16", f"SELECT l_orderkey, l_partkey, {day('l_shipdate')} AS shipped FROM lineitem")
def iso_date(t):
    return t.lineitem.select("l_orderkey", "l_partkey", dates.iso_date(F.col("l_shipdate")).alias("shipped"))


@entry("F17", f"SELECT o_orderkey, {day('o_orderdate - INTERVAL 13 MONTH')} AS earlier FROM orders")
def shift_months(t):
    return t.orders.select("o_orderkey", F.add_months(F.to_date("o_orderdate"), -13).alias("earlier"))


@entry(
    "F18",
    f"""SELECT o_orderkey, {day("o_orderdate + INTERVAL 30 DAY")} AS later, {day("o_orderdate - INTERVAL 7 DAY")} AS earlier,
  o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-03-31' AS in_span,
  o_orderdate BETWEEN TIMESTAMP '1997-10-03' AND TIMESTAMP '1997-12-31' AS in_span_before FROM orders""",
)
def shift_days(t):
    d = F.to_date("o_orderdate")
    span, before = ("1998-01-01", "1998-03-31"), dates.previous_span("1998-01-01", "1998-03-31")
    return t.orders.select(
        "o_orderkey",
        F.date_add(d, 30).alias("later"),
        F.date_sub(d, 7).alias("earlier"),
        d.between(*[F.lit(x).cast("date") for x in span]).alias("in_span"),
        d.between(*[F.lit(x).cast("date") for x in before]).alias("in_span_before"),
    )


@entry("F19", "SELECT event_id, date_sub('day', TIMESTAMP '2023-12-31 18:00:00', ts) AS days FROM events")
def elapsed(t):
    return t.events.select("event_id", dates.elapsed_days(F.col("ts"), dates.moment("2023-12-31 18:00:00")).alias("days"))


@entry("F20", "SELECT o_orderkey, (year(o_orderdate) * 12 + month(o_orderdate)) - (1995 * 12 + 11) AS months FROM orders")
def month_offset(t):
    start = F.lit("1995-11-20").cast("date")
    return t.orders.select("o_orderkey", dates.months_apart(F.col("o_orderdate"), start).alias("months"))


@entry("F21", "SELECT o_orderkey, o_orderdate > TIMESTAMP '2001-01-01' AS is_future, TRUE AS clock_is_later FROM orders")
def as_of(t):
    """The day is a parameter; the clock itself is only used for lineage."""
    return t.orders.select(
        "o_orderkey",
        (F.col("o_orderdate") > dates.moment(roles.AS_OF)).alias("is_future"),
        (F.current_timestamp() > F.col("o_orderdate").cast("timestamp")).alias("clock_is_later"),
    )


@entry("F22", f"SELECT l_orderkey, l_partkey, {dbl('ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)')} AS rounded FROM lineitem")
def rounded(t):
    product = numbers.money(F.col("l_extendedprice")) * F.col("l_discount").cast("decimal(4,2)")
    return t.lineitem.select("l_orderkey", "l_partkey", numbers.round_half_up(product).alias("rounded"))


@entry("F23", "SELECT c_custkey, abs(c_acctbal) AS balance FROM customer")
def absolute(t):
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("balance"))


@entry(
    "F24",
    f"""WITH {RAW_ITEMS_SQL} SELECT order_id, product_id, {dbl('''CASE WHEN discount_percent IS NOT NULL THEN
  LEAST(GREATEST(CAST(discount_percent AS DECIMAL(18,2)), 0), 100) END''')} AS discount FROM raw_items""",
)
def clipped(t):
    discount = numbers.clip(numbers.to_number(F.col("discount_percent")), 0, 100)
    return roles.raw_items(t).select("order_id", "product_id", discount.alias("discount"))


BASE_SQL = "CASE WHEN c_mktsegment = 'BUILDING' THEN 0 WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_nationkey + 1 END"


@entry(
    "F25",
    f"""WITH b AS (SELECT c_custkey, c_nationkey AS cur, {BASE_SQL} AS prev FROM customer)
  SELECT c_custkey, {half_up(ratio("cur - prev", "prev") + " * 100")} AS change FROM b""",
)
def percent_change(t):
    base = t.customer.select("c_custkey", F.col("c_nationkey").alias("cur"), F.expr(BASE_SQL).alias("prev"))
    return base.select("c_custkey", numbers.percent_change(F.col("cur"), F.col("prev")).alias("change"))


@entry("F26", f"WITH {SHOP} SELECT order_id, product_id, {dbl(f'ROUND({REVENUE}, 2)')} AS net_revenue FROM items")
def net_revenue(t):
    net = numbers.net_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount_percent"))
    return roles.items(t).select("order_id", "product_id", F.round(net, 2).alias("net_revenue"))


POPULAR_SQL = f"""{CATALOGUE_SQL},
means AS (SELECT CAST(SUM(rating) AS DOUBLE) / COUNT(rating) AS m, CAST(SUM(ratings_count) AS DOUBLE) / COUNT(ratings_count) AS c FROM catalogue),
popular AS (SELECT k.*, (CAST(ratings_count AS DOUBLE) * CAST(rating AS DOUBLE) + c * m) / (CAST(ratings_count AS DOUBLE) + c) AS popularity_score
  FROM catalogue k, means)"""


@entry("F27", f"WITH {POPULAR_SQL} SELECT product_id, {half_up('popularity_score', 6)} AS score FROM popular")
def weighted_score(t):
    scored = with_popularity(roles.catalogue(t))
    return scored.select("product_id", numbers.round_half_up(F.col("popularity_score"), 6).alias("score"))


@entry(
    "F28",
    f"""WITH {RAW_PRODUCTS_SQL} SELECT product_id, place, TRY_CAST(cost_price AS DOUBLE) AS price FROM raw_products""",
)
def to_number(t):
    return roles.raw_products(t).select("product_id", "place", numbers.to_number(F.col("cost_price"), scale=10).alias("price"))


@entry(
    "F29",
    f"""WITH {RAW_ITEMS_SQL} SELECT order_id, product_id, TRY_CAST(quantity AS BIGINT) AS quantity,
  {half_up("CAST(unit_price AS DOUBLE) / 7")} AS seventh FROM raw_items""",
)
def to_whole(t):
    seventh = numbers.round_half_up(F.col("unit_price").cast("double") / 7)
    return roles.raw_items(t).select("order_id", "product_id", numbers.to_whole(F.col("quantity")).alias("quantity"), seventh.alias("seventh"))


@entry(
    "F30",
    """SELECT c_custkey, COALESCE(lower(CASE c_mktsegment WHEN 'BUILDING' THEN 'True' WHEN 'MACHINERY' THEN '1' WHEN 'HOUSEHOLD' THEN 'false'
  WHEN 'FURNITURE' THEN NULL ELSE '0' END) IN ('true', '1'), FALSE) AS flag FROM customer""",
)
def to_boolean(t):
    flag = F.expr(
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'True' WHEN 'MACHINERY' THEN '1' WHEN 'HOUSEHOLD' THEN 'false' WHEN 'FURNITURE' THEN NULL ELSE '0' END"
    )
    return t.customer.select("c_custkey", text.is_true_text(flag).alias("flag"))


@entry("F31", f"WITH {RAW_CUSTOMERS_SQL} SELECT customer_id, COALESCE(email, customer_name) AS contact, COALESCE(email, 'none') AS email FROM raw_customers")
def fallback(t):
    return roles.raw_customers(t).select(
        "customer_id", F.coalesce("email", "customer_name").alias("contact"), F.coalesce("email", F.lit("none")).alias("email")
    )


@entry("F32", "SELECT c_custkey, CAST(NULLIF(c_nationkey, 0) AS BIGINT) AS nation FROM customer")
def zero_to_null(t):
    return t.customer.select("c_custkey", F.nullif("c_nationkey", F.lit(0)).alias("nation"))


@entry(
    "F33",
    """SELECT p_partkey, CASE WHEN p_size > 10 AND p_size <= 20 THEN '11-20' WHEN p_size > 20 AND p_size <= 30 THEN '21-30'
  WHEN p_size > 30 AND p_size <= 40 THEN '31-40' END AS band FROM part""",
)
def buckets(t):
    return t.part.select("p_partkey", numbers.bucket(F.col("p_size"), (10, 20, 30, 40), ("11-20", "21-30", "31-40")).alias("band"))


LISTS_SQL = """lists AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN '{bad' WHEN 'user' THEN '{"turn":1}'
  ELSE CAST(to_json(list_transform(string_split(text, ' '), lambda w: {name: w})) AS VARCHAR) END AS words FROM conversations)"""


def lists(t):
    """The words of a turn as a JSON list; for two roles an object or broken text instead."""
    words = F.to_json(F.transform(F.split("text", " "), lambda w: F.struct(w.alias("name"))))
    made = F.when(F.col("role") == "system", "{bad").when(F.col("role") == "user", '{"turn":1}').otherwise(words)
    return t.conversations.select("conv_id", "turn", made.alias("words"))


@entry(
    "F34",
    f"""WITH {LISTS_SQL} SELECT conv_id, turn, CASE WHEN words LIKE '[%' THEN CAST(json_array_length(words) AS BIGINT) ELSE 0 END AS word_count FROM lists""",
)
def list_length(t):
    return lists(t).select("conv_id", "turn", nested.list_length(F.col("words")).alias("word_count"))


DEPARTMENT_SQL = """CASE WHEN p_size = 41 THEN 'Unknown' WHEN p_size <= 10 THEN 'Women' WHEN p_size <= 20 THEN 'Men'
  WHEN p_size <= 30 THEN 'Unisex Kids' ELSE 'Home & Other' END"""


@entry("F35", f"SELECT p_partkey AS product_id, {DEPARTMENT_SQL} AS department FROM part")
def first_listed(t):
    return roles.catalogue(t).select("product_id", nested.first_listed(F.col("breadcrumbs")).alias("department"))
