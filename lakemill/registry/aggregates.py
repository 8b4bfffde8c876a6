"""Aggregates (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.functions import dates
from lakemill.functions.numbers import mean_of, money, ratio as ratio_of, round_half_up
from lakemill.operators import dedupe, statistics
from lakemill.operators.clean import exact_median
from lakemill.operators.ordered import numbered
from lakemill.operators.quantiles import approximate_quantiles, medians
from lakemill.registry import entry, roles
from lakemill.registry.roles import RAW_CUSTOMERS_SQL, RAW_ITEMS_SQL, RAW_PRODUCTS_SQL
from lakemill.registry.sql import big, dbl, half_up, mean, month, percent, ratio
from lakemill.session import settle


PRICE = "CAST(o_totalprice AS DECIMAL(12,2))"


@entry("A01", "SELECT COUNT(*) AS total_orders FROM orders")
def count_rows(t):
    return t.orders.agg(F.count("*").alias("total_orders"))


@entry("A02", f"SELECT {dbl(f'SUM({PRICE})')} AS delivered_revenue FROM orders WHERE o_orderstatus = 'F'")
def filtered_sum(t):
    return t.orders.filter(F.col("o_orderstatus") == "F").agg(F.sum(money(F.col("o_totalprice"))).alias("delivered_revenue"))


@entry(
    "A03",
    f"""SELECT MIN(l_extendedprice) AS lowest, MAX(l_extendedprice) AS highest,
  {mean("SUM(CAST(l_extendedprice AS DECIMAL(12,2)))", "COUNT(*)")} AS mean FROM lineitem""",
)
def global_statistics(t):
    price = money(F.col("l_extendedprice"))
    one = t.lineitem.agg(F.min(price).alias("lowest"), F.max(price).alias("highest"), F.sum(price).alias("s"), F.count(price).alias("n"))
    return one.select("lowest", "highest", mean_of(F.col("s"), F.col("n")).alias("mean"))


@entry(
    "A04",
    f"""SELECT o_orderstatus, COUNT(*) AS rows, {dbl(f"SUM({PRICE})")} AS total, {mean(f"SUM({PRICE})", "COUNT(*)")} AS mean,
  MIN(o_totalprice) AS minimum, MAX(o_totalprice) AS maximum FROM orders GROUP BY o_orderstatus""",
)
def grouped(t):
    return statistics.group_summary(t.orders.withColumn("price", money(F.col("o_totalprice"))), ["o_orderstatus"], "price")


@entry("A05", "SELECT l_returnflag, l_linestatus, COUNT(*) AS row_count FROM lineitem GROUP BY ALL")
def grouped_by_two(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("row_count"))


@entry("A06", f"SELECT {month('l_shipdate')} AS month, COUNT(*) AS row_count FROM lineitem GROUP BY 1")
def grouped_by_expression(t):
    return t.lineitem.groupBy(dates.year_month(F.col("l_shipdate")).alias("month")).agg(F.count("*").alias("row_count"))


@entry("A07", "SELECT l_partkey, COUNT(*) AS row_count FROM lineitem GROUP BY l_partkey HAVING COUNT(*) > 30")
def having(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("row_count")).filter("row_count > 30")


@entry(
    "A08",
    "SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1",
)
def distinct_count(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_suppkey").alias("suppliers")
    )


LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax"
    " l_returnflag l_linestatus l_shipdate"
).split()


@entry("A09", " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_values FROM lineitem" for c in LINE_COLUMNS))
def distinct_per_column(t):
    return statistics.distinct_counts(t.lineitem)


@entry(
    "A10",
    f"""SELECT l_partkey, {big("SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)")} AS returned,
  {big("SUM(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END)")} AS kept FROM lineitem GROUP BY 1""",
)
def conditional_sums(t):
    units, back = F.col("l_quantity").cast("bigint"), F.col("l_returnflag") == "R"
    return t.lineitem.groupBy("l_partkey").agg(
        F.sum(F.when(back, units).otherwise(0)).alias("returned"), F.sum(F.when(~back, units).otherwise(0)).alias("kept")
    )


@entry(
    "A11",
    f"""SELECT l_partkey, {half_up(ratio("SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)",
        "SUM(CASE WHEN l_linestatus = 'F' AND l_tax = 0.08 THEN l_quantity ELSE 0 END)"), 4)} AS rate FROM lineitem GROUP BY 1""",
)
def ratio_of_sums(t):
    units = F.col("l_quantity").cast("bigint")
    back = F.sum(F.when(F.col("l_returnflag") == "R", units).otherwise(0))
    base = F.sum(F.when((F.col("l_linestatus") == "F") & (F.col("l_tax") == 0.08), units).otherwise(0))
    sums = t.lineitem.groupBy("l_partkey").agg(back.alias("back"), base.alias("base"))
    return sums.select("l_partkey", round_half_up(ratio_of(F.col("back"), F.col("base")), 4).alias("rate"))


@entry(
    "A12",
    f"""SELECT c_mktsegment, COUNT(*) AS row_count, {percent("COUNT(*)", "(SELECT COUNT(*) FROM customer)")} AS share_percent
  FROM customer GROUP BY 1""",
)
def share_of_total(t):
    return statistics.share_of_rows(t.customer, "c_mktsegment")


@entry(
    "A13",
    f"""SELECT 'all' AS l_returnflag, {half_up("quantile_cont(l_extendedprice, 0.5)", 4)} AS median FROM lineitem
  UNION ALL SELECT l_returnflag, {half_up("quantile_cont(l_extendedprice, 0.5)", 4)} FROM lineitem GROUP BY 1""",
)
def median(t):
    whole = exact_median(t.lineitem, "l_extendedprice").withColumn("l_returnflag", F.lit("all"))
    both = whole.unionByName(medians(t.lineitem, ["l_returnflag"], "l_extendedprice"))
    return both.withColumn("median", round_half_up(F.col("median"), 4))


@entry(
    "A14",
    """WITH q AS (SELECT l_returnflag, unnest([0.25, 0.5, 0.9]) AS probability, unnest(quantile_disc(l_extendedprice, [0.25, 0.5, 0.9])) AS v FROM lineitem GROUP BY 1)
  SELECT l_returnflag, CAST(probability AS DOUBLE) AS probability, v AS quantile, CAST((SELECT COUNT(*) FROM lineitem l WHERE l.l_returnflag = q.l_returnflag AND l_extendedprice <= v) AS BIGINT) AS upto
  FROM q""",
)
def approximate_quantile(t):
    """Per group, by a sketch whose error is below one row at this size, with the rank that each value reaches."""
    points = [0.25, 0.5, 0.9]
    found = approximate_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", points, error=0, name="q")
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in points]).alias("probability"), F.col("q").alias("quantile"))
    rows = found.select("l_returnflag", F.explode(pairs).alias("p")).select("l_returnflag", "p.*")
    ranks = t.lineitem.select("l_returnflag", "l_extendedprice").join(rows, "l_returnflag").groupBy("l_returnflag", "probability")
    return ranks.agg(F.max("quantile").alias("quantile"), F.count_if(F.col("l_extendedprice") <= F.col("quantile")).alias("upto"))


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(c):
    points = ", ".join(f"{half_up(f'quantile_cont({c}, {p})', 4)} AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    return (
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {half_up(f'AVG({c})', 4)} AS mean, "
        f"{half_up(f'stddev_samp({c})', 4)} AS std, MIN({c}) AS min, {points}, MAX({c}) AS max FROM lineitem"
    )


@entry("A15", " UNION ALL ".join(_describe_sql(c) for c in NUMBERS))
def describe_numbers(t):
    found = statistics.describe_numbers(t.lineitem, NUMBERS)
    return found.withColumns({c: round_half_up(F.col(c), 4) for c in ("mean", "std", "q25", "q50", "q75")})


def _text_sql(c):
    return (
        f"SELECT '{c}' AS column_name, (SELECT COUNT({c}) FROM part) AS count, (SELECT COUNT(DISTINCT {c}) FROM part) AS \"unique\", "
        f"{c} AS top, COUNT(*) AS freq FROM part GROUP BY {c} QUALIFY ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) = 1"
    )


@entry("A16", " UNION ALL ".join(f"({_text_sql(c)})" for c in ("p_name", "p_brand", "p_type")))
def describe_texts(t):
    return statistics.describe_texts(t.part, ["p_name", "p_brand", "p_type"])


@entry("A17", "SELECT event_type, COUNT(*) AS count, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, event_type) AS place FROM events GROUP BY 1")
def value_counts(t):
    return numbered(settle(statistics.value_counts(t.events, "event_type")), [], ["count desc", "event_type"], "place")


def _corr_sql():
    cells = [
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {half_up(f'corr({a}, {b})', 6)} AS correlation FROM lineitem"
        for a in NUMBERS
        for b in NUMBERS
    ]
    return " UNION ALL ".join(cells)


@entry("A18", _corr_sql())
def correlation_matrix(t):
    found = statistics.correlations(t.lineitem, NUMBERS)
    return found.withColumn("correlation", round_half_up(F.col("correlation"), 6))


@entry(
    "A19",
    """WITH v AS (SELECT LEAST(o_totalprice, 400000.0) AS v FROM orders),
  e AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM v),
  c AS (SELECT LEAST(CAST(floor((v - lo) * 30 / (hi - lo)) AS BIGINT) + 1, 30) AS bin, COUNT(*) AS n FROM v, e GROUP BY 1),
  b AS (SELECT unnest(range(1, 31)) AS bin)
  SELECT b.bin, CAST(ROUND(CAST(lo + (hi - lo) / 30 * (b.bin - 1) AS DECIMAL(38,8)), 4) AS DOUBLE) AS bin_start,
  CAST(ROUND(CAST(lo + (hi - lo) / 30 * b.bin AS DECIMAL(38,8)), 4) AS DOUBLE) AS bin_end, COALESCE(n, 0) AS row_count
  FROM b CROSS JOIN e LEFT JOIN c ON b.bin = c.bin""",
)
def histogram(t):
    found = statistics.histogram(t.orders, F.col("o_totalprice"), 30, 400000.0)
    return found.withColumns({c: round_half_up(F.col(c), 4) for c in ("bin_start", "bin_end")})


@entry(
    "A20",
    f"""WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
  b AS (SELECT l.l_returnflag, q1, median, q3, l_extendedprice AS v,
    v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag)
  SELECT l_returnflag, {half_up("ANY_VALUE(q1)", 4)} AS q1, {half_up("ANY_VALUE(median)", 4)} AS median, {half_up("ANY_VALUE(q3)", 4)} AS q3,
  MIN(v) FILTER (inside) AS low_whisker, MAX(v) FILTER (inside) AS high_whisker, COUNT(*) FILTER (NOT inside) AS outliers
  FROM b GROUP BY 1""",
)
def box_plot(t):
    found = statistics.box_statistics(t.lineitem, "l_returnflag", "l_extendedprice")
    return found.withColumns({c: round_half_up(F.col(c), 4) for c in ("q1", "median", "q3")})


RAW_ITEM_COLUMNS = ["order_id", "product_id", "product_name", "quantity", "unit_price", "discount_percent"]
PARSED_ITEMS = f"""{RAW_ITEMS_SQL}, parsed AS (SELECT order_id, product_id, product_name,
  TRY_CAST(quantity AS BIGINT) AS quantity, unit_price, discount_percent FROM raw_items)"""


def parsed_items(t):
    return roles.raw_items(t).withColumn("quantity", F.col("quantity").try_cast("bigint"))


NULL_SUMMARY_SQL = f"""WITH {PARSED_ITEMS}, m AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS missing_count, COUNT(*) AS n FROM parsed" for c in RAW_ITEM_COLUMNS)})
  SELECT column_name, missing_count, {percent("missing_count", "n")} AS missing_percent FROM m WHERE missing_count > 0"""


@entry("A21", NULL_SUMMARY_SQL)
def nulls_per_column(t):
    return statistics.null_summary(parsed_items(t))


@entry(
    "A22",
    f"""WITH {PARSED_ITEMS} SELECT {big("SUM(" + " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in RAW_ITEM_COLUMNS) + ")")}
  AS missing_cells FROM parsed""",
)
def null_total(t):
    return statistics.null_cells(parsed_items(t))


TWICE_SQL = """twice AS (SELECT c_nationkey, c_mktsegment, CASE WHEN c_acctbal < 5000 THEN NULL ELSE 'rich' END AS band FROM customer)"""


def twice(t):
    """Customers reduced to three columns, so that rows repeat, nulls included."""
    band = F.when(F.col("c_acctbal") >= 5000, "rich")
    return t.customer.select("c_nationkey", "c_mktsegment", band.alias("band"))


@entry(
    "A23",
    f"""WITH {TWICE_SQL} SELECT {big("SUM(n - 1)")} AS duplicate_rows FROM (SELECT COUNT(*) AS n FROM twice GROUP BY c_nationkey, c_mktsegment, band)
  g""",
)
def duplicates(t):
    return dedupe.repeated_rows(twice(t))


@entry(
    "A24",
    f"""WITH {TWICE_SQL} SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment, band FROM twice
  QUALIFY COUNT(*) OVER (PARTITION BY c_nationkey, c_mktsegment, band) > 1""",
)
def duplicate_members(t):
    return dedupe.repeated_members(twice(t))


@entry("A25", f"SELECT {dbl(f'COALESCE(SUM({PRICE}), 0)')} AS revenue FROM orders WHERE o_orderdate < TIMESTAMP '1990-01-01'")
def empty_sum(t):
    none = t.orders.filter(F.col("o_orderdate") < dates.moment("1990-01-01"))
    return none.agg(F.coalesce(F.sum(money(F.col("o_totalprice"))), F.lit(0)).alias("revenue"))
