"""Window functions (W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.functions import dates
from lakemill.functions.numbers import money, percent, round_half_up
from lakemill.operators.dedupe import one_per_key
from lakemill.operators.ordered import end_values, numbered, ranked, scan, tiled
from lakemill.operators.rows import beside
from lakemill.operators.statistics import group_medians_on_rows
from lakemill.registry import entry, roles
from lakemill.registry.sql import big, dbl, half_up, moment, percent as percent_sql
from lakemill.session import settle


TOTALS = """t AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders GROUP BY 1)"""


def totals(t):
    price = money(F.col("o_totalprice"))
    return settle(t.orders.groupBy("o_custkey").agg(F.sum(price).alias("total")))


@entry("W01", f"WITH {TOTALS} SELECT o_custkey, {dbl('total')} AS total, RANK() OVER (ORDER BY total DESC) AS rank FROM t")
def rank_all(t):
    return ranked(totals(t), [], ["total desc"], "rank")


@entry(
    "W02",
    """SELECT p_partkey, p_type, p_size, RANK() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS rank FROM part""",
)
def rank_in_group(t):
    return ranked(t.part.select("p_partkey", "p_type", "p_size"), ["p_type"], ["p_size desc"], "rank")


@entry(
    "W03",
    """SELECT p_partkey, p_type, p_size, DENSE_RANK() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS rank FROM part
  QUALIFY rank <= 3""",
)
def dense_rank_to(t):
    placed = ranked(t.part.select("p_partkey", "p_type", "p_size"), ["p_type"], ["p_size desc"], "rank", dense=True)
    return placed.filter("rank <= 3")


@entry(
    "W04",
    "SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq FROM orders",
)
def row_number(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return numbered(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "seq").drop("o_orderdate")


@entry(
    "W05",
    f"""SELECT l_suppkey, l_partkey, {big("SUM(l_quantity)")} AS units,
  ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY SUM(l_quantity) DESC, l_partkey) AS place FROM lineitem GROUP BY 1, 2""",
)
def row_number_of_groups(t):
    sums = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("units"))
    return numbered(settle(sums), ["l_suppkey"], ["units desc", "l_partkey"], "place")


@entry("W06", f"WITH {TOTALS} SELECT o_custkey, ROW_NUMBER() OVER (ORDER BY total DESC, o_custkey) AS rank FROM t")
def positions(t):
    return numbered(totals(t), [], ["total desc", "o_custkey"], "rank").drop("total")


@entry(
    "W07",
    f"""WITH g AS (SELECT event_id, user_id, ts, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
  SELECT event_id, user_id, {moment("before")} AS previous_ts, date_sub('day', before, ts) AS days_gap FROM g""",
)
def lag(t):
    spaced = scan(t.events.select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"], previous={"previous_ts": "ts"})
    return spaced.select("event_id", "user_id", "previous_ts", dates.elapsed_days(F.col("ts"), F.col("previous_ts")).alias("days_gap"))


@entry(
    "W08",
    "SELECT event_id, user_id, LEAD(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events",
)
def lead(t):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    return scan(rows, ["user_id"], ["ts", "event_id"], following={"next_type": "event_type"}).drop("ts", "event_type")


@entry("W09", f"WITH {TOTALS} SELECT o_custkey, NTILE(4) OVER (ORDER BY total DESC, o_custkey) AS quartile FROM t")
def ntile(t):
    return tiled(totals(t), ["total desc", "o_custkey"], 4, "quartile").drop("total")


@entry(
    "W10",
    """SELECT o_orderkey, o_custkey, FIRST_VALUE(o_orderpriority) OVER w AS first_priority, LAST_VALUE(o_orderpriority) OVER w AS last_priority
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def first_and_last(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    found = end_values(
        rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], first={"first_priority": "o_orderpriority"}, last={"last_priority": "o_orderpriority"}
    )
    return found.drop("o_orderdate", "o_orderpriority")


@entry(
    "W11",
    f"""SELECT o_orderkey, o_custkey, {dbl('''SUM(CAST(o_totalprice AS DECIMAL(12,2))) OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''')} AS running_total FROM orders""",
)
def running_sum(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", money(F.col("o_totalprice")).alias("price"))
    return scan(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], totals={"running_total": "price"}).drop("o_orderdate", "price")


@entry(
    "W12",
    f"""WITH {TOTALS} SELECT o_custkey, {dbl('''SUM(total) OVER (ORDER BY total DESC, o_custkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''')} AS cumulative FROM t""",
)
def cumulative_sum(t):
    return scan(totals(t), [], ["total desc", "o_custkey"], totals={"cumulative": "total"}).drop("total")


@entry(
    "W13",
    f"""WITH {TOTALS} SELECT o_custkey, {dbl("total")} AS total, {dbl("SUM(total) OVER ()")} AS grand_total,
  {percent_sql("total", "SUM(total) OVER ()", 4)} AS share_percent FROM t""",
)
def grand_total(t):
    rows = totals(t)
    whole = rows.agg(F.sum("total").alias("grand_total"))
    return beside(rows, whole).withColumn("share_percent", percent(F.col("total"), F.col("grand_total"), 4))


@entry(
    "W14",
    f"""SELECT o_orderkey, o_orderpriority, {half_up("quantile_cont(o_totalprice, 0.5) OVER (PARTITION BY o_orderpriority)", 4)}
  AS priority_median FROM orders""",
)
def group_median_on_rows(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    found = group_medians_on_rows(rows, "o_orderpriority", "o_totalprice", "m")
    return found.select("o_orderkey", "o_orderpriority", round_half_up(F.col("m"), 4).alias("priority_median"))


@entry(
    "W15",
    """SELECT user_id, event_id, event_type, value FROM events
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def last_per_key(t):
    return one_per_key(t.events.drop("props"), ["user_id"], ["ts", "event_id"], keep="last").drop("ts")
