"""Sort, limit, sample (L); set operations and duplicates (U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.operators import audit
from lakemill.operators.dedupe import drop_business_duplicates, one_per_key
from lakemill.operators.ordered import numbered
from lakemill.operators.sampling import sample_rows, top
from lakemill.registry import entry
from lakemill.registry.aggregates import TWICE_SQL, twice
from lakemill.registry.sql import dbl


@entry(
    "L01",
    "SELECT c_custkey, c_mktsegment, c_acctbal, ROW_NUMBER() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS position FROM customer",
)
def sorted_rows(t):
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return numbered(rows, [], ["c_mktsegment", "c_acctbal desc", "c_custkey"], "position").orderBy("position")


@entry(
    "L02",
    "SELECT o_orderkey, o_totalprice, ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders QUALIFY place <= 10",
)
def top_k(t):
    return top(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice desc", "o_orderkey"], 10, "place")


@entry(
    "L03",
    """SELECT 'head' AS part, event_id, ROW_NUMBER() OVER (ORDER BY event_id) AS place FROM events QUALIFY place <= 5
  UNION ALL SELECT 'tail', event_id, ROW_NUMBER() OVER (ORDER BY event_id DESC) AS place FROM events QUALIFY place <= 3""",
)
def head_and_tail(t):
    rows = t.events.select("event_id")
    head = top(rows, ["event_id"], 5, "place").withColumn("part", F.lit("head"))
    return head.unionByName(top(rows, ["event_id desc"], 3, "place").withColumn("part", F.lit("tail")))


@entry(
    "L04",
    "SELECT c_custkey, md5('7:' || c_custkey) AS draw, ROW_NUMBER() OVER (ORDER BY draw, c_custkey) AS place FROM customer QUALIFY place <= 5",
)
def sample(t):
    return sample_rows(t.customer.select("c_custkey"), "c_custkey", 5, seed=7)


@entry(
    "U01",
    """SELECT 'customer' AS table_name, COUNT(*) AS row_count, COUNT(*) FILTER (c_name IS NULL) AS null_count FROM customer
  UNION ALL SELECT 'part', COUNT(*), COUNT(*) FILTER (p_name IS NULL) FROM part
  UNION ALL SELECT 'orders', COUNT(*), COUNT(*) FILTER (o_custkey IS NULL) FROM orders
  UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*) FILTER (l_partkey IS NULL) FROM lineitem""",
)
def union_all(t):
    return audit.null_audit(
        {
            "customer": (t.customer, "c_name"),
            "part": (t.part, "p_name"),
            "orders": (t.orders, "o_custkey"),
            "lineitem": (t.lineitem, "l_partkey"),
        }
    )


@entry(
    "U02",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
  UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
)
def append(t):
    left = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    right = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return left.unionByName(right, allowMissingColumns=True)


@entry("U03", "SELECT DISTINCT p_type, p_brand FROM part")
def distinct(t):
    return t.part.select("p_type", "p_brand").distinct()


@entry("U04", f"WITH {TWICE_SQL} SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment, band FROM twice")
def full_duplicates(t):
    return twice(t).dropDuplicates()


@entry(
    "U05",
    """SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM orders
  QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) = 1""",
)
def key_duplicates(t):
    kept = one_per_key(t.orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])
    return kept.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")


@entry("U06", "SELECT text, lang, MIN(doc_id) AS _doc_id FROM documents GROUP BY text, lang")
def business_duplicates(t):
    """Equal texts in a language, whatever their lineage column says; the first id survives."""
    rows = t.documents.select("text", "lang", F.col("doc_id").alias("_doc_id"))
    return drop_business_duplicates(rows, "_doc_id")
