"""Pieces of SQL shared by the checks."""

from __future__ import annotations


def half_up(x: str, places: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,8)), {places}) AS DOUBLE)"


def ratio(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0))"


def percent(part: str, whole: str, places: int = 2) -> str:
    return half_up(f"{ratio(part, whole)} * 100", places)


def mean(total: str, count: str, places: int = 2) -> str:
    return half_up(ratio(total, count), places)


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def month(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def moment(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def title(x: str) -> str:
    runs = f"regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)')"
    joined = f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || lower(w[2:])), '')"
    # The capital of ß is Ss in title case; DuckDB has the single letter.
    return f"CASE WHEN {x} IS NOT NULL THEN replace(coalesce({joined}, ''), 'ẞ', 'Ss') END"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


# Line revenue and the shop tables as the jobs read them.
REVENUE = (
    "CAST(quantity AS INTEGER) * unit_price * (1 - discount)"
)
SHOP = """
customers AS (SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer),
products AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category FROM part),
shop_orders AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
  o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount FROM orders),
items AS (SELECT l_orderkey AS order_id, l_partkey AS product_id,
  CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price, CAST(l_discount AS DECIMAL(4,2)) AS discount
  FROM lineitem)"""
