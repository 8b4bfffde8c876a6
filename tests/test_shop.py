"""Shop answers known in advance."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemill.operators.versions import place_orders
from lakemill.plans import sales, shop

# The rows of a small shop.
CUSTOMERS = [(101, "Aarav"), (102, "Priya"), (103, "Rohan"), (104, "Sneha"), (105, "Vikram"), (106, "Ananya"), (107, "Karan"), (108, "Divya")]
PRODUCTS = [
    (201, "Wireless Earbuds", "Electronics", 1499, 250), (202, "Cotton T-Shirt", "Clothing", 799, 500),
    (203, "Smart Watch", "Electronics", 2999, 150), (204, "Running Shoes", "Clothing", 4599, 120),
    (205, "Bluetooth Speaker", "Electronics", 3499, 200), (206, "Bedsheet Set", "Home", 1299, 300),
    (207, "Laptop Stand", "Electronics", 899, 180), (208, "Cushion Covers (Set)", "Home", 599, 400),
]
ORDERS = [
    (1001, 101, "2024-08-01", "Delivered", 4498), (1002, 102, "2024-08-03", "Delivered", 799), (1003, 103, "2024-08-05", "Shipped", 7498),
    (1004, 101, "2024-08-10", "Delivered", 3499), (1005, 104, "2024-08-12", "Cancelled", 2999), (1006, 105, "2024-08-15", "Delivered", 5898),
    (1007, 106, "2024-08-18", "Pending", 1299), (1008, 103, "2024-08-20", "Delivered", 899), (1009, 107, "2024-08-25", "Shipped", 6098),
    (1010, 108, "2024-08-28", "Delivered", 1598),
]
ITEMS = [
    (1001, 201, 2, 1499, 0), (1001, 207, 1, 899, 10), (1002, 202, 1, 799, 0), (1003, 203, 1, 2999, 0), (1003, 204, 1, 4599, 5),
    (1004, 205, 1, 3499, 0), (1005, 203, 1, 2999, 0), (1006, 201, 1, 1499, 10), (1006, 204, 1, 4599, 5), (1007, 206, 1, 1299, 0),
    (1008, 207, 1, 899, 0), (1009, 205, 1, 3499, 0), (1009, 208, 2, 599, 15), (1010, 206, 1, 1299, 0), (1010, 208, 1, 599, 0),
]


@pytest.fixture(scope="module")
def store(spark):
    orders = spark.createDataFrame(ORDERS, "order_id int, customer_id int, order_date string, status string, total_amount int")
    return {
        "customers": spark.createDataFrame(CUSTOMERS, "customer_id int, customer_name string"),
        "products": spark.createDataFrame(PRODUCTS, "product_id int, product_name string, category string, unit_price int, stock_qty int"),
        "orders": orders.withColumns(
            {"order_date": F.col("order_date").cast("timestamp_ntz"), "total_amount": F.col("total_amount").cast("decimal(12,2)")}
        ),
        "items": spark.createDataFrame(ITEMS, "order_id int, product_id int, quantity int, unit_price int, discount_percent int"),
    }


def test_leaders_and_states(store):
    best = sales.spend_leaders(store["orders"], store["customers"]).orderBy("place").collect()
    assert [(r.customer_name, int(r.total_spent)) for r in best] == [("Rohan", 8397), ("Aarav", 7997), ("Karan", 6098)]
    assert tuple(sales.state_split(store["orders"], "Delivered").first()) == (6, 4)
    delivered = store["orders"].filter("status = 'Delivered'").agg(F.sum("total_amount")).first()[0]
    assert delivered == 17191


def test_price_tiers(store):
    tiers = store["products"].groupBy(sales.price_tier(F.col("unit_price")).alias("tier")).count().collect()
    assert {r.tier: r["count"] for r in tiers} == {"Budget": 3, "Mid-Range": 3, "Premium": 2}


def test_span(store):
    kept = shop.in_span(store["orders"], "2024-08-10", "2024-08-25").filter("status <> 'Cancelled'")
    assert (kept.count(), kept.agg(F.sum("total_amount")).first()[0]) == (5, 17693)


def test_monthly(store):
    assert tuple(sales.monthly_orders(store["orders"], "Cancelled").first()) == ("2024-08", 9, Decimal("32086.00"))


def test_category_revenue(store):
    found = {r.category: float(r.total_revenue) for r in shop.category_revenue(store["items"], store["products"]).collect()}
    expected: dict[str, float] = {}
    kind = {p[0]: p[2] for p in PRODUCTS}
    for _, product, quantity, price, discount in ITEMS:
        expected[kind[product]] = expected.get(kind[product], 0) + quantity * price * (100 - discount) / 100
    assert found == {k: pytest.approx(v) for k, v in expected.items()}


def test_span_report_without_a_period_before(store):
    row = shop.span_report(store["orders"], store["items"], store["products"], "2024-08-01", "2024-08-31").first()
    assert (row.total_orders, row.unique_customers, row.previous_total_orders) == (10, 8, 0)
    assert row.previous_start == "2024-07-01" and row.previous_total_revenue == 0
    assert row.total_revenue_change_pct is None and row.top_1_product == "Running Shoes"


def test_never_delivered(store):
    names = {r.customer_name for r in shop.never_in_state(store["orders"], store["customers"], "Delivered").collect()}
    assert names == {"Sneha", "Ananya", "Karan"}


def test_second_order(store):
    rows = shop.better_second_order(store["orders"], store["items"]).collect()
    assert rows == []  # both customers with two orders spent less the second time


def test_single_order_has_no_gap_and_is_healthy(store):
    rows = [r for r in shop.order_gaps(store["orders"]).collect() if r.customer_id == 102]
    assert [(r.days_gap, r.risk_flag) for r in rows] == [(None, "Healthy")]


def test_placing_an_order(store, spark):
    new_order = spark.createDataFrame([(1011, 102, dt.date(2024, 9, 1), "Pending", 2798)], "order_id int, customer_id int, order_date date, status string, total_amount int")
    new_order = new_order.withColumns({"order_date": F.col("order_date").cast("timestamp_ntz"), "total_amount": F.col("total_amount").cast("decimal(12,2)")})
    new_items = spark.createDataFrame([(1011, 201, 1, 1499, 0), (1011, 206, 1, 1299, 0)], store["items"].schema)
    orders, items, stock = place_orders(store["orders"], store["items"], store["products"], new_order, new_items)
    left = {r.product_id: r.stock_qty for r in stock.collect()}
    assert (orders.count(), items.count(), left[201], left[206], left[203]) == (11, 17, 249, 299, 150)


def test_dense_rank_ties_give_more_rows(spark):
    rows = [(i, i, i, "2024-01-01", v) for i, v in enumerate([50, 50, 40, 30, 30, 20], 1)]
    lines = spark.createDataFrame(rows, "row_id int, order_id int, customer_id int, order_date string, sales int")
    lines = lines.withColumn("sales", F.col("sales").cast("decimal(12,2)"))
    people = lines.select("customer_id", F.concat(F.lit("c"), "customer_id").alias("customer_name"))
    found = sales.leading_customers(lines, people).collect()
    assert sorted((r.customer_id, r.sales_rank) for r in found) == [(1, 1), (2, 1), (3, 2), (4, 3), (5, 3)]


def test_missing_salary_falls_to_the_last_band(spark):
    df = spark.createDataFrame([(None,), (60000.0,), (100000.0,)], "s double")
    assert [r.b for r in df.select(sales.salary_band(F.col("s")).alias("b")).collect()] == ["Low", "Mid", "High"]
