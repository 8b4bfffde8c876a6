"""Cleaning on small fixtures: the edge cases of orders, items, encounters and sales files."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemill.functions import dates, nested, numbers, text
from lakemill.operators import audit, clean, quantiles, statistics
from lakemill.operators.dedupe import repeated_members, repeated_rows

ENCOUNTER_COLUMNS = [
    "Name", "Age", "Gender", "Blood Type", "Medical Condition", "Date of Admission", "Doctor", "Hospital",
    "Insurance Provider", "Billing Amount", "Room Number", "Admission Type", "Discharge Date", "Medication", "Test Results",
]


def encounter(**changes):
    row = dict(zip(ENCOUNTER_COLUMNS, [
        " mary o'neil-jones\t", "61", "female", "ab-", "asthma", "2023/11/05", "dr. lee", "north  clinic", "acme care",
        "-120.456", "7", "urgent", "2023-11-09", "aspirin", "normal",
    ]))
    return tuple({**row, **changes}.values())


def encounters(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"`{c}` string" for c in ENCOUNTER_COLUMNS))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_encounters_are_standardised_then_deduplicated_then_dropped(spark):
    raw = encounters(spark, encounter(), encounter(), encounter(Name=None), encounter(**{"Date of Admission": "05.11.2023"}))
    row = one(clean.clean_encounters(raw))
    assert row["Name"] == "Mary O'Neil-Jones"
    assert row["Doctor"] == "Dr. Lee"
    assert row["Blood Type"] == "Ab-"
    assert row["Date of Admission"] == dt.date(2023, 11, 5)
    assert row["Billing Amount"] == Decimal("120.46")
    assert row["_dq_negative_billing"] is True
    counts = one(clean.clean_encounters_counts(raw)).asDict()
    assert counts == {
        "row_count": 4, "duplicate_count": 1, "null_count": 2, "invalid_date_count": 1, "invalid_billing_count": 4,
    }


def test_absent_columns_are_skipped(spark):
    raw = encounters(spark, encounter()).drop("Age", "Discharge Date", "Gender")
    assert one(clean.clean_encounters(raw))["Room Number"] == 7


ORDER = "order_id string, customer_id string, order_date string, status string"


def test_orders(spark):
    raw = spark.createDataFrame(
        [
            ("a", "  ", "2024-03-01 10:00:00", "placed "),
            ("b", "c1", "05-03-2024", "SHIPPED"),
            ("c", "c2", "2999-01-01 00:00:00", "lost"),
            ("d", None, "never", None),
        ],
        ORDER,
    )
    rows = {r.order_id: r for r in clean.clean_orders(raw, "2024-06-01").collect()}
    assert rows["a"].customer_id is None and rows["a"].customer_id_missing and rows["a"].status == "PLACED"
    assert rows["b"].order_date == dt.datetime(2024, 3, 5)
    assert rows["c"].is_future_dated and not rows["a"].is_future_dated
    assert rows["d"].order_date is None and rows["d"].is_future_dated is False
    assert one(clean.clean_orders_counts(raw, "2024-06-01")).asDict() == {
        "orders_missing_customer_id": 2, "orders_wrong_date_format": 1, "orders_unparseable_dates": 1,
        "orders_future_dated": 1, "orders_invalid_status": 2,
    }


def test_items(spark):
    raw = spark.createDataFrame(
        [
            ("i1", "o1", "2", "10", "150", " red bolt"),
            ("i2", "ghost", "1", "20", "0", "x"),
            ("i3", "o1", "0", "10", "-3", "x"),
            ("i4", "o2", "-3", "10", None, "x"),
            ("i5", "o2", "many", "10", "25.5", None),
        ],
        "item_id string, order_id string, quantity string, unit_price string, discount_percent string, product_name string",
    )
    orders = spark.createDataFrame([("o1",), ("o2",), ("o2",)], "order_id string")
    rows = {r.item_id: r for r in clean.clean_items(raw, orders).collect()}
    assert set(rows) == {"i1", "i3", "i4", "i5"}
    assert rows["i1"].discount_percent == 100 and rows["i1"].discount_percent_flagged_invalid
    assert rows["i3"].discount_percent == 0 and rows["i3"].quantity == 0 and not rows["i3"].is_return
    assert rows["i4"].is_return and rows["i4"].discount_percent is None and not rows["i4"].discount_percent_flagged_invalid
    assert rows["i5"].quantity is None and rows["i5"].is_return is False and rows["i5"].product_name is None
    assert rows["i1"].product_name == "Red Bolt"
    assert [r.item_id for r in clean.orphans(raw, orders, "order_id").collect()] == ["i2"]
    assert tuple(one(clean.clean_items_counts(raw, orders))) == (1, 1, 1, 2)


def test_products_keep_the_first_row(spark):
    raw = spark.createDataFrame(
        [(2, "p1", "B", "c", "s", "2"), (1, "p1", " a-b ", "c", "s", "x"), (3, "p2", "Ok", "C", "S", "-1")],
        "place int, product_id string, product_name string, category string, subcategory string, cost_price string",
    )
    rows = {r.product_id: r for r in clean.clean_products(raw, ["place"]).collect()}
    assert rows["p1"].product_name == "A-B" and rows["p1"].cost_price is None
    assert tuple(one(clean.clean_products_counts(raw))) == (1, 1, 1, 1)


@pytest.mark.parametrize(
    "email, valid",
    [("a@b.co", True), (" a@b.co ", True), ("a@b", False), ("a b@c.de", False), ("a@@c.de", False), ("", False), (None, False)],
)
def test_email(spark, email, valid):
    df = spark.createDataFrame([(1, email)], "customer_id int, email string")
    assert one(df.select(text.is_email(F.col("email")).alias("v"))).v is valid
    assert clean.invalid_emails(df).count() == (0 if valid else 1)


# The small sales file (price and quantity with gaps, two rows twice) and its
# cleaned form.
SALES = """1001,Widget A,Hardware,12.5,4
1002,Widget B,Hardware,9.99,2
1003,Gadget X,Electronics,45.0,
1001,Widget A,Hardware,12.5,4
1005,Gadget Y,Electronics,,3
1006,Tool Z,Hardware,22.0,1
1007,Gadget X,Electronics,45.0,2
1008,Widget C,Hardware,15.75,
1009,Gadget Y,Electronics,60.0,1
1006,Tool Z,Hardware,22.0,1
1011,Widget B,Hardware,9.99,5
1012,Gadget Z,Electronics,,2"""
SALES_TOTALS = {
    1001: 50.0, 1002: 19.98, 1003: 45.0, 1005: 135.0, 1006: 22.0, 1007: 90.0, 1008: 15.75, 1009: 60.0, 1011: 49.95, 1012: 90.0,
}


def sales_file(spark):
    rows = [line.split(",") for line in SALES.splitlines()]
    typed = [(int(a), b, c, float(p) if p else None, int(q) if q else None) for a, b, c, p, q in rows]
    return spark.createDataFrame(typed, "order_id int, product string, category string, price double, quantity int")


def test_sales_file(spark):
    raw = sales_file(spark)
    assert one(repeated_rows(raw)).duplicate_rows == 2
    assert repeated_members(raw).count() == 4
    assert {r.order_id: round(r.total_amount, 2) for r in clean.clean_sales(raw).collect()} == SALES_TOTALS
    nulls = {r.column_name: r.missing_count for r in statistics.null_summary(raw).collect()}
    assert nulls == {"price": 2, "quantity": 2}
    assert one(statistics.null_cells(raw)).missing_cells == 4


def test_group_median_leaves_rows_without_a_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", None), (None, None), (None, 9.0)], "g string, v double")
    filled = clean.fill_with_group_median(df, "g", "v").collect()
    assert sorted((r.g or "", r.v or 0) for r in filled) == [("", 0), ("", 9.0), ("a", 1.0), ("a", 2.5), ("a", 4.0)]


def test_medians_interpolate_and_the_approximate_one_does_not(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (10,)], "v int")
    assert one(clean.exact_median(df, "v")).median == 3.0
    assert clean.approximate_median(df, "v", 0.0) == 2


def test_identities(spark):
    raw = spark.createDataFrame(
        [
            (1, "u1", "d1", None, None, 20, "e", "n"),
            (2, "u1", "d1", 5.0, "ok", 90, "e", "n"),
            (3, "u2", "d1", 5.0, "ok", None, "e", "n"),
            (4, "u3", "d1", 5.0, "ok", 30, None, "n"),
            (5, "u4", "d1", 5.0, "ok", 40, "e", "  "),
        ],
        "row_no int, user_id string, transaction_date string, sale_amount double, status string, age int, email string, username string",
    )
    kept = clean.clean_identities(raw, {"sale_amount": 0.0, "status": "Unknown"}, "age", ["row_no"])
    rows = {r.row_no: r for r in kept.collect()}
    assert set(rows) == {1, 3}
    assert rows[1].sale_amount == 0.0 and rows[1].status == "Unknown"
    assert rows[3].age == 30


def test_price_text(spark):
    df = spark.createDataFrame([('"₹3,995.00"', 1.0), ("N/A", 2.0), ("Not Available", 3.0), (" 12 ", 4.0)], "p string, f double")
    assert [float(r.p) for r in clean.clean_price(df, "p", "f").collect()] == [3995.0, 2.0, 3.0, 12.0]


@pytest.mark.parametrize(
    "value, length, department",
    [
        ('[{"name":"Home"},{"name":"Men"},{"name":"Women"}]', 3, "Men"),
        ('[{"name":"Home"}]', 1, "Home & Other"),
        ("[]", 0, "Home & Other"),
        ("{broken", 0, "Unknown"),
        ("Not Available", 0, "Unknown"),
        (None, 0, "Unknown"),
    ],
)
def test_json_lists(spark, value, length, department):
    df = spark.createDataFrame([(value,)], "v string")
    row = one(df.select(nested.list_length(F.col("v")).alias("n"), nested.first_listed(F.col("v")).alias("d")))
    assert (row.n, row.d) == (length, department)


@pytest.mark.parametrize("age, band", [(0, None), (1, "0-18"), (18, "0-18"), (19, "19-30"), (75, "61-75"), (120, "76+"), (121, None), (None, None)])
def test_buckets(spark, age, band):
    from lakemill.plans.marts import AGE_EDGES, AGE_LABELS

    df = spark.createDataFrame([(age,)], "age int")
    assert one(df.select(numbers.bucket(F.col("age"), AGE_EDGES, AGE_LABELS).alias("b"))).b == band


def test_title_case_follows_letters(spark):
    words = ["smith-jones", "o'NEIL", "ab-", "x1y", "élan vital", "a\tb\nc", "", "3rd st.", "ßtraße"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r.t for r in df.select(text.title_case(F.col("w")).alias("t")).collect()] == [w.title() for w in words]


def test_numbers(spark):
    df = spark.createDataFrame([(1.005, None, 5, 0)], "a double, n decimal(18,2), cur int, prev int")
    row = one(
        df.select(
            numbers.round_half_up(F.col("a")).alias("r"),
            numbers.clip(F.col("n"), 0, 100).alias("c"),
            numbers.percent_change(F.col("cur"), F.col("prev")).alias("p"),
            numbers.ratio(F.col("cur"), F.col("prev")).alias("q"),
        )
    )
    assert row.r == Decimal("1.01") and row.c is None and row.p is None and row.q is None


def test_elapsed_days_are_cut(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 0, 1), dt.datetime(2024, 1, 1, 23, 0))], "a timestamp, b timestamp")
    row = one(df.select(dates.elapsed_days(F.col("a"), F.col("b")).alias("d"), F.datediff("a", "b").alias("c")))
    assert (row.d, row.c) == (0, 1)


def test_previous_span():
    assert dates.previous_span("2024-06-08", "2024-06-14") == ("2024-06-01", "2024-06-07")


def test_keys_tell_nulls_apart(spark):
    from lakemill.functions.keys import md5_key

    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    found = df.select(md5_key([F.col("x"), F.col("y"), F.col("z")]).alias("k")).distinct()
    assert found.count() == 2


def test_checks(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(ValueError, match="not_empty"):
        audit.require(audit.check_bronze(empty), "bronze")
    with pytest.raises(ValueError, match="gold check failed: none"):
        audit.require(audit.check_gold({"some": spark.range(1), "none": empty}), "gold")
    with pytest.raises(ValueError):
        audit.check_gold({})


def test_silver_check_finds_two_current_rows(spark):
    rows = spark.createDataFrame([("k", True, 1), ("k", True, 2), ("j", False, 3)], "encounter_key string, is_current boolean, x int")
    status = {r.check_name: r.failures for r in audit.check_silver(rows, ["x", "gone"]).collect()}
    assert status["one_current_row_per_key"] == 1 and status["critical gone"] == 1 and status["critical x"] == 0


def test_null_passes_a_value_rule_but_not_an_expectation(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    assert one(audit.rule_audit(df, {"positive": F.col("v") > 0})).violations == 1
    assert audit.keep_expected(df, {"positive": F.col("v") > 0}).count() == 1


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "v double")
    rows = statistics.histogram(df, F.col("v"), 4).orderBy("bin").collect()
    assert [r.row_count for r in rows] == [5, 0, 0, 0]


def test_small_costs_are_kept(spark):
    rows = [(1, "1", "a", "b", "c", "0.004"), (2, "2", "a", "b", "c", "-0.004"), (3, "3", "a", "b", "c", "x"), (4, "4", "a", "b", "c", "0")]
    raw = spark.createDataFrame(rows, "place int, product_id string, product_name string, category string, subcategory string, cost_price string")
    costs = {r.product_id: r.cost_price for r in clean.clean_products(raw, ["place"]).collect()}
    assert [None if costs[k] is None else float(costs[k]) for k in "1234"] == [0.004, -0.004, None, 0.0]
    counts = clean.clean_products_counts(raw).first()
    assert (counts.products_nonpositive_cost_price, counts.products_invalid_cost_price) == (2, 1)


def test_quantiles_by_sketch(spark):
    rows = spark.range(30_000).selectExpr("id % 3 AS g", "IF(id % 50 = 0, NULL, (id * 7919) % 30000) AS v").unionAll(spark.createDataFrame([(9, None)], "g long, v long"))
    for error in (0.05, 0.001):
        got = {r.g: r.q for r in quantiles.approximate_quantiles(rows, ["g"], "v", [0.1, 0.5, 1.0], error, "q").collect()}
        assert set(got) == {0, 1, 2}
        for g, found in got.items():
            values = sorted(r.v for r in rows.where(f"g = {g} AND v IS NOT NULL").collect())
            for p, v in zip([0.1, 0.5, 1.0], found):
                assert v in values and abs(values.index(v) + 1 - p * len(values)) <= error * len(values) + 1
