"""Cleaning of raw text tables.

Every cleaner returns the clean rows; the function of the same name with `_counts` returns
the counts of what it found as one row. The order of the steps is part of the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.functions import dates, numbers, text
from lakemill.operators.dedupe import business_columns, named, one_per_key
from lakemill.operators.ordered import same_keys
from lakemill.operators.quantiles import approximate_quantiles, column_quantiles, exact_quantiles
from lakemill.operators.rows import beside, spread
from lakemill.operators.statistics import group_medians_on_rows
from lakemill.session import settle


# The accepted order states, the placeholder for missing text, the marks
# removed from price text, and the columns of a patient encounter.
ORDER_STATES = ("PLACED", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED")
MISSING_TEXT = "Not Available"
PRICE_MARKS = ("₹", ",", '"')
NAME_COLUMNS = ("Name", "Doctor", "Hospital")
LABEL_COLUMNS = (
    "Gender",
    "Blood Type",
    "Medical Condition",
    "Insurance Provider",
    "Admission Type",
    "Medication",
    "Test Results",
)
ENCOUNTER_DATES = ("Date of Admission", "Discharge Date")
ENCOUNTER_WHOLES = ("Age", "Room Number")
BILLING = "Billing Amount"
#: Places that a unit cost keeps; amounts of money have two.
COST_SCALE = 10
NEGATIVE_BILLING = "_dq_negative_billing"
#: What the copies of a row add up to, and the number of its text lineage.
ADDED, TEXTS = ("_copies", "_bad_dates", "_negative"), "_texts"
CRITICAL_COLUMNS = ("Name", "Date of Admission", "Hospital", "Billing Amount")


def flag(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


# Missing values


def fill_with_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric nulls take the exact median of their column."""
    found = column_quantiles(df, columns, [0.5], name="q")
    row = found.agg(*[
        F.max(F.when(F.col("column_name") == c, F.col("q")[0])).alias(f"_median_{i}") for i, c in enumerate(columns)
    ])
    filled = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.col(f"_median_{i}")) for i, c in enumerate(columns)}
    return beside(df, row).withColumns(filled).select(*named(df.columns))


def fill_text(df: DataFrame, columns: Sequence[str], placeholder: str = MISSING_TEXT) -> DataFrame:
    return df.fillna(placeholder, subset=list(columns))


def fill_with_group_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Nulls take the median of the row's group; rows without a group keep null."""
    medians = group_medians_on_rows(df, group, value, "_median")
    filled = F.coalesce(F.col(value).cast("double"), F.col("_median"))
    return medians.withColumn(value, filled).select(*named(df.columns))


def suspected_fills(df: DataFrame, columns: Sequence[str], tolerance: float = 1e-6) -> DataFrame:
    """Columns whose mean equals their median without being whole: a sign of earlier filling."""
    means = df.agg(*[F.avg(F.col(c).cast("decimal(18,6)")).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "mean"
    )
    points = column_quantiles(df, columns, [0.5], name="q")
    both = means.join(F.broadcast(points), "column_name").withColumn("median", F.col("q")[0]).drop("q")
    same = F.abs(F.col("mean") - F.col("median")) < tolerance
    return both.filter(same & (F.col("mean") != F.floor("mean")))


# Prices


def parse_price(c: Column) -> Column:
    """`₹3,995.00` gives 3995.00; text that is no number gives null."""
    return numbers.to_number(text.strip(text.drop_marks(c, PRICE_MARKS)))


def clean_price(df: DataFrame, price: str, fallback: str) -> DataFrame:
    return df.withColumn(price, F.coalesce(parse_price(F.col(price)), F.col(fallback).cast("decimal(18,2)")))


def with_discount_check(df: DataFrame, initial: str, final: str, listed: str) -> DataFrame:
    """Adds the discount amount, the computed percentage, and its distance from the listed one."""
    computed = numbers.ratio((F.col(initial) - F.col(final)) * 100, F.col(initial))
    return df.withColumns(
        {
            "discount_amount": F.col(initial) - F.col(final),
            "computed_discount_pct": computed,
            "discount_mismatch": F.abs(computed - F.col(listed).cast("double")),
        }
    )


# Shop tables


def _orders(raw: DataFrame, as_of: str) -> DataFrame:
    given = F.col("order_date")
    moment = dates.parse_timestamp(text.strip(given), dates.ORDER_TIME_LAYOUTS)
    blank = text.blank_to_null(F.col("customer_id"))
    return raw.withColumns(
        {
            "customer_id": blank,
            "customer_id_missing": blank.isNull(),
            "_other_layout": flag(given.rlike(r"^\d{2}-\d{2}-\d{4}$")),
            "order_date": moment,
            "is_future_dated": flag(moment > F.lit(as_of).cast("timestamp")),
            "status": F.upper(text.strip(F.col("status"))),
        }
    )


def clean_orders(raw: DataFrame, as_of: str) -> DataFrame:
    """Blank customers to null, order dates of two layouts to one type, upper-case states."""
    return _orders(raw, as_of).drop("_other_layout")


def clean_orders_counts(raw: DataFrame, as_of: str) -> DataFrame:
    return _orders(raw, as_of).agg(
        F.count_if("customer_id_missing").alias("orders_missing_customer_id"),
        F.count_if("_other_layout").alias("orders_wrong_date_format"),
        F.count_if(F.col("order_date").isNull()).alias("orders_unparseable_dates"),
        F.count_if("is_future_dated").alias("orders_future_dated"),
        F.count_if(~flag(F.col("status").isin(*ORDER_STATES))).alias("orders_invalid_status"),
    )


def _products(raw: DataFrame) -> DataFrame:
    names = {c: text.title_case(text.strip(F.col(c))) for c in ("product_name", "category", "subcategory")}
    return raw.withColumns(
        {
            **names,
            "_renamed": flag(names["product_name"] != F.col("product_name")),
            "cost_price": numbers.to_number(F.col("cost_price"), COST_SCALE),
        }
    )


def clean_products(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Title-case names, numeric price, and the first row of each product by `order`."""
    return one_per_key(_products(raw).drop("_renamed"), ["product_id"], order)


def clean_products_counts(raw: DataFrame) -> DataFrame:
    per_product = _products(raw).groupBy("product_id").agg(
        F.count_if("_renamed").alias("renamed"),
        F.count_if(F.col("cost_price").isNull()).alias("invalid"),
        F.count_if(F.col("cost_price") <= 0).alias("nonpositive"),
        (F.count(F.lit(1)) - 1).alias("dropped"),
    )
    return per_product.agg(
        F.sum("renamed").alias("products_name_normalized"),
        F.sum("invalid").alias("products_invalid_cost_price"),
        F.sum("nonpositive").alias("products_nonpositive_cost_price"),
        F.sum("dropped").alias("products_duplicate_ids_dropped"),
    )


def invalid_emails(customers: DataFrame) -> DataFrame:
    return customers.filter(~text.is_email(F.col("email"))).select("customer_id")


def clean_customers(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "customer_name": text.title_case(text.strip(F.col("customer_name"))),
            "email_valid": text.is_email(F.col("email")),
        }
    )


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent. Parents are reduced to their keys first."""
    return children.join(parents.select(key).distinct(), key, "left_anti")


def clean_items(raw: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with an order; returns and wrong discounts flagged, discounts limited to 0-100."""
    kept = raw.join(orders.select("order_id").distinct(), "order_id", "left_semi")
    quantity = numbers.to_whole(F.col("quantity"))
    discount = numbers.to_number(F.col("discount_percent"))
    return kept.withColumns(
        {
            "quantity": quantity,
            "is_return": flag(quantity < 0),
            "unit_price": numbers.to_number(F.col("unit_price")),
            "discount_percent_flagged_invalid": flag((discount > 100) | (discount < 0)),
            "discount_percent": numbers.clip(discount, 0, 100),
            "product_name": text.title_case(text.strip(F.col("product_name"))),
        }
    )


def clean_items_counts(raw: DataFrame, orders: DataFrame) -> DataFrame:
    kept = clean_items(raw, orders).agg(
        F.count(F.lit(1)).alias("_kept"),
        F.count_if("is_return").alias("order_items_returns"),
        F.count_if(F.col("quantity") == 0).alias("order_items_zero_quantity"),
        F.count_if("discount_percent_flagged_invalid").alias("order_items_invalid_discount"),
    )
    rows = raw.agg(F.count(F.lit(1)).alias("_rows"))
    return beside(kept, rows).select(
        (F.col("_rows") - F.col("_kept")).alias("order_items_orphans_removed"),
        "order_items_returns",
        "order_items_zero_quantity",
        "order_items_invalid_discount",
    )


# Patient encounters


def standardise_encounters(raw: DataFrame, layouts: Sequence[str] = dates.DATE_LAYOUTS) -> DataFrame:
    """Case, dates, numbers and the sign of the billing amount; absent columns are skipped."""
    changes: dict[str, Column] = {}
    for c in (*NAME_COLUMNS, *LABEL_COLUMNS):
        if c in raw.columns:
            changes[c] = text.title_case(text.strip(F.col(f"`{c}`")))
    for c in ENCOUNTER_DATES:
        if c in raw.columns:
            changes[c] = dates.parse_date(text.strip(F.col(f"`{c}`")), layouts)
    for c in ENCOUNTER_WHOLES:
        if c in raw.columns:
            changes[c] = numbers.to_whole(F.col(f"`{c}`"))
    if BILLING in raw.columns:
        amount = numbers.to_number(F.col(f"`{BILLING}`"))
        changes[BILLING] = F.abs(amount)
        changes[NEGATIVE_BILLING] = flag(amount < 0)
    return raw.withColumns(changes)


def distinct_encounters(
    raw: DataFrame, order: str | None = None, layouts: Sequence[str] = dates.DATE_LAYOUTS
) -> DataFrame:
    """One row for each distinct standardised row, with what its copies add up to.

    Equal rows are combined before the shuffle. `order` names the lineage column that picks
    the survivor whose other lineage columns are kept. Lineage that is text, such as a file name,
    goes by a number for each different text, as a text among the results would have all rows sorted.
    """
    texts = [f.name for f in raw.schema.fields if f.name.startswith("_") and f.dataType == T.StringType()]
    if order is not None and texts:
        numbered = raw.select(*named(texts)).distinct().withColumn(TEXTS, F.monotonically_increasing_id())
        known = settle(numbered, "lineage")  # as many rows as there are different texts
        others = [c for c in raw.columns if c not in texts]
        coded = raw.join(known, same_keys(raw, known, texts)).select(*named(others), TEXTS)
        found = distinct_encounters(coded, order, layouts).join(known, TEXTS, "left")
        lineage = [c for c in found.columns if c.startswith("_") and c not in (TEXTS, *texts, *ADDED)]
        place = {c: k for k, c in enumerate(raw.columns)}
        lineage = sorted([*lineage, *texts], key=lambda c: place.get(c, len(place)))
        return found.select(*named(business_columns(found)), *named(lineage), *ADDED)
    ready = standardise_encounters(spread(raw), layouts)
    columns = business_columns(ready)
    lineage = [c for c in ready.columns if c not in columns]
    bad_dates = sum((F.col(f"`{c}`").isNull().cast("int") for c in ENCOUNTER_DATES if c in columns), F.lit(0))
    # Column by column, as a struct among the results would have the rows sorted, too.
    kept = [F.first(c) if order is None else F.min_by(c, F.col(order)) for c in named(lineage)]
    groups = ready.groupBy(*named(columns)).agg(
        *[c.alias(name) for c, name in zip(kept, lineage)],
        F.count(F.lit(1)).alias("_copies"),
        F.sum(bad_dates).alias("_bad_dates"),
        F.count_if(NEGATIVE_BILLING).alias("_negative"),
    )
    return groups.select(*named(columns), *named(lineage), *ADDED)


def complete_encounters(distinct: DataFrame) -> DataFrame:
    return distinct.dropna(subset=list(CRITICAL_COLUMNS)).drop(*ADDED)


def encounter_counts(distinct: DataFrame) -> DataFrame:
    """Invalid dates and negative amounts of all rows, duplicates, then critical nulls."""
    lacking = F.lit(False)
    for c in CRITICAL_COLUMNS:
        lacking = lacking | F.col(f"`{c}`").isNull()
    return distinct.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_count"),
        F.count_if(lacking).alias("null_count"),
        F.coalesce(F.sum("_bad_dates"), F.lit(0)).alias("invalid_date_count"),
        F.coalesce(F.sum("_negative"), F.lit(0)).alias("invalid_billing_count"),
    )


def clean_encounters(
    raw: DataFrame, order: str | None = None, layouts: Sequence[str] = dates.DATE_LAYOUTS
) -> DataFrame:
    """Standardises, removes duplicates, then removes rows without a critical value."""
    return complete_encounters(distinct_encounters(raw, order, layouts))


def clean_encounters_counts(raw: DataFrame, layouts: Sequence[str] = dates.DATE_LAYOUTS) -> DataFrame:
    return encounter_counts(distinct_encounters(raw, None, layouts))


# Sales files


def clean_identities(raw: DataFrame, fills: Mapping[str, object], median_column: str, order: Sequence[str]) -> DataFrame:
    """One row per user and day, nulls filled, rows without an e-mail or user name removed."""
    distinct = one_per_key(raw, ["user_id", "transaction_date"], order)
    median = approximate_median(distinct, median_column)
    filled = distinct.fillna(fills if median is None else {**fills, median_column: median})
    return filled.filter(F.col("email").isNotNull() & text.not_blank(F.col("username")))


def approximate_median(df: DataFrame, column: str, error: float = 0.01) -> int | None:
    """Within `error` of the middle rank, the exact one if it is 0; None for a column without values."""
    found = approximate_quantiles(df, [], column, [0.5], error).first()
    return None if found is None else int(found[0][0])


def clean_sales(raw: DataFrame) -> DataFrame:
    """Price from the median of its category, quantity 1 by default, distinct rows, line total."""
    priced = fill_with_group_median(raw, "category", "price").fillna({"quantity": 1})
    distinct = priced.dropDuplicates()
    return distinct.withColumn("total_amount", F.col("price") * F.col("quantity"))


def store_totals(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Total revenue per store after removing repeats of a user and day; no amount counts 0."""
    distinct = one_per_key(raw, ["user_id", "transaction_date"], order)
    return distinct.groupBy("store_id").agg(
        F.sum(F.coalesce(F.col("sale_amount").cast("decimal(18,2)"), F.lit(0))).alias("total_revenue")
    )


def exact_median(df: DataFrame, column: str) -> DataFrame:
    return exact_quantiles(df, [], column, [0.5], "q").select(F.col("q")[0].alias("median"))
