"""Questions about a shop.

Tables: customers(customer_id, customer_name, registration_date), products(product_id,
product_name, category), orders(order_id, customer_id, order_date, status, region_code),
items(order_id, product_id, quantity, unit_price, discount_percent). Items are reduced to
one row per order or product before any join, so a hot key shrinks before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions import dates
from lakemill.functions.numbers import net_revenue, percent, percent_change
from lakemill.operators.ordered import ranked, scan, tiled
from lakemill.operators.rows import beside
from lakemill.operators.sampling import top
from lakemill.session import settle


def line_revenue() -> Column:
    return net_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount_percent"))


def order_revenue(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.sum(line_revenue()).alias("revenue"))


def product_revenue(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(F.sum(line_revenue()).alias("revenue"))


def known(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("customer_id").isNotNull())


def customer_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    valued = known(orders).select("order_id", "customer_id").join(order_revenue(items), "order_id")
    return valued.groupBy("customer_id").agg(F.sum("revenue").alias("revenue"))


def category_revenue(items: DataFrame, products: DataFrame) -> DataFrame:
    return (
        product_revenue(items)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.round(F.sum("revenue"), 2).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def top_customers(orders: DataFrame, items: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    best = top(customer_revenue(orders, items), ["revenue desc", "customer_id"], n, "place")
    return best.join(customers.select("customer_id", "customer_name"), "customer_id", "left").select(
        "place", "customer_id", "customer_name", F.round("revenue", 2).alias("total_order_value")
    )


def recent_months(orders: DataFrame, months: int = 12) -> DataFrame:
    """Orders per month over the months before the newest order."""
    newest = orders.agg(F.max("order_date").alias("newest"))
    start = F.add_months(F.to_date("newest"), -months).cast("timestamp_ntz")
    per_order = beside(orders, newest).filter(F.col("order_date") >= start)
    return (
        per_order.groupBy(dates.year_month(F.col("order_date")).alias("year_month"))
        .agg(F.countDistinct("order_id").alias("order_count"))
        .orderBy("year_month")
    )


def never_in_state(orders: DataFrame, customers: DataFrame, state: str) -> DataFrame:
    """Customers with orders, none of them in `state`."""
    per_customer = known(orders).groupBy("customer_id").agg(
        F.max((F.col("status") == state).cast("int")).alias("reached")
    )
    without = per_customer.filter(F.coalesce("reached", F.lit(0)) == 0).select("customer_id")
    return without.join(customers.select("customer_id", "customer_name"), "customer_id", "left")


def unit_flow(items: DataFrame) -> DataFrame:
    quantity = F.col("quantity")
    return items.groupBy("product_id").agg(
        F.sum(F.when(quantity > 0, quantity).otherwise(0)).alias("units_purchased"),
        F.sum(F.when(quantity < 0, -quantity).otherwise(0)).alias("units_returned"),
        F.sum(F.abs(quantity)).alias("total_units"),
    )


def mostly_returned(items: DataFrame, products: DataFrame) -> DataFrame:
    """Products with more units returned than bought."""
    flow = unit_flow(items).filter(F.col("units_returned") > F.col("units_purchased"))
    return (
        flow.join(products.select("product_id", "product_name"), "product_id")
        .select("product_id", "product_name", "units_purchased", "units_returned")
        .orderBy(F.desc("units_returned"), "product_id")
    )


def return_rates(items: DataFrame, products: DataFrame) -> DataFrame:
    by_category = (
        unit_flow(items)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("units_returned").alias("total_returned"), F.sum("total_units").alias("total_units"))
    )
    rate = percent(F.col("total_returned"), F.nullif(F.col("total_units"), F.lit(0)))
    return by_category.withColumn("return_rate_percent", rate).orderBy(F.desc("return_rate_percent"), "category")


def region_running_total(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue per region and day, with the total so far."""
    daily = (
        orders.select("order_id", "region_code", F.to_date("order_date").alias("order_date"))
        .join(order_revenue(items), "order_id")
        .groupBy("region_code", "order_date")
        .agg(F.sum("revenue").alias("revenue"))
    )
    summed = scan(settle(daily), ["region_code"], ["order_date"], totals={"total": "revenue"})
    return summed.select(
        "region_code",
        "order_date",
        F.round("revenue", 2).alias("daily_revenue"),
        F.round("total", 2).alias("running_total"),
    )


def product_ranks(items: DataFrame, products: DataFrame) -> DataFrame:
    """Products by revenue inside their category; equal revenue shares a rank."""
    valued = product_revenue(items).join(products, "product_id").select(
        "category", "product_id", "product_name", "revenue"
    )
    placed = ranked(settle(valued), ["category"], ["revenue desc"], "rank_in_category")
    return placed.select(
        "category", "product_id", "product_name", F.round("revenue", 2).alias("total_revenue"), "rank_in_category"
    )


def order_gaps(orders: DataFrame, at_risk_days: int = 30) -> DataFrame:
    """Days between a customer's orders; a mean gap above the limit marks the customer.

    The gaps of a customer add up to the time from first to last order only before they are
    cut to whole days, so they are summed as cut.
    """
    moments = settle(known(orders).select("customer_id", "order_date").distinct())
    spaced = scan(moments, ["customer_id"], ["order_date"], previous={"previous_order_date": "order_date"})
    spaced = settle(
        spaced.withColumn("days_gap", dates.elapsed_days(F.col("order_date"), F.col("previous_order_date")))
    )
    means = spaced.groupBy("customer_id").agg(
        F.sum("days_gap").alias("_days"), F.count("days_gap").alias("_gaps")
    )
    late = F.col("_days") > F.lit(at_risk_days) * F.col("_gaps")
    risk = means.select("customer_id", F.when(late, "At Risk").otherwise("Healthy").alias("risk_flag"))
    return spaced.join(risk, "customer_id", "left")


def monthly_customer_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    return (
        known(orders)
        .select("order_id", "customer_id", dates.year_month(F.col("order_date")).alias("year_month"))
        .join(order_revenue(items), "order_id")
        .groupBy("customer_id", "year_month")
        .agg(F.sum("revenue").alias("revenue"))
    )


def revenue_bands(orders: DataFrame, items: DataFrame, high: int = 10000, medium: int = 5000) -> DataFrame:
    """Customers per revenue band and month."""
    revenue = F.col("revenue")
    band = F.when(revenue > high, "High").when(revenue >= medium, "Medium").otherwise("Low")
    return (
        monthly_customer_revenue(orders, items)
        .groupBy("year_month", band.alias("revenue_category"))
        # one row per customer and month: counting rows counts customers
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .orderBy("year_month", "revenue_category")
    )


def value_quartiles(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Customers in four equal parts by lifetime value, Platinum to Bronze."""
    valued = settle(customer_revenue(orders, items))
    tiles = tiled(valued, ["revenue desc", "customer_id"], 4, "quartile")
    label = F.element_at(F.array(*[F.lit(x) for x in ("Platinum", "Gold", "Silver", "Bronze")]), F.col("quartile").cast("int"))
    return tiles.select(
        "customer_id", F.round("revenue", 2).alias("total_value"), "quartile", label.alias("quartile_label")
    )


def year_over_year(orders: DataFrame, items: DataFrame) -> DataFrame:
    monthly = (
        orders.select("order_id", F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .join(order_revenue(items), "order_id")
        .groupBy("year", "month")
        .agg(F.sum("revenue").alias("revenue"))
    )
    before = monthly.select((F.col("year") + 1).alias("year"), "month", F.col("revenue").alias("previous"))
    return (
        monthly.join(before, ["year", "month"], "left")
        .select(
            "year",
            "month",
            F.round("revenue", 2).alias("revenue"),
            F.round("previous", 2).alias("prev_year_revenue"),
            percent_change(F.col("revenue"), F.col("previous")).alias("yoy_growth_percent"),
        )
        .orderBy("year", "month")
    )


def category_shift(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """First and latest category of each customer; order id and product settle equal dates.

    Items of unknown products do not count. Only the ends are needed, so each is an aggregate combined before the shuffle: no window.
    """
    lines = items.join(products.select("product_id"), "product_id", "left_semi").groupBy("order_id").agg(
        F.min("product_id").alias("first_product"), F.max("product_id").alias("last_product")
    )
    placed = known(orders).select("order_id", "customer_id", "order_date").join(lines, "order_id")
    place = F.struct("order_date", "order_id")
    ends = placed.groupBy("customer_id").agg(
        F.min_by("first_product", place).alias("first_product"),
        F.max_by("last_product", place).alias("last_product"),
    )
    named = products.select("product_id", "category")
    first = named.select(F.col("product_id").alias("first_product"), F.col("category").alias("first_category"))
    last = named.select(F.col("product_id").alias("last_product"), F.col("category").alias("most_recent_category"))
    shift = F.when(F.col("first_category") != F.col("most_recent_category"), "Yes").otherwise("No")
    return (
        ends.join(first, "first_product")
        .join(last, "last_product")
        .select("customer_id", "first_category", "most_recent_category", shift.alias("category_shift"))
    )


def cumulative_share(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Customers by revenue, with the share of all revenue reached so far."""
    valued = settle(customer_revenue(orders, items))
    summed = scan(valued, [], ["revenue desc", "customer_id"], totals={"reached": "revenue"})
    total = valued.agg(F.sum("revenue").alias("total"))
    return beside(summed, total).select(
        "customer_id",
        F.round("revenue", 2).alias("revenue"),
        F.round("reached", 2).alias("cumulative_revenue"),
        percent(F.col("reached"), F.col("total")).alias("cumulative_percent"),
    )


def cohort_retention(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers by month of registration, active in that month and the three after."""
    cohorts = customers.select("customer_id", F.trunc("registration_date", "MM").alias("cohort"))
    active = known(orders).select("customer_id", F.trunc("order_date", "MM").alias("month")).distinct()
    offset = dates.months_apart(F.col("month"), F.col("cohort"))
    activity = cohorts.join(active, "customer_id").withColumn("offset", offset).filter("offset >= 0")
    counted = activity.groupBy("cohort").agg(
        *[F.count_if(F.col("offset") == i).alias(f"month_{i}_active") for i in range(4)]
    )
    sizes = cohorts.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_size"))
    return (
        counted.join(sizes, "cohort")
        .select(
            dates.year_month(F.col("cohort")).alias("cohort_month"),
            "cohort_size",
            *[f"month_{i}_active" for i in range(4)],
            *[
                percent(F.col(f"month_{i}_active"), F.col("cohort_size")).alias(f"retention_month_{i}_pct")
                for i in range(1, 4)
            ],
        )
        .orderBy("cohort_month")
    )


def better_second_order(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Customers whose second order was worth more than the first.

    The two earliest orders come from two minimum aggregates; a customer's orders are never
    gathered in one place.
    """
    valued = settle(known(orders).select("customer_id", "order_id", "order_date").join(order_revenue(items), "order_id"))
    entry = F.struct("order_date", "order_id", "revenue")
    first = settle(valued.groupBy("customer_id").agg(F.min(entry).alias("first")))
    later = valued.join(first, "customer_id").filter(F.col("order_id") != F.col("first.order_id"))
    pairs = later.groupBy("customer_id").agg(F.min(entry).alias("second"), F.first("first").alias("first"))
    change = F.col("second.revenue") - F.col("first.revenue")
    return pairs.filter(change > 0).select(
        "customer_id",
        F.round("first.revenue", 2).alias("first_order_value"),
        F.round("second.revenue", 2).alias("second_order_value"),
        F.round(change, 2).alias("value_change"),
    )


def in_span(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Orders from `start` to the end of day `end`, as a range on the raw column."""
    day = F.col("order_date")
    return orders.filter((day >= dates.moment(start)) & (day < dates.moment(dates.next_day(end))))


def span_totals(orders: DataFrame, items: DataFrame, start: str, end: str) -> DataFrame:
    valued = in_span(orders, start, end).select("order_id", "customer_id").join(order_revenue(items), "order_id")
    return valued.agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
        F.countDistinct("customer_id").alias("unique_customers"),
    ).withColumn("total_revenue", F.round("total_revenue", 2))


def span_top_products(
    orders: DataFrame, items: DataFrame, products: DataFrame, start: str, end: str, n: int = 3
) -> DataFrame:
    chosen = in_span(orders, start, end).select("order_id")
    sold = product_revenue(items.join(chosen, "order_id"))
    best = top(sold, ["revenue desc", "product_id"], n, "place")
    return best.join(products.select("product_id", "product_name"), "product_id").select(
        "place", "product_name", F.round("revenue", 2).alias("revenue")
    )


def span_report(orders: DataFrame, items: DataFrame, products: DataFrame, start: str, end: str) -> DataFrame:
    """Totals of a span, the equal span before it, the changes, and the top three products."""
    before = dates.previous_span(start, end)
    now = span_totals(orders, items, start, end)
    then = span_totals(orders, items, *before).select(
        *[F.col(c).alias(f"previous_{c}") for c in ("total_orders", "total_revenue", "unique_customers")]
    )
    best = span_top_products(orders, items, products, start, end)
    listed = best.agg(
        *[F.max(F.when(F.col("place") == i, F.col("product_name"))).alias(f"top_{i}_product") for i in (1, 2, 3)],
        *[F.max(F.when(F.col("place") == i, F.col("revenue"))).alias(f"top_{i}_revenue") for i in (1, 2, 3)],
    )
    changes = {
        f"{c}_change_pct": percent_change(F.col(c), F.col(f"previous_{c}"))
        for c in ("total_orders", "total_revenue", "unique_customers")
    }
    dated = {"start": F.lit(start), "end": F.lit(end), "previous_start": F.lit(before[0]), "previous_end": F.lit(before[1])}
    return beside(beside(now, then), listed).withColumns({**changes, **dated})
