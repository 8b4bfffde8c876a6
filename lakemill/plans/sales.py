"""Questions about sales lines, stores and staff.

Tables: sales(row_id, order_id, customer_id, order_date, sales), customers(customer_id,
customer_name); shop tables and staff as named in each function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions import dates
from lakemill.functions.numbers import mean_of, net_revenue
from lakemill.operators.ordered import numbered, ranked
from lakemill.operators.rows import beside
from lakemill.operators.sampling import top
from lakemill.session import settle
from lakemill.sources import files


def price_tier(price: Column) -> Column:
    return F.when(price < 1000, "Budget").when(price.between(1000, 3000), "Mid-Range").otherwise("Premium")


def spend_leaders(orders: DataFrame, customers: DataFrame, n: int = 3) -> DataFrame:
    """Customers by the total amount of their orders."""
    spent = orders.groupBy("customer_id").agg(F.sum("total_amount").alias("total_spent"))
    best = top(spent, ["total_spent desc", "customer_id"], n, "place")
    return best.join(customers.select("customer_id", "customer_name"), "customer_id").select(
        "place", "customer_id", "customer_name", "total_spent"
    )


def line_net_revenue(items: DataFrame, products: DataFrame) -> DataFrame:
    net = net_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount_percent"))
    return items.join(products.select("product_id", "product_name"), "product_id").withColumn(
        "net_revenue", F.round(net, 2)
    )


def monthly_orders(orders: DataFrame, cancelled: str) -> DataFrame:
    """Orders and revenue per month without the cancelled ones."""
    kept = orders.filter(F.col("status") != cancelled)
    return (
        kept.groupBy(dates.year_month(F.col("order_date")).alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"))
        .orderBy("month")
    )


def state_split(orders: DataFrame, state: str) -> DataFrame:
    """Orders in and out of a state, in one row; a missing state counts for neither."""
    return orders.agg(
        F.count_if(F.col("status") == state).alias("delivered"),
        F.count_if(F.col("status") != state).alias("not_delivered"),
    )


def above_mean(sales: DataFrame) -> DataFrame:
    """Lines above the mean line, compared without division: sales * rows > total."""
    whole = sales.agg(F.sum("sales").alias("_total"), F.count("sales").alias("_rows"))
    over = F.col("sales").cast("decimal(18,2)") * F.col("_rows").cast("decimal(18,0)") > F.col("_total")
    return beside(sales, whole).filter(over).select("row_id", "order_id", "customer_id", "sales")


def largest_lines(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Largest line of each customer, ties kept."""
    most = sales.groupBy("customer_id").agg(F.max("sales").alias("sales"))
    return sales.join(most, ["customer_id", "sales"]).join(customers, "customer_id").select(
        "customer_id", "customer_name", "order_id", "row_id", "sales"
    )


def customer_totals(sales: DataFrame, customers: DataFrame) -> DataFrame:
    totals = sales.groupBy("customer_id").agg(F.sum("sales").alias("total_sales"))
    return totals.join(customers.select("customer_id", "customer_name"), "customer_id")


def totals_above_mean(sales: DataFrame, customers: DataFrame) -> DataFrame:
    totals = customer_totals(sales, customers)
    whole = totals.agg(F.sum("total_sales").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    over = F.col("total_sales").cast("decimal(24,2)") * F.col("_n").cast("decimal(12,0)") > F.col("_sum")
    return beside(totals, whole).filter(over).drop("_sum", "_n")


def customer_ranks(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return ranked(settle(customer_totals(sales, customers)), [], ["total_sales desc"], "sales_rank")


def line_sequence(sales: DataFrame) -> DataFrame:
    """Numbers the lines of each customer by date."""
    return numbered(sales, ["customer_id"], ["order_date", "row_id"], "order_seq_num")


def leading_customers(sales: DataFrame, customers: DataFrame, ranks: int = 3) -> DataFrame:
    """Customers of the first ranks; equal totals share one, so there may be more than `ranks`.

    Only the highest distinct totals can have these ranks, so ranking needs no full order.
    """
    totals = settle(customer_totals(sales, customers))
    best = top(totals.select("total_sales").distinct(), ["total_sales desc"], ranks, "sales_rank")
    return totals.join(F.broadcast(best), "total_sales")


def extreme_customers(sales: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """Highest and lowest customer totals."""
    totals = settle(customer_totals(sales, customers))
    high = top(totals, ["total_sales desc", "customer_id"], n, "place").withColumn("side", F.lit("top"))
    low = top(totals, ["total_sales", "customer_id"], n, "place").withColumn("side", F.lit("bottom"))
    return high.unionByName(low)


def with_order_count(sales: DataFrame, customers: DataFrame, orders: int = 1) -> DataFrame:
    """Customers with an exact number of distinct orders."""
    counted = sales.groupBy("customer_id").agg(F.countDistinct("order_id").alias("order_count"))
    return counted.filter(F.col("order_count") == orders).join(
        customers.select("customer_id", "customer_name"), "customer_id"
    )


def largest_line_by_name(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Largest line per customer name; namesakes count as one."""
    most = sales.groupBy("customer_id").agg(F.max("sales").alias("sales"))
    return (
        most.join(customers.select("customer_id", "customer_name"), "customer_id")
        .groupBy("customer_name")
        .agg(F.max("sales").alias("highest_order_value"))
    )


def region_categories(sales: DataFrame, region: str) -> DataFrame:
    """Revenue statistics of each category in one region; `revenue` is decimal."""
    revenue = F.col("revenue")
    return (
        sales.filter(F.col("region") == region)
        .groupBy("product_category")
        .agg(
            F.count(F.lit(1)).alias("num_transactions"),
            F.sum(revenue).alias("total_revenue"),
            F.count(revenue).alias("_n"),
            F.min(revenue).alias("min_revenue"),
            F.max(revenue).alias("max_revenue"),
        )
        .withColumn("avg_revenue", mean_of(F.col("total_revenue"), F.col("_n")))
        .drop("_n")
        .orderBy(F.desc("avg_revenue"), "product_category")
    )


def busy_places(sales: DataFrame, place: str, more_than: int) -> DataFrame:
    return (
        sales.groupBy(place)
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") > more_than)
        .orderBy(F.desc("count"), place)
    )


def salary_by_department(staff: DataFrame) -> DataFrame:
    return (
        staff.groupBy("department")
        .agg(F.count(F.lit(1)).alias("headcount"), F.sum("salary").alias("_sum"), F.count("salary").alias("_n"))
        .select("department", "headcount", mean_of(F.col("_sum"), F.col("_n")).alias("avg_salary"))
        .orderBy(F.desc("avg_salary"), "department")
    )


def salary_band(salary: Column) -> Column:
    """A missing salary falls to the last band."""
    return F.when(salary >= 100000, "High").when(salary >= 60000, "Mid").otherwise("Low")


STAFF_SCHEMA = (
    "emp_id string, name string, department string, country string, age int, salary double,"
    " join_date string, status string, email string"
)


def export_active_staff(spark: SparkSession, source: str, target: str, above: float = 60000) -> DataFrame:
    """Reads staff CSV, renames, parses, cleans, filters, and writes Parquet."""
    staff = (
        files.read_csv(spark, source, STAFF_SCHEMA)
        .withColumnRenamed("emp_id", "employee_id")
        .withColumn("join_date", dates.parse_date(F.col("join_date")))
        .filter(F.col("email").isNotNull())
        .fillna({"age": 0, "status": "Unknown"})
        .filter((F.col("status") == "Active") & (F.col("salary") > above))
        .select("employee_id", "name", "department", "country", "age", "salary", "join_date", "status")
    )
    files.write_parquet(staff, target)
    return spark.read.parquet(target)


def young_subscribers(users: DataFrame, low: int = 18, high: int = 30, tier: str = "Premium") -> DataFrame:
    return users.filter(F.col("age").between(low, high) & (F.col("subscription") == tier))
