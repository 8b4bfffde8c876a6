"""Questions about a product catalogue: products(product_id, title, category, rating,
ratings_count, initial_price, discount, breadcrumbs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.nested import first_listed
from lakemill.functions.numbers import mean_of, ratio, weighted_score
from lakemill.operators.rows import beside
from lakemill.operators.sampling import top
from lakemill.operators.statistics import value_counts, with_top_values


def with_popularity(products: DataFrame, reviewed_only: bool = False) -> DataFrame:
    """Adds a score that weighs the rating by its count against the means of the catalogue.

    Products without reviews count with rating 0 unless `reviewed_only`. The means are one row.
    """
    base = products.filter(F.col("ratings_count") > 0) if reviewed_only else products
    sums = base.agg(
        F.sum(F.col("rating").cast("decimal(18,6)")).alias("r"),
        F.count("rating").alias("rn"),
        F.sum(F.col("ratings_count").cast("decimal(18,0)")).alias("c"),
        F.count("ratings_count").alias("cn"),
    ).select(ratio(F.col("r"), F.col("rn")).alias("_mean_rating"), ratio(F.col("c"), F.col("cn")).alias("_mean_count"))
    score = weighted_score(
        F.col("rating").cast("double"), F.col("ratings_count").cast("double"), F.col("_mean_rating"), F.col("_mean_count")
    )
    return beside(products, sums).withColumn("popularity_score", score).drop("_mean_rating", "_mean_count")


def popularity_against_rating(products: DataFrame, n: int = 10) -> DataFrame:
    """The leaders by weighted score and by plain rating."""
    scored = with_popularity(products).select(
        "product_id", "title", "rating", "ratings_count", F.round(F.col("popularity_score").cast("decimal(38,8)"), 6).alias("popularity_score")
    )
    weighted = top(scored, ["popularity_score desc", "product_id"], n, "place").withColumn("ranking", F.lit("weighted"))
    plain = top(scored, ["rating desc", "product_id"], n, "place").withColumn("ranking", F.lit("rating"))
    return weighted.unionByName(plain)


def departments(products: DataFrame) -> DataFrame:
    """Products per department read from the category path."""
    return value_counts(products.withColumn("department", first_listed(F.col("breadcrumbs"))), "department")


def leading_categories(products: DataFrame, n: int = 10) -> DataFrame:
    """Count, mean rating, price and discount of the largest categories."""
    chosen = with_top_values(products, "category", n)
    return (
        chosen.groupBy("category")
        .agg(
            F.count("product_id").alias("count"),
            *[
                f
                for c in ("rating", "initial_price", "discount")
                for f in (F.sum(F.col(c).cast("decimal(18,6)")).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}"))
            ],
        )
        .select(
            "category",
            "count",
            mean_of(F.col("_s_rating"), F.col("_n_rating")).alias("avg_rating"),
            mean_of(F.col("_s_initial_price"), F.col("_n_initial_price")).alias("avg_price"),
            mean_of(F.col("_s_discount"), F.col("_n_discount")).alias("avg_discount"),
        )
        .orderBy(F.desc("count"), "category")
    )


def category_popularity(products: DataFrame, n: int = 10) -> DataFrame:
    """Mean weighted score of the largest categories, lowest first."""
    scored = with_top_values(with_popularity(products), "category", n)
    score = F.sum(F.col("popularity_score").cast("decimal(28,8)"))
    return (
        scored.groupBy("category")
        .agg(score.alias("_sum"), F.count("popularity_score").alias("_n"))
        .select("category", mean_of(F.col("_sum"), F.col("_n"), 4).alias("avg_popularity"))
        .orderBy("avg_popularity", "category")
    )
