"""Catalogue questions (Q40 to Q43)."""

from __future__ import annotations

from lakemill.plans import catalogue
from lakemill.registry import entry, roles
from lakemill.registry.roles import CATALOGUE_SQL
from lakemill.registry.scalars import DEPARTMENT_SQL, POPULAR_SQL
from lakemill.registry.sql import dbl, half_up, mean


TOP10 = "top10 AS (SELECT category FROM catalogue GROUP BY 1 ORDER BY COUNT(*) DESC, category LIMIT 10)"


@entry(
    "Q40",
    f"""WITH {POPULAR_SQL}, s AS (SELECT product_id, title, {dbl("rating")} AS rating, ratings_count, {half_up("popularity_score", 6)} AS popularity_score FROM popular),
  r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY popularity_score DESC, product_id) AS a, ROW_NUMBER() OVER (ORDER BY rating DESC, product_id) AS b FROM s)
  SELECT 'weighted' AS ranking, a AS place, product_id, title, rating, ratings_count, popularity_score FROM r WHERE a <= 10
  UNION ALL SELECT 'rating', b, product_id, title, rating, ratings_count, popularity_score FROM r WHERE b <= 10""",
)
def popularity_against_rating(t):
    return catalogue.popularity_against_rating(roles.catalogue(t))


@entry("Q41", f"SELECT {DEPARTMENT_SQL} AS department, COUNT(*) AS count FROM part GROUP BY 1")
def departments(t):
    return catalogue.departments(roles.catalogue(t))


@entry(
    "Q42",
    f"""WITH {CATALOGUE_SQL}, {TOP10} SELECT category, COUNT(product_id) AS count, {mean("SUM(rating)", "COUNT(rating)")} AS avg_rating,
  {mean("SUM(initial_price)", "COUNT(initial_price)")} AS avg_price, {mean("SUM(discount)", "COUNT(discount)")} AS avg_discount
  FROM catalogue WHERE category IN (SELECT category FROM top10) GROUP BY 1""",
)
def leading_categories(t):
    return catalogue.leading_categories(roles.catalogue(t))


@entry(
    "Q43",
    f"""WITH {POPULAR_SQL}, {TOP10} SELECT category, {mean("SUM(CAST(popularity_score AS DECIMAL(28,8)))", "COUNT(*)", 4)} AS avg_popularity
  FROM popular WHERE category IN (SELECT category FROM top10) GROUP BY 1""",
)
def category_popularity(t):
    return catalogue.category_popularity(roles.catalogue(t))
