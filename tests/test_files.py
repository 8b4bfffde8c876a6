from __future__ import annotations

import pytest

from lakemill.functions import dates, numbers
from lakemill.operators.clean import approximate_median
from lakemill.operators.ordered import scan
from lakemill.plans import shop
from lakemill.sources import bronze, files
from pyspark.sql import functions as F

MESSY = [(1, 'say "x", ok'), (2, "two\nlines"), (3, ""), (4, None), (5, " blanks "), (6, "back\\slash"), (7, '[{"name":"Women"}]')]


def test_csv_round_trip(spark, tmp_path):
    files.write_csv(spark.createDataFrame(MESSY, "id long, t string"), f"{tmp_path}/c")
    assert sorted(tuple(r) for r in files.read_csv(spark, f"{tmp_path}/c", "id long, t string").collect()) == MESSY
    assert sorted((int(r.id), r.t) for r in files.read_csv_text(spark, f"{tmp_path}/c").collect()) == MESSY


def test_foreign_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"[{""name"":""Women""}]"\n2,"a\nb"\n3,\n4,""\n')
    rows = [tuple(r) for r in files.read_csv_text(spark, str(tmp_path / "a.csv")).collect()]
    assert rows == [("1", '[{"name":"Women"}]'), ("2", "a\nb"), ("3", None), ("4", "")]


def test_other_column_order_goes_by_name_and_other_names_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    rows = files.read_csv(spark, str(tmp_path), "id int, name string")
    assert sorted(map(tuple, rows.collect())) == [(1, "x"), (2, "y")]
    (tmp_path / "c.csv").write_text("name,key\ny,2\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv_text(spark, str(tmp_path)).collect()


def test_bronze_ids_over_folders_with_equal_names(spark, tmp_path):
    for day in (1, 2):
        (tmp_path / f"src/day={day}").mkdir(parents=True)
        (tmp_path / f"src/day={day}/data.csv").write_text("".join(["id\n", *[f"{day}{k}\n" for k in range(3)]]))
    layer = bronze.ingest(spark, str(tmp_path / "src"), str(tmp_path / "bronze"))
    rows = sorted((r._bronze_row_id, r.id) for r in layer.collect())
    assert rows == [(1, "10"), (2, "11"), (3, "12"), (4, "20"), (5, "21"), (6, "22")]


def test_many_groups_above_the_bound_are_split(spark):
    rows = spark.range(0, 40_000).selectExpr("id % 2000 AS g", "id")
    out = scan(rows, ["g"], ["id"], number="n", hot_rows=10)
    assert out.filter("n <> floor(id / 2000) + 1").count() == 0 and out.count() == 40_000


def test_dates_and_numbers_without_loss(spark):
    texts = ["2024-01-05", "2024/1/5", "5-1-2024", "2024-01-05T10:00:00", "2024/01/05 10:00:00", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(F.date_format(dates.parse_timestamp(F.col("t"), dates.ORDER_TIME_LAYOUTS), "yyyy-MM-dd HH").alias("d"))
    assert [r.d for r in found.collect()] == ["2024-01-05 00"] * 3 + ["2024-01-05 10"] * 2 + [None] * 2
    wide = spark.createDataFrame([("99999999999999999.00", 10**10)], "t string, q long")
    row = wide.select(
        numbers.to_number(F.col("t")).cast("string").alias("n"),
        numbers.net_revenue(F.col("q"), F.lit("2.00"), F.lit("50")).cast("double").alias("r"),
    ).first()
    assert (row.n, row.r) == ("99999999999999999.00", 1e10)


def test_category_shift_ignores_unknown_products(spark):
    orders = spark.createDataFrame([(1, 1, "2024-01-01", "Delivered"), (2, 1, "2024-01-02", "Delivered")], "order_id long, customer_id long, order_date string, status string")
    items = spark.createDataFrame([(1, 0), (1, 7), (2, 8)], "order_id long, product_id long")
    products = spark.createDataFrame([(7, "a"), (8, "b")], "product_id long, category string")
    assert [tuple(r) for r in shop.category_shift(orders, items, products).collect()] == [(1, "a", "b", "Yes")]


def test_median_of_nothing(spark):
    assert approximate_median(spark.createDataFrame([(None,)], "age int"), "age") is None
