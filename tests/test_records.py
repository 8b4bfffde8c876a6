"""CSV records with line breaks in quotes, read by many tasks, against Python's reader."""

from __future__ import annotations

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from lakemill.sources import bronze, files, records


def cut_small(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture
def small_splits(spark):
    cut_small(spark, 1500)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(path, rows, header=("id", "t", "u"), end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(header)
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())


def texts(seed, n):
    rnd = random.Random(seed)
    signs = ["a", "é", '"', ",", "\n", "\n\n", " ", "x" * 30, '""', '\n"', '",']
    return [(str(k), "t" + "".join(rnd.choice(signs) for _ in range(rnd.randrange(12))) + "t", "u" + rnd.choice(signs) * rnd.randrange(3) + "u") for k in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_breaks_in_quotes_over_many_splits(spark, tmp_path, small_splits, end):
    rows = texts(1, 400)
    rows[50] = ("50", "long\n" * 1200 + "end", "spans whole splits")  # no record starts in the splits between
    written(tmp_path / "a.csv", rows, end=end)
    more = [(f"b{k}", t, u) for k, t, u in texts(2, 60)]
    written(tmp_path / "b.csv", more, end=end)
    found = records.read_records(spark, str(tmp_path))
    assert found.splits.count() > 15 and found.splits.where("_carry = 1").count() > 3
    got = files.read_csv_text(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(rows + more)
    layer = bronze.ingest(spark, str(tmp_path), str(tmp_path / "bronze")).orderBy("_bronze_row_id").collect()
    assert [(r.id, r.t, r.u) for r in layer] == rows + more
    assert [r._bronze_row_id for r in layer] == list(range(1, len(rows + more) + 1))
    assert {r._source_file for r in layer} == {"a.csv", "b.csv"}


def test_plain_lines_are_not_grouped(spark, tmp_path, small_splits):
    written(tmp_path / "a.csv", [(k, "x" * 40, 'say "so"') for k in range(300)])
    rows = files.read_csv(spark, str(tmp_path / "a.csv"), "id long, t string, u string")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan and plan.count("from_csv") == 1
    assert rows.rdd.getNumPartitions() > 1
    assert rows.agg(F.sum("id"), F.count_if(F.col("u") == 'say "so"')).first()[:] == (300 * 299 // 2, 300)


def test_blank_lines_marks_and_missing_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿id,t\r\n1,"a\r\nb"\r\n\r\n2,\n\n3,""\n4,c'.encode())
    got = sorted(map(tuple, files.read_csv_text(spark, str(tmp_path / "a.csv")).collect()))
    assert got == [("1", "a\r\nb"), ("2", None), ("3", ""), ("4", "c")]
    assert [r._bronze_row_id for r in bronze.ingest(spark, str(tmp_path / "a.csv"), str(tmp_path / "b")).orderBy("id").collect()] == [1, 2, 3, 4]
    (tmp_path / "only.csv").write_text("id,t\n")
    assert files.read_csv_text(spark, str(tmp_path / "only.csv")).count() == 0


def test_columns_go_by_name(spark, tmp_path):
    written(tmp_path / "a.csv", [("1", "x", "p\nq")])
    written(tmp_path / "b.csv", [("r", "2", "y")], header=("u", "id", "t"))
    got = sorted(map(tuple, files.read_csv(spark, str(tmp_path), "id int, t string, u string").collect()))
    assert got == [(1, "x", "p\nq"), (2, "y", "r")]
    written(tmp_path / "c.csv", [("1", "x", "y")], header=("id", "t", "other"))
    with pytest.raises(ValueError, match="header"):
        files.read_csv(spark, str(tmp_path), "id int, t string, u string")


def test_quotes_inside_fields_are_read_file_by_file(spark, tmp_path):
    for name, lines in {"odd": ["id,t", '1,5" pipe', "2,x"], "even": ["id,t", '1,5" pipe', "2,x", '3,7" pipe']}.items():
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join(lines) + "\n")
        assert records.read_records(spark, str(path)) is None
        got = sorted(map(tuple, files.read_csv_text(spark, str(path)).collect()))
        assert got == [tuple(line.split(",")) for line in lines[1:]]


def test_well_quoted(spark):
    good = ['a,b', '"a,b"', 'x,"a\nb",y', '"",""', '"""a""",b', 'a,""', '"a"\r', '"x ""y"" z"']
    bad = ['a"b', '5",6"', 'a,"b"c', 'a "b",c', '"a" ,b']
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    found = {r.t: r.ok for r in df.select("t", records.well_quoted(F.col("t")).alias("ok")).collect()}
    assert all(found[t] for t in good) and not any(found[t] for t in bad)


def test_malformed_records_are_counted_and_kept_apart(spark, tmp_path):
    lines = ["id,t,u", *[f'{k},"a\nb",c' for k in range(8)], "8,short", '9,too,many,"val\nues"']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    layer = bronze.ingest(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"))
    assert bronze.counts(spark, str(tmp_path / "out")) == (10, 2)
    assert sorted(r.id for r in layer.collect()) == [str(k) for k in range(8)]
    assert sorted(r.record for r in bronze.malformed(spark, str(tmp_path / "out")).collect()) == ["8,short", '9,too,many,"val\nues"']


def test_inferred_types(spark, tmp_path):
    rows = [("1", "1.5", "3000000000", "2024-01-05", "true", "x\ny", None), ("-2", ".5e3", "7", "2024-02-01", "FALSE", "5", None), (None,) * 7]
    header = ("a", "b", "c", "d", "e", "f", "g")
    written(tmp_path / "a.csv", rows, header=header)
    for multi in (True, False):
        if not multi:
            written(tmp_path / "a.csv", [(*r[:5], (r[5] or "").replace("\n", " "), r[6]) for r in rows], header=header)
        got = files.read_csv_inferred(spark, str(tmp_path / "a.csv"), multi)
        assert [t for _, t in got.dtypes] == ["int", "double", "bigint", "date", "boolean", "string", "string"]
        assert got.agg(F.sum("a"), F.sum("b"), F.sum("c")).first()[:] == (-1, 501.5, 3000000007)


def test_partition_folders_keep_their_column(spark, tmp_path):
    for day in (1, 2):
        (tmp_path / f"src/day={day}").mkdir(parents=True)
        written(tmp_path / f"src/day={day}/data.csv", [(str(day), "a\nb", "c")])
    got = sorted(map(tuple, files.read_csv(spark, str(tmp_path / "src"), "id int, t string, u string").collect()))
    assert got == [(1, "a\nb", "c", 1), (2, "a\nb", "c", 2)]


def stored_frames(spark):
    """Labels of what lies in the shared folder, with their numbers."""
    folder = spark.conf.get("spark.checkpoint.dir") + "/lakemill"
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def test_plain_lines_are_not_stored(spark, tmp_path, small_splits):
    header, folder = "id,t,u", tmp_path / "in"
    folder.mkdir()
    for name in "ab":
        (folder / f"{name}.csv").write_text(header + "\n" + "".join(f'{name}{k},"say ""so""",{"x" * 30}\n' for k in range(200)), encoding="utf-8")
    before = stored_frames(spark)
    layer = bronze.ingest(spark, str(folder), str(tmp_path / "bronze"))
    assert not [x for x in set(stored_frames(spark)) - set(before) if x.startswith("csv-")]
    got = layer.orderBy("_bronze_row_id").collect()
    assert [(r._bronze_row_id, r.id, r._source_file) for r in got] == [(k + 1, f"{'ab'[k // 200]}{k % 200}", f"{'ab'[k // 200]}.csv") for k in range(400)]
    assert spark.read.parquet(str(tmp_path / "bronze" / "splits")).count() > 10


@pytest.mark.parametrize("lines", [["k,v", "1,a", "k,v", "2,b"], ["k,v", "1,a", "", "2,b"], ["", "k,v", "1,a"]])
def test_header_like_and_blank_lines_go_the_longer_way(spark, tmp_path, lines):
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    assert records.plain_records(spark, str(tmp_path)) is None
    if lines[0]:
        got = sorted(map(tuple, files.read_csv_text(spark, str(tmp_path)).collect()))
        assert got == sorted(tuple(x.split(",")) for x in lines[1:] if x)


def test_headers_in_another_order_go_the_longer_way(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,a\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("v,k\nb,2\n", encoding="utf-8")
    assert records.plain_records(spark, str(tmp_path)) is None
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path), "k string, v string").collect())) == [("1", "a"), ("2", "b")]


def test_compressed_files_give_the_same_rows(spark, tmp_path):
    rows = spark.range(500).selectExpr("id", "if(id % 7 = 0, 'two\nlines', 'one') AS t", "if(id % 5 = 0, null, '') AS u").repartition(3)
    for codec in ("none", "gzip"):
        files.write_csv(rows, str(tmp_path / codec), codec)
    plain, packed = (files.read_csv(spark, str(tmp_path / codec), rows.schema) for codec in ("none", "gzip"))
    assert sorted(map(tuple, packed.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert [p for p in os.listdir(tmp_path / "gzip") if p.endswith(".csv.gz")]
