"""Versions, marts, the layered run and the streamed layers."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lakemill.operators.versions import VersionTable, dense_ids, merge_versions
from lakemill.plans import layers, marts
from lakemill.session import settle
from lakemill.sources import bronze, files
from lakemill.streaming import changes
from tests.test_cleaning import ENCOUNTER_COLUMNS, encounter

D1, D2, D3 = "2024-06-01", "2024-06-02", "2024-06-03"
BATCH = "place int, key string, amount int, note string"


def merge(spark, existing, rows, day):
    batch = spark.createDataFrame(rows, BATCH)
    merged = merge_versions(existing, batch, day, ["place"], ["key"], ["amount"])
    return settle(merged.snapshot) if merged.snapshot is not None else None, merged


def versions(df):
    return sorted(
        (r.key, r.amount, str(r.effective_start_date), str(r.effective_end_date), r.is_current, r._scd_surrogate_key) for r in df.collect()
    )


def test_first_load_keeps_the_last_row_of_a_key(spark):
    table, _ = merge(spark, None, [(1, "a", 1, "x"), (2, "b", 5, "x"), (3, "a", 2, "y")], D1)
    assert versions(table) == [("a", 2, D1, "None", True, 2), ("b", 5, D1, "None", True, 1)]


def test_merge(spark):
    table, _ = merge(spark, None, [(1, "a", 1, "x"), (2, "b", 5, "x"), (3, "c", 7, "x")], D1)
    table, merged = merge(spark, table, [(1, "a", 2, "x"), (2, "b", 5, "other"), (3, "d", 9, "x")], D2)
    assert versions(table) == [
        ("a", 1, D1, D2, False, 1), ("a", 2, D2, "None", True, 5), ("b", 5, D1, "None", True, 2),
        ("c", 7, D1, "None", True, 3), ("d", 9, D2, "None", True, 4),
    ]
    assert merged.statistics().first().asDict() == {"new": 1, "changed": 1, "expired": 1, "unchanged": 1}
    current = table.filter("is_current").groupBy("encounter_key").count().filter("count > 1")
    assert current.count() == 0


def test_same_batch_again_changes_nothing(spark):
    rows = [(1, "a", 1, "x"), (2, "b", 5, "x")]
    table, _ = merge(spark, None, rows, D1)
    again, merged = merge(spark, table, rows, D2)
    assert versions(again) == versions(table)
    assert merged.statistics().first().unchanged == 2


def test_empty_batch_and_early_load_date(spark):
    table, _ = merge(spark, None, [(1, "a", 1, "x")], D2)
    same, _ = merge(spark, table, [], D3)
    assert versions(same) == versions(table)
    with pytest.raises(ValueError, match="before the newest"):
        merge(spark, table, [(1, "a", 2, "x")], D1)


def test_returned_value_makes_a_third_version(spark):
    table, _ = merge(spark, None, [(1, "a", 1, "x")], D1)
    table, _ = merge(spark, table, [(1, "a", 2, "x")], D2)
    table, _ = merge(spark, table, [(1, "a", 1, "x")], D3)
    assert versions(table) == [("a", 1, D1, D2, False, 1), ("a", 1, D3, "None", True, 3), ("a", 2, D2, D3, False, 2)]


def test_dense_ids_without_gaps(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = dense_ids(rows, ["k desc"], "n", after=10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ids = [r.n for r in numbered.orderBy(F.desc("k")).collect()]
    assert ids == list(range(11, 1011))


def write_batch(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    lines = [",".join(ENCOUNTER_COLUMNS)] + [",".join("" if v is None else v for v in row) for row in rows]
    path = folder / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_bronze_keeps_text_and_numbers_rows_over_files(spark, tmp_path):
    folder = tmp_path / "in"
    write_batch(folder, "b.csv", encounter(Name="third"), encounter(Name="fourth"))
    write_batch(folder, "a.csv", encounter(Name="first", **{"Billing Amount": "-2500.00"}), encounter(Name="second"))
    rows = bronze.ingest(spark, str(folder), str(tmp_path / "out")).orderBy("_bronze_row_id").collect()
    assert [(r._bronze_row_id, r.Name) for r in rows] == [(1, "first"), (2, "second"), (3, "third"), (4, "fourth")]
    assert rows[0]["Billing Amount"] == "-2500.00"
    assert rows[0]._source_file == "a.csv" and rows[0]._ingestion_timestamp is not None
    with pytest.raises(FileNotFoundError):
        bronze.ingest(spark, str(tmp_path / "missing"), str(tmp_path / "out2"))


def test_bronze_row_ids_over_splits_of_one_file(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("k,v\n" + "".join(f"{i},{'x' * 50}\n" for i in range(5000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        layer = bronze.ingest(spark, str(path), str(tmp_path / "out"), multi_line=False)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert layer.count() == 5000
    assert layer.filter(F.col("k").cast("long") + 1 != F.col("_bronze_row_id")).count() == 0
    assert spark.read.parquet(str(tmp_path / "out" / "splits")).count() > 5


def test_layered_run_over_two_batches(spark, tmp_path):
    folder = tmp_path / "in"
    first = [encounter(Name=f"p{i}", Hospital="north" if i < 3 else "south", **{"Billing Amount": str(100 * i)}) for i in range(1, 5)]
    one = write_batch(folder, "1.csv", *first, first[0], encounter(Name=None))
    two = write_batch(folder, "2.csv", encounter(Name="p1", Hospital="north", **{"Billing Amount": "999.99"}), encounter(Name="p9", Hospital="north"))
    target = str(tmp_path / "out")
    record = layers.run_layers(spark, [(one, D1), (two, D2)], target).first()
    counts = (record.source_row_count, record.bronze_row_count, record.duplicate_count, record.null_count)
    assert counts == (8, 8, 1, 1)
    assert (record.silver_total_count, record.silver_current_count, record.silver_historical_count) == (6, 5, 1)
    assert (record.scd2_validation, record.gold_validation, record.overall_status, record.gold_tables_count) == ("PASS", "PASS", "PASS", 8)
    ranking = spark.read.parquet(f"{target}/gold/hospital_ranking").orderBy("rank").collect()
    assert [(r.rank, r.Hospital, float(r.total_billing)) for r in ranking] == [(1, "North", 1320.45), (2, "South", 700.0)]
    document = json.loads(spark.read.text(f"{target}/dashboard").first().value)
    assert document["kpis"]["total_patients"] == 5
    assert document["pipeline_status"]["data_quality_status"] == "PASS"
    assert [r["rank"] for r in document["hospital_ranking_top15"]] == [1, 2]
    assert spark.read.json(f"{target}/quality").first().overall_status == "PASS"


def test_failed_run_writes_its_record(spark, tmp_path):
    path = write_batch(tmp_path / "in", "1.csv", encounter(Name=None))
    target = str(tmp_path / "out")
    with pytest.raises(Exception):
        layers.run_layers(spark, [(path, D1)], target)
    record = spark.read.json(f"{target}/quality").first()
    assert record.overall_status == "FAIL" and record.bronze_row_count == 1


def test_marts_leave_expired_rows_out(spark):
    rows = [("a", "h1", 10000, True), ("a", "h1", 8000, False), ("b", "h1", 20000, True), ("c", "h2", 15000, True)]
    silver = spark.createDataFrame(rows, "Name string, Hospital string, `Billing Amount` int, is_current boolean")
    current = marts.current_rows(silver)
    found = marts.hospital_ranking(current).orderBy("rank").collect()
    assert [(r.Hospital, r.patient_count, int(r.total_billing), r.rank) for r in found] == [("h1", 2, 30000, 1), ("h2", 1, 15000, 2)]


def test_equal_totals_share_a_rank_but_not_a_position(spark):
    silver = spark.createDataFrame([("h1", 5), ("h2", 5), ("h3", 1)], "Hospital string, `Billing Amount` int")
    assert sorted(r["rank"] for r in marts.hospital_ranking(silver).collect()) == [1, 1, 3]
    assert sorted(r["rank"] for r in marts.hospital_positions(silver).collect()) == [1, 2, 3]


CHANGES = "user_id long, state string, at timestamp, event_id long"


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def streamed(spark, tmp_path, batches, buckets=8, **options):
    folder = tmp_path / "changes"
    for rows in batches:  # one file for each batch, taken in order of time
        spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(str(folder))
    stream = changes.read_stream(spark, str(folder), spark.createDataFrame([], CHANGES).schema, files_per_batch=1)
    store = changes.VersionStore(spark, str(tmp_path / "store"), "user_id", buckets)
    table = changes.apply_changes(stream, store, str(tmp_path / "log"), ["state"], ["at", "event_id"], **options)
    return store, sorted((r.user_id, r.state, r.at.minute, r.end_at and r.end_at.minute, r.is_current) for r in table.collect())


@pytest.mark.parametrize("hot_rows, buckets", [(None, 8), (1, 1)])
def test_late_change_splits_a_version(spark, tmp_path, hot_rows, buckets):
    batches = [
        [(1, "A", at(1), 1), (1, "A", at(5), 2), (2, "X", at(2), 3)],
        [(1, "B", at(3), 4)],
        [(2, "X", at(9), 5), (1, "B", at(4), 6)],
    ]
    options = {} if hot_rows is None else {"hot_rows": hot_rows}
    _, found = streamed(spark, tmp_path, batches, buckets, **options)
    assert found == [(1, "A", 1, 3, False), (1, "A", 5, None, True), (1, "B", 3, 5, False), (2, "X", 2, None, True)]


def stored_versions(store):
    return sorted((r.user_id, r.state, r.at.minute, r.end_at and r.end_at.minute, r.is_current) for r in store.latest().collect())


def test_batch_run_again_gives_the_same_snapshot(spark, tmp_path):
    store, found = streamed(spark, tmp_path, [[(1, "A", at(1), 1)], [(1, "B", at(3), 2)]])
    store.apply(spark.createDataFrame([(1, "B", at(3), 2)], CHANGES), ["state"], ["at", "event_id"])
    assert stored_versions(store) == found
    store.apply(spark.createDataFrame([], CHANGES), ["state"], ["at", "event_id"])
    assert stored_versions(store) == found


def test_a_file_that_comes_again_gives_its_events_once(spark, tmp_path):
    rows = [(k, "A", at(k % 50), k) for k in range(100)]
    first, second = rows[:60], rows[40:]  # the second file brings some of the first again
    for name, part in (("a", first), ("b", second)):
        spark.createDataFrame(part, CHANGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for run in range(3):
        if run == 1:  # all files once more, after the first run has ended
            spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if run == 2:  # and an event much older than all others, which is not lost
            spark.createDataFrame([(7, "old", dt.datetime(2001, 1, 1), 777)], CHANGES).write.mode("append").parquet(str(tmp_path / "in"))
        stream = changes.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], CHANGES).schema, files_per_batch=1)
        got = changes.run_to_files(changes.delivered_once(stream, ["event_id"]), str(tmp_path / "out"), str(tmp_path / "log"))
        assert sorted(r.event_id for r in got.collect()) == sorted([k for k in range(100)] + ([777] if run == 2 else []))


def bucket_files(folder):
    return {str(p) for p in folder.rglob("*.parquet")}


def test_a_batch_reads_and_replaces_its_own_buckets_only(spark, tmp_path):
    store = changes.VersionStore(spark, str(tmp_path / "store"), "user_id", buckets=16)
    rows = [(k, "A", at(k % 50), k) for k in range(200)] + [(None, "A", at(1), 1)]
    store.apply(spark.createDataFrame(rows, CHANGES), ["state"], ["at", "event_id"])
    before = bucket_files(tmp_path / "store")
    one = spark.createDataFrame([(7, "B", at(55), 900), (None, "B", at(55), 901)], CHANGES)
    touched = store.touched(one)
    plan = store.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan and len(touched) <= 2
    store.apply(one, ["state"], ["at", "event_id"])
    gone = before - bucket_files(tmp_path / "store")
    assert 0 < len({p.split("_bucket=")[1].split("/")[0] for p in gone}) <= 2
    latest = store.latest()
    assert latest.count() == 203 and latest.where("is_current").count() == 201
    assert latest.where("user_id IS NULL AND NOT is_current").count() == 1


def test_merge_of_a_part_of_the_keys_writes_their_buckets(spark, tmp_path):
    table = VersionTable(spark, str(tmp_path / "table"), buckets=512)
    rows = spark.range(2000).selectExpr("cast(id as int) AS place", "'k' || id AS key", "cast(id as int) AS amount", "repeat('n', 200) AS note")
    merged = table.merge(rows, D1, ["place"], ["key"], ["amount"])
    assert merged.statistics().first().asDict() == {"new": 2000, "changed": 0, "expired": 0, "unchanged": 0}
    before = bucket_files(tmp_path / "table")
    size = sum(os.path.getsize(p) for p in before)
    some = rows.where("place % 100 = 0").selectExpr("place", "key", "IF(place % 200 = 0, amount + 1, amount) AS amount", "note")
    some = some.unionAll(spark.createDataFrame([(5000, "new", 1, "x")], BATCH))
    merged = table.merge(some, D2, ["place"], ["key"], ["amount"])
    assert merged.statistics().first().asDict() == {"new": 1, "changed": 10, "expired": 10, "unchanged": 10}
    written = sum(os.path.getsize(p) for p in bucket_files(tmp_path / "table") - before)
    assert 0 < written < 0.1 * size
    whole, _ = merge(spark, None, [tuple(r) for r in rows.collect()], D1)
    whole, _ = merge(spark, whole, [tuple(r) for r in some.collect()], D2)
    assert versions(table.read()) == versions(whole)
    again = table.merge(some, D3, ["place"], ["key"], ["amount"])
    assert again.statistics().first().unchanged == 21 and versions(table.read()) == versions(whole)
    with pytest.raises(ValueError, match="before the newest"):
        table.merge(some.withColumn("amount", F.lit(0)), D1, ["place"], ["key"], ["amount"])


def test_listing_and_checked_copy(spark, tmp_path):
    source = spark.range(100)
    assert files.copy_checked(source, str(tmp_path / "copy")).first().verified
    listed = files.list_files(spark, str(tmp_path / "copy"), "*.parquet").agg(F.sum("size_bytes"), F.count("*")).first()
    assert listed[0] > 0 and listed[1] > 0


def test_layered_run_leaves_no_copies_of_its_layers(spark, tmp_path):
    """Rows that the silver layer has are not kept in the shared folder, over a first and a second batch."""
    folder = tmp_path / "in"
    one = write_batch(folder, "1.csv", *[encounter(Name=f"p{i}") for i in range(4)])
    two = write_batch(folder, "2.csv", encounter(Name="p1", **{"Billing Amount": "9.99"}), encounter(Name="p7"))
    shared = spark.conf.get("spark.checkpoint.dir") + "/lakemill"
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    record = layers.run_layers(spark, [(one, D1), (two, D2)], str(tmp_path / "out")).first()
    assert (record.silver_total_count, record.silver_current_count, record.silver_historical_count) == (6, 5, 1)
    left = {name.rpartition("-")[0] for name in set(os.listdir(shared)) - before if os.listdir(f"{shared}/{name}")}
    assert not left & {"distinct", "incoming", "bucket-rows", "changes", "csv-lines"}
    silver = spark.read.parquet(str(tmp_path / "out" / "silver"))
    assert sorted((r.Name, r._source_file) for r in silver.collect())[:3] == [("P0", "1.csv"), ("P1", "1.csv"), ("P1", "2.csv")]


def test_rows_with_text_lineage_are_grouped_without_a_sort(spark, tmp_path):
    from lakemill.operators import clean

    path = write_batch(tmp_path / "in", "1.csv", encounter(Name="a"), encounter(Name="a"), encounter(Name="b"))
    raw = bronze.ingest(spark, path, str(tmp_path / "out"))
    distinct = clean.distinct_encounters(raw, layers.ROW_ID)
    assert "SortAggregate" not in distinct._jdf.queryExecution().executedPlan().toString()
    got = distinct.orderBy(layers.ROW_ID).collect()
    assert [(r.Name, r._bronze_row_id, r._source_file, r._copies) for r in got] == [("A", 1, "1.csv", 2), ("B", 3, "1.csv", 1)]
    assert distinct.columns[-3:] == ["_copies", "_bad_dates", "_negative"]


def test_first_merge_shuffles_rows_once_for_the_last_of_a_key(spark, tmp_path, monkeypatch):
    from lakemill.operators import versions

    calls = []
    plain = versions.last_per_key
    monkeypatch.setattr(versions, "last_per_key", lambda *a: calls.append(1) or plain(*a))
    batch = spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 5, "x")], BATCH)
    VersionTable(spark, str(tmp_path / "t"), 4).merge(batch, D1, ["place"], ["key"], ["amount"])
    assert len(calls) == 1


def test_first_batch_by_row_ids_is_numbered_before_its_rows_move(spark, tmp_path, monkeypatch):
    rows = [(k, f"k{k * 7 % 40}", k % 5 if k % 11 else None, f"note {k}") for k in range(1, 200)] + [(0, None, 1, "z")]
    batch = settle(spark.createDataFrame(rows, BATCH).withColumn("place", F.col("place").cast("bigint")))
    stored = {}

    def watched(df, label="settled"):
        stored.setdefault(label, df.columns)
        return settle(df, label)

    monkeypatch.setattr("lakemill.operators.versions.settle", watched)
    monkeypatch.setattr("lakemill.operators.ordered.settle", watched)
    tables = {}
    for name, row_id in (("plain", None), ("ids", "place")):
        table = VersionTable(spark, str(tmp_path / name), 4)
        stored.clear()
        found = table.merge(batch, D1, ["place"], ["key"], ["amount"], row_id=row_id)
        got = found.statistics().first().asDict()
        assert got == {"new": 41, "changed": 0, "expired": 0, "unchanged": 0}
        tables[name] = table
    assert stored == {"incoming": ["_key", "place"], "positions": ["place", "_at"]}  # of the second: no whole rows
    columns = sorted(tables["plain"].read().columns)
    rows_of = lambda t: sorted(map(str, t.read().select(columns).collect()))
    assert columns == sorted(tables["ids"].read().columns) and rows_of(tables["plain"]) == rows_of(tables["ids"])
    more = settle(spark.createDataFrame([(900, "k1", 77, "n"), (901, "new", 1, "n")], BATCH))
    for table in tables.values():
        table.merge(more, D2, ["place"], ["key"], ["amount"], row_id="place")
    assert rows_of(tables["plain"]) == rows_of(tables["ids"]) and len(rows_of(tables["ids"])) == 43
    with pytest.raises(ValueError, match="before the newest"):
        tables["ids"].merge(more, D1, ["place"], ["key"], ["amount"], row_id="place")
