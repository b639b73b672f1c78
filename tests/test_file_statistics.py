"""Footers answer what they can; only the rest is read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources import file_statistics as fs
from ledgerlens.sources import store

RUNS = [dt.date(2024, 1, 10), dt.date(2024, 3, 1), dt.date(2024, 6, 1), dt.date(2030, 1, 1)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """January and February are aligned, March holds a day of April, May has no dates."""
    days = [("202401", "2024-01-05"), ("202401", "2024-01-25"), ("202402", "2024-02-01"), ("202402", "2024-02-28"), ("202403", "2024-03-30"),
            ("202403", "2024-04-02"), ("202405", None)]
    frame = spark.createDataFrame(days, "month string, day string").withColumn("day", F.to_date("day"))
    path = str(tmp_path_factory.mktemp("stats") / "t")
    frame.coalesce(1).write.partitionBy("month").parquet(path)
    return path


def test_facts_come_from_footers(spark, folder):
    got = fs.facts(spark, folder, "month", "day")
    assert [(f.value, f.rows, str(f.first), str(f.last)) for f in got] == [
        ("202401", 2, "2024-01-05", "2024-01-25"),
        ("202402", 2, "2024-02-01", "2024-02-28"),
        ("202403", 2, "2024-03-30", "2024-04-02"),
        ("202405", 1, "None", "None"),
    ]
    with fs._settings(spark, fs._FOOTERS):
        text = fs.footer_query(spark, folder, "month", "day", ["202401", "202403"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(day), MAX(day)]" in text
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_availability_equals_the_data(spark, folder):
    sources = {"t": (folder, "month", "day")}
    got = {(r["source"], r["run_date"]): r["ok"] for r in fs.availability_from_files(spark, sources, RUNS).collect()}
    rows = spark.read.parquet(folder)
    want = {(r["source"], r["run_date"]): r["ok"] for r in store.availability({"t": (rows, "day")}, RUNS).collect()}
    assert got == want


def test_only_open_partitions_are_read(spark, folder):
    # From 11 to 20 January: the footers of January alone do not tell.
    text = fs.availability_from_files(spark, {"t": (folder, "month", "day")}, RUNS[:1])._jdf.queryExecution().executedPlan().toString()
    assert "202401" in text and "202402" not in text and "202403" not in text
    settled = fs.availability_from_files(spark, {"t": (folder, "month", "day")}, RUNS[2:])._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in settled


def test_alignment_equals_the_data(spark, folder):
    status = fs.alignment_from_files(spark, folder, "month", "day")
    text = status._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "202403" in text.split("PartitionFilters")[1].split("]")[0]
    rows = spark.read.schema("day date, month string").parquet(folder)
    assert sorted(map(str, status.collect())) == sorted(map(str, store.partition_alignment(rows, "month", "day").collect()))


def test_other_kinds_are_refused(spark, tmp_path):
    path = str(tmp_path / "ts")
    spark.sql("SELECT '202401' AS month, timestamp'2024-01-01 10:00:00' AS ts").write.partitionBy("month").parquet(path)
    with pytest.raises(TypeError, match="timestamp"):
        fs.facts(spark, path, "month", "ts")
