"""A version is seen whole or not at all."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources import publish

ROWS = [("A", 1.0, "2024-12-30"), ("B", 2.0, "2024-12-31"), ("A", 3.0, "2025-01-30")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "seller string, v double, day string").withColumn("day", F.to_date("day")).withColumn("report_date", F.col("day"))


@pytest.fixture
def table(spark):
    made = publish.PublishedTable(spark, "t_published", "report_date", ("seller", "report_date"), "day")
    made.drop()
    yield made
    made.drop()


def seen(table):
    return sorted((r["seller"], r["v"], str(r["report_date"])) for r in table.spark.table(table.name).collect())


def test_versions_replace_partitions(spark, table):
    table.replace(frame(spark, ROWS))
    assert seen(table) == sorted(ROWS)
    table.replace(frame(spark, [("C", 9.0, "2024-12-31")]))
    assert seen(table) == sorted([ROWS[0], ("C", 9.0, "2024-12-31"), ROWS[2]])
    assert sorted(spark.table(table.name).columns) == ["day", "report_date", "seller", "v"]


def test_a_day_that_vanished_goes_with_the_swap(spark, table):
    table.replace(frame(spark, ROWS))
    table.replace(frame(spark, [ROWS[0]]), scope=[dt.date(2024, 12, 30), dt.date(2024, 12, 31)])
    assert seen(table) == sorted([ROWS[0], ROWS[2]])
    table.replace(frame(spark, ROWS).filter("false"), scope=[dt.date(2024, 12, 30), dt.date(2025, 1, 30)])
    assert seen(table) == []


@pytest.mark.parametrize(
    "rows, fault",
    [
        ([("X", 1.0, "2024-12-30"), ("X", 2.0, "2024-12-30")], "duplicates: 1"),
        ([("X", 1.0, "2024-12-30"), ("Y", 2.0, "2025-03-01")], "outside: 1"),
    ],
)
def test_a_failing_audit_changes_nothing(spark, table, rows, fault):
    table.replace(frame(spark, ROWS))
    before = table.versions()
    with pytest.raises(publish.AuditFailed, match=fault):
        table.replace(frame(spark, rows), scope=["2024-12-30", "2024-12-31"])
    assert seen(table) == sorted(ROWS) and table.versions() == before


def test_misplaced_and_missing_rows(spark, table):
    moved = frame(spark, ROWS).withColumn("day", F.date_add("day", F.when(F.col("seller") == "B", 1).otherwise(0)))
    version = table.stage(moved)
    report = {(r["check"], r["partition"]): (r["found"], r["ok"]) for r in table.audit(version, least_rows=1).collect()}
    assert report["misplaced", "2024-12-31"] == (1, False) and report["misplaced", "2024-12-30"] == (0, True)
    few = {(r["check"], r["partition"]): r["ok"] for r in table.audit(version, least_rows=2).collect()}
    assert not few["rows", "2024-12-30"]
    with pytest.raises(publish.AuditFailed, match="misplaced: 1"):
        table.publish(version)
    assert not spark.catalog.tableExists(table.name)


def test_a_lost_writer_is_not_seen(spark, table):
    table.replace(frame(spark, ROWS))
    table.stage(frame(spark, [("Z", 0.0, "2024-12-30")]))  # and then nothing
    assert seen(table) == sorted(ROWS)
    assert table.vacuum() == 1 and table.vacuum() == 0
    assert seen(table) == sorted(ROWS)


def test_only_named_partitions_are_scanned(spark, table):
    table.replace(frame(spark, ROWS))
    table.replace(frame(spark, [("C", 9.0, "2024-12-31")]))
    text = spark.table(table.name).filter("report_date = '2025-01-30'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "_version" in text.split("PartitionFilters")[1].split("]")[0]


def test_null_partition_is_refused(spark, table):
    with pytest.raises(Exception, match="null in report_date"):
        table.stage(frame(spark, [("A", 1.0, None)]))


def test_many_partitions_in_one_version(spark, table):
    days = [(f"s{i}", float(i), str(dt.date(2024, 1, 1) + dt.timedelta(days=i))) for i in range(publish.PROPERTY_VALUES + 5)]
    table.replace(frame(spark, days))
    assert len(table.versions()) == len(days) and spark.table(table.name).count() == len(days)
