import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources import store

M1 = [("A", 100.0, "2024-12-30"), ("B", 200.0, "2024-12-31")]
M2 = [("A", 300.0, "2025-01-30"), ("C", 400.0, "2025-01-31")]
M3 = [("B", 500.0, "2025-02-27"), ("C", 600.0, "2025-02-28")]
M1_AGAIN = [("X", 999.0, "2024-12-30"), ("Y", 888.0, "2024-12-31")]
M2_M3_AGAIN = [
    ("P", 11.0, "2025-01-30"),
    ("Q", 22.0, "2025-01-31"),
    ("R", 33.0, "2025-02-27"),
    ("S", 44.0, "2025-02-28"),
]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "mst_seller string, daily_total_sales double, report_date string")
    return df.withColumn("report_date", F.to_date("report_date"))


@pytest.fixture
def table(spark):
    name = "t_store"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def content(spark, table):
    return sorted((r.mst_seller, r.daily_total_sales, str(r.report_date)) for r in spark.table(table).collect())


def test_replace_partitions_month_by_month(spark, table):
    def write(rows):
        store.replace_partitions(frame(spark, rows), table, ["report_date"])
        return content(spark, table)

    assert write(M1) == sorted(M1)
    assert write(M2) == sorted(M1 + M2)
    assert write(M3) == sorted(M1 + M2 + M3)
    assert write(M1_AGAIN) == sorted(M1_AGAIN + M2 + M3)
    assert write(M2_M3_AGAIN) == sorted(M1_AGAIN + M2_M3_AGAIN)
    assert write(M2_M3_AGAIN) == sorted(M1_AGAIN + M2_M3_AGAIN)
    assert spark.conf.get(store.OVERWRITE_MODE).lower() == "static"


def test_replace_partitions_ignores_column_order(spark, table):
    store.replace_partitions(frame(spark, M1), table, ["report_date"])
    shuffled = frame(spark, M2).select("report_date", "daily_total_sales", "mst_seller")
    store.replace_partitions(shuffled, table, ["report_date"])
    assert content(spark, table) == sorted(M1 + M2)


def test_scope_drops_a_day_that_vanished(spark, table):
    store.replace_partitions(frame(spark, M1 + M2), table, ["report_date"])
    days = [dt.date(2024, 12, 30), dt.date(2024, 12, 31)]
    store.replace_partitions(frame(spark, M1[:1]), table, ["report_date"], {"report_date": days})
    assert content(spark, table) == sorted(M1[:1] + M2)


def test_scope_with_no_rows_empties_it(spark, table):
    store.replace_partitions(frame(spark, M1 + M2), table, ["report_date"])
    none = frame(spark, M1).filter("false")
    store.replace_partitions(none, table, ["report_date"], {"report_date": [dt.date(2024, 12, 31)]})
    assert content(spark, table) == sorted(M1[:1] + M2)


def test_insert_overwrite_keeps_schema(spark, table):
    store.insert_overwrite(frame(spark, M1), table)
    store.insert_overwrite(frame(spark, M2), table)
    assert content(spark, table) == sorted(M2)


def test_overwrite_table(spark, table):
    store.overwrite_table(frame(spark, M1), table)
    store.overwrite_table(frame(spark, M2), table, ["report_date"])
    assert content(spark, table) == sorted(M2)


def test_upsert_replaces_and_adds(spark, table):
    keys = ["mst_seller", "report_date"]
    order = [F.desc("daily_total_sales")]
    store.upsert(frame(spark, M1 + M2), table, keys, "report_date", order)
    for _ in range(2):  # a repeated call changes nothing
        store.upsert(frame(spark, [("A", 1.0, "2024-12-30"), ("N", 2.0, "2024-12-30")]), table, keys, "report_date", order)
    assert content(spark, table) == sorted(
        [("A", 1.0, "2024-12-30"), ("N", 2.0, "2024-12-30"), ("B", 200.0, "2024-12-31"), *M2]
    )


def test_upsert_keeps_the_latest_of_equal_keys(spark, table):
    rows = [("A", 1.0, "2024-12-30"), ("A", 9.0, "2024-12-30"), ("A", 5.0, "2024-12-30")]
    store.upsert(frame(spark, rows), table, ["mst_seller"], "report_date", latest=[F.desc("daily_total_sales")])
    assert content(spark, table) == [("A", 9.0, "2024-12-30")]


def test_upsert_rejects_null_keys(spark, table):
    with pytest.raises(Exception, match="null in a key"):
        store.upsert(frame(spark, [(None, 1.0, "2024-12-30")]), table, ["mst_seller"], "report_date", [F.desc("daily_total_sales")])


def test_upsert_features_adds_audit_columns(spark, table):
    features = frame(spark, M1).withColumnRenamed("mst_seller", "cusid")
    store.upsert_features(features, table, [F.desc("daily_total_sales")])
    store.upsert_features(features.withColumn("daily_total_sales", F.lit(0.0)), table, [F.desc("daily_total_sales")])
    rows = spark.table(table).collect()
    assert len(rows) == 2 and {r.daily_total_sales for r in rows} == {0.0}
    assert {str(r.processing_dt) for r in rows} == {"2024-12-30 00:00:00", "2024-12-31 00:00:00"}
    assert all(r.ds_etl_job_id is None and r.ds_etl_timestamp is not None for r in rows)


def test_availability_gate(spark):
    rows = frame(spark, M1)
    sources = {"late": (rows, "report_date"), "empty": (rows.filter("false"), "report_date")}
    status = store.availability(sources, [dt.date(2024, 12, 21), dt.date(2024, 12, 31)])
    assert {(r.source, str(r.run_date)): r.ok for r in status.collect()} == {
        ("late", "2024-12-21"): True,
        ("late", "2024-12-31"): False,
        ("empty", "2024-12-21"): False,
        ("empty", "2024-12-31"): False,
    }
    store.require_available({"late": sources["late"]}, [dt.date(2024, 12, 20)])
    with pytest.raises(RuntimeError, match="empty"):
        store.require_available(sources, [dt.date(2024, 12, 21)])


def test_upsert_finds_the_old_row_of_a_moved_key(spark, table):
    order = [F.desc("daily_total_sales")]
    store.upsert(frame(spark, M1 + M2[1:]), table, ["mst_seller"], "report_date", order)
    store.upsert(frame(spark, [("A", 7.0, "2025-01-31"), ("D", 1.0, "2024-12-31")]), table, ["mst_seller"], "report_date", order)
    want = [("A", 7.0, "2025-01-31"), ("B", 200.0, "2024-12-31"), ("C", 400.0, "2025-01-31"), ("D", 1.0, "2024-12-31")]
    assert content(spark, table) == want
    # A's old partition lost its last row and is gone.
    assert sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()) == ["report_date=2024-12-31", "report_date=2025-01-31"]
    for _ in range(2):
        store.upsert(frame(spark, [("A", 8.0, "2024-12-30")]), table, ["mst_seller"], "report_date", order)
    assert content(spark, table) == [("A", 8.0, "2024-12-30"), *want[1:]]


def test_upsert_reads_only_the_partitions_of_its_keys(spark, table):
    order = [F.desc("daily_total_sales")]
    store.upsert(frame(spark, M1 + M2 + M3).filter("mst_seller <> 'A'"), table, ["mst_seller", "daily_total_sales"], "report_date", order)
    source = frame(spark, [("B", 500.0, "2024-12-31")])
    index = store.KeyIndex(spark, table, ["mst_seller", "daily_total_sales"], "report_date")
    assert [str(d) for d in index.places(source)] == ["2025-02-27"]
    here = spark.table(table).filter(F.col("report_date").isin(index.places(source)))
    assert "2025-02-27" in here._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]


def test_upsert_repairs_a_merge_that_was_lost(spark, table):
    """Keys were noted for their new partition, but the table was not written."""
    order = [F.desc("daily_total_sales")]
    store.upsert(frame(spark, M1), table, ["mst_seller"], "report_date", order)
    store.KeyIndex(spark, table, ["mst_seller"], "report_date").add(frame(spark, [("A", 5.0, "2025-01-31")]))
    assert content(spark, table) == sorted(M1)
    store.upsert(frame(spark, [("A", 6.0, "2025-02-28")]), table, ["mst_seller"], "report_date", order)
    assert content(spark, table) == [("A", 6.0, "2025-02-28"), M1[1]]
    # After other writers the index is made anew.
    store.overwrite_table(frame(spark, M3), table, ["report_date"])
    index = store.KeyIndex(spark, table, ["mst_seller"], "report_date", anew=True)
    assert sorted(str(d) for d in index.places(frame(spark, M3))) == ["2025-02-27", "2025-02-28"]
