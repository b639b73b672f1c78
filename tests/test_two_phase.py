"""Month-by-month runs over tables equal one run over everything."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import grains, two_phase
from ledgerlens.plans.seller_features import from_invoices, seller_features
from ledgerlens.sources import star_tables
from ledgerlens.sources.invoices import CURRENT, FIRST, SECOND, analysis_rows
from ledgerlens.sources.schema import NAMED_LAYOUT

SF_DIR = "/root/testdata/sf0.001"
RUNS = [dt.date(1997, 12, 1), dt.date(1998, 1, 1)]
MONTHS = [dt.date(1996 + (m + 9) // 12, (m + 9) % 12 + 1, 1) for m in range(15)]  # October 1996 on


@pytest.fixture(scope="module")
def tables(spark):
    logical = star_tables.invoices(spark, SF_DIR).filter("partition_month between '199610' and '199712'")
    physical = logical.toDF(*[NAMED_LAYOUT[c] for c in logical.columns])
    names = two_phase.Tables("tp_invoices", "tp_rows", "tp_days", "tp_partners", "tp_features")
    for name in (names.invoices, names.rows, names.days, names.partners, names.features):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    physical.write.partitionBy("partition_month").saveAsTable(names.invoices)
    yield names
    for name in (names.invoices, names.rows, names.days, names.partners, names.features):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def close(one, other):
    """All columns, in any order of rows; numbers up to what the order of adding changes."""
    assert sorted(one.columns) == sorted(other.columns)
    keys = ["report_date", "mst_seller"]
    a, b = (df.select(*keys, *sorted(set(one.columns) - set(keys))).toPandas().sort_values(keys) for df in (one, other))
    assert a[keys].astype(str).values.tolist() == b[keys].astype(str).values.tolist()
    for column in a.columns[2:]:
        x, y = a[column].to_numpy(), b[column].to_numpy()
        if a[column].dtype == object:
            assert [str(v) for v in x] == [str(v) for v in y], column
        else:
            np.testing.assert_allclose(x.astype(float), y.astype(float), rtol=1e-6, atol=1e-6, err_msg=column)
    return len(a) > 0


def test_staged_run_equals_direct_run(spark, tables):
    two_phase.run(spark, tables, [*MONTHS[1:], RUNS[-1]], mode="staging")
    two_phase.run(spark, tables, RUNS, mode="features")
    typed = analysis_rows(star_tables.invoices(spark, SF_DIR), CURRENT).filter(
        "report_date between date'1996-10-01' and date'1997-12-31'"
    )
    direct = seller_features(grains.day_grain(typed), grains.partner_month(typed), RUNS)
    staged = spark.table(tables.features)
    assert {str(r[0]) for r in staged.select("report_date").distinct().collect()} == {"1997-11-30", "1997-12-31"}
    assert close(staged, direct)

    before = spark.table(tables.days).count()
    two_phase.run(spark, tables, RUNS, mode="all")
    assert spark.table(tables.days).count() == before
    assert close(spark.table(tables.features), direct)


def test_misplaced_rows_are_staged_in_their_month(spark):
    """Invoices one and two partitions early or late give the table of a one-pass run."""
    names = two_phase.Tables("mp_invoices", "mp_rows", "mp_days", "mp_partners", "mp_features")
    for name in vars(names).values():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    logical = star_tables.invoices(spark, SF_DIR).filter("partition_month between '199708' and '199712'")
    away = F.pmod(F.xxhash64("invoice_id"), F.lit(10)).cast("int")
    moved = F.when(away < 4, F.element_at(F.array(*[F.lit(k) for k in (-2, -1, 1, 2)]), away + 1)).otherwise(0)
    month = F.date_format(F.add_months(F.to_date(F.concat("partition_month", F.lit("01")), "yyyyMMdd"), moved), "yyyyMM")
    placed = F.when(month < "199708", "199708").when(month > "199712", "199712").otherwise(month)
    logical = logical.withColumn("partition_month", placed)
    try:
        physical = logical.toDF(*[NAMED_LAYOUT[c] for c in logical.columns])
        physical.write.partitionBy("partition_month").saveAsTable(names.invoices)
        runs = [dt.date(1997, m, 1) for m in (9, 10, 11, 12)] + [dt.date(1998, 1, 1)]
        for run_date in runs:  # one at a time: later partitions bring rows of earlier months
            two_phase.run(spark, names, [run_date], mode="staging")
        two_phase.run(spark, names, runs[-1:], mode="features")
        typed = analysis_rows(star_tables.invoices(spark, SF_DIR), CURRENT).filter(
            "report_date between date'1997-08-01' and date'1997-12-31'"
        )
        direct = seller_features(grains.day_grain(typed), grains.partner_month(typed), runs[-1:])
        assert close(spark.table(names.features), direct)
        before = sorted(map(str, spark.table(names.days).collect()))
        two_phase.run(spark, names, runs, mode="staging")
        assert sorted(map(str, spark.table(names.days).collect())) == before
    finally:
        for name in vars(names).values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_second_generation_has_the_night_verdict(spark):
    typed = analysis_rows(star_tables.invoices(spark, SF_DIR), SECOND)
    table = seller_features(grains.day_grain(typed), grains.partner_month(typed, True), RUNS[1:], night=True)
    assert "is_night_flagged" in table.columns and len(table.columns) == 969 + 5


def test_first_generation_looks_up_originals(spark):
    table = from_invoices(star_tables.order_invoices(spark, SF_DIR), RUNS[1:], FIRST)
    assert len(table.columns) == 969 + 5
    daily = grains.daily_sellers(grains.day_grain(analysis_rows(star_tables.order_invoices(spark, SF_DIR), FIRST)))
    year = daily.filter("report_date between date'1997-01-01' and date'1997-12-31'")
    want = {r[0]: r[1] for r in year.groupBy("mst_seller").sum("daily_total_sales").collect()}
    got = {r[0]: r[1] for r in table.select("mst_seller", "daily_total_sales_sum_l12m").collect()}
    assert got == want and got


def test_unknown_mode(spark, tables):
    with pytest.raises(ValueError, match="mode"):
        two_phase.run(spark, tables, RUNS, mode="some")
