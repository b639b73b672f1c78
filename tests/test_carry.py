"""A month's run needs its own rows and the carry table, and leaves the next carry."""

import datetime as dt

import pytest

from ledgerlens.plans import two_phase
from ledgerlens.sources import star_tables
from ledgerlens.sources.schema import NAMED_LAYOUT
from tests.test_two_phase import close

SF_DIR = "/root/testdata/sf0.001"
MONTHS = [dt.date(1997, m, 1) for m in range(8, 12)]  # August to November 1997


@pytest.fixture(scope="module")
def tables(spark):
    names = two_phase.Tables("ca_invoices", "ca_rows", "ca_days", "ca_partners", "ca_features")
    for name in vars(names).values():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    logical = star_tables.invoices(spark, SF_DIR).filter("partition_month between '199706' and '199711'")
    logical.toDF(*[NAMED_LAYOUT[c] for c in logical.columns]).write.partitionBy("partition_month").saveAsTable(names.invoices)
    yield names
    for name in vars(names).values():
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def copy(spark, table):
    rows = spark.table(table)
    return spark.createDataFrame(rows.collect(), rows.schema)


def partitions(spark, table):
    return sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def test_days_of_earlier_months_are_not_read(spark, tables):
    assert two_phase.unread_partitions(spark, tables) == [f"1997{m:02}" for m in range(6, 12)]
    two_phase.run(spark, tables, MONTHS, mode="staging")
    assert two_phase.unread_partitions(spark, tables) == ["199706", "199711"]
    last = MONTHS[-1]
    two_phase.run(spark, tables, [last], mode="features")
    want = copy(spark, tables.features)
    kept = f"{two_phase.STAGE_KEY}={last.replace(day=1) - dt.timedelta(days=1):%Y%m}"
    # All days but the reported month's, and all carries but the one in front of it, go.
    for table, needed in ((tables.days, {kept}), (tables.carry, {kept, f"{two_phase.STAGE_KEY}=199709"})):
        for part in partitions(spark, table):
            if part not in needed:
                key, value = part.split("=")
                spark.sql(f"ALTER TABLE {table} DROP PARTITION ({key} = '{value}')")
    spark.sql(f"DROP TABLE {tables.features}")
    two_phase.run(spark, tables, [last], mode="features")
    assert close(spark.table(tables.features), want)


def test_an_early_month_that_changes_moves_later_carries(spark, tables):
    # The first months arrive last; then everything equals a run in order.
    for name in (tables.rows, tables.days, tables.partners, tables.features, tables.months, tables.states, tables.carry):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    two_phase.run(spark, tables, MONTHS[2:], mode="staging")
    before = sorted(map(str, spark.table(tables.carry).collect()))
    two_phase.run(spark, tables, MONTHS[:2], mode="staging")
    after = sorted(map(str, spark.table(tables.carry).collect()))
    assert len(after) > len(before) and partitions(spark, tables.carry) == partitions(spark, tables.days)
    two_phase.run(spark, tables, MONTHS, mode="staging")
    assert sorted(map(str, spark.table(tables.carry).collect())) == after
