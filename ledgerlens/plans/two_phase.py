"""Month-by-month staging and feature runs over catalog tables.

A month is staged as day, partner and month grain, as mergeable states of its daily
measures, and as the carry behind it. A feature run then merges at most twelve states and
reads the days of no month but the one it reports on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.plans import carry, grains
from ledgerlens.plans.seller_features import features_from_states, states_of_days
from ledgerlens.sources.invoices import CURRENT, InvoicePolicy, analysis_rows, month_slice
from ledgerlens.sources.schema import NAMED_LAYOUT, to_logical
from ledgerlens.sources.store import replace_partitions

STAGE_KEY = "stage_month"
SOURCE_KEY = "source_month"


@dataclass(frozen=True)
class Tables:
    """Table names. Those left out are named after the table of days."""

    invoices: str
    rows: str
    days: str
    partners: str
    features: str
    months: str = ""
    states: str = ""
    carry: str = ""

    def __post_init__(self) -> None:
        for name in ("months", "states", "carry"):
            if not getattr(self, name):
                object.__setattr__(self, name, f"{self.days}_{name}")


def rows_by_month(typed: DataFrame, source_month: Column) -> DataFrame:
    """Typed rows with the month they are dated in and the source partition they came in."""
    return typed.withColumns({STAGE_KEY: F.date_format("report_date", "yyyyMM"), SOURCE_KEY: source_month.cast("string")})


def grains_of_months(rows: DataFrame, months: Sequence[str], policy: InvoicePolicy = CURRENT) -> tuple[DataFrame, DataFrame]:
    """Day and partner grain of the given months, whichever partitions their rows came in."""
    dated = rows.filter(F.col(STAGE_KEY).isin(list(months)))
    days = grains.day_grain(dated)
    partners = grains.partner_month(dated, policy.filter_pairs)
    return (
        days.withColumn(STAGE_KEY, F.date_format("report_date", "yyyyMM")),
        partners.withColumn(STAGE_KEY, F.date_format("month_start", "yyyyMM")),
    )


def _partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    if not spark.catalog.tableExists(table):
        return []
    listed = (r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())  # bounded by the months
    return [dict(part.split("=", 1) for part in line.split("/")) for line in listed]


def _refresh_rows(spark: SparkSession, tables: Tables, invoices: DataFrame, month: str, policy: InvoicePolicy) -> set[str]:
    """Write the rows of one source partition again; the months it touches or touched."""
    before = {p[STAGE_KEY] for p in _partitions(spark, tables.rows) if p[SOURCE_KEY] == month}
    rows = rows_by_month(analysis_rows(invoices, policy), F.lit(month))
    written = Observation()
    rows = rows.observe(written, F.collect_set(STAGE_KEY).alias("months"))
    replace_partitions(rows, tables.rows, [SOURCE_KEY, STAGE_KEY])
    after = set(written.get["months"])
    for gone in sorted(before - after):
        spark.sql(f"ALTER TABLE {tables.rows} DROP IF EXISTS PARTITION ({SOURCE_KEY} = '{month}', {STAGE_KEY} = '{gone}')")
    return before | after


def stage(
    spark: SparkSession,
    tables: Tables,
    run_dates: Sequence[dt.date],
    policy: InvoicePolicy = CURRENT,
    layout: dict[str, str] = NAMED_LAYOUT,
) -> None:
    """Build the day and partner grains of each month a run date reports on.

    Each run date reads its own source partition, once, into the table of slim rows,
    which is partitioned by source partition and by the month the rows are dated in. A
    month's grains then come from all rows dated in it, whichever partition brought them.
    Months staged before that received or lost rows are staged again. Rows dated in a
    month that is not staged yet wait in the table of rows.
    """
    wanted = [dates.closed_month_key(d) for d in sorted(run_dates)]
    touched: set[str] = set()
    for run_date in sorted(run_dates):
        invoices = month_slice(to_logical(spark.table(tables.invoices), layout), run_date)
        touched |= _refresh_rows(spark, tables, invoices, dates.closed_month_key(run_date), policy)
    staged = _staged(spark, tables.days)
    again = sorted(set(wanted) | (touched & staged))
    for month in again:
        days, partners = grains_of_months(spark.table(tables.rows), [month], policy)
        _put(days, tables.days, month)
        _put(partners, tables.partners, month)
        _stage_states(spark, tables, month)
    # Months that were staged before there were states get theirs as well.
    months = sorted(staged | set(again))
    for month in sorted(set(months) - _staged(spark, tables.states)):
        _stage_states(spark, tables, month)
    # A changed month changes the carry behind it and behind all later ones.
    first = min({again[0], *(set(months) - _staged(spark, tables.carry))})
    for month in (m for m in months if m >= first):
        _stage_carry(spark, tables, month)


def _put(df: DataFrame, table: str, month: str) -> None:
    replace_partitions(df, table, [STAGE_KEY], {STAGE_KEY: [month]})


def _staged(spark: SparkSession, table: str) -> set[str]:
    return {p[STAGE_KEY] for p in _partitions(spark, table)}


def _of(spark: SparkSession, table: str, first: str, last: str | None = None) -> DataFrame:
    """The rows staged for one month, or for all months from the first to the last."""
    return spark.table(table).filter(F.col(STAGE_KEY).between(first, last or first)).drop(STAGE_KEY)


def _stage_states(spark: SparkSession, tables: Tables, month: str) -> None:
    days = _of(spark, tables.days, month)
    stage_month = F.lit(month).alias(STAGE_KEY)
    _put(grains.month_grain(grains.daily_sellers(days)).select("*", stage_month), tables.months, month)
    _put(states_of_days(days).select("*", stage_month), tables.states, month)


def _carry_before(spark: SparkSession, tables: Tables, month: str) -> DataFrame | None:
    """The carry behind the last staged month before ``month``."""
    before = max((m for m in _staged(spark, tables.carry) if m < month), default=None)
    return None if before is None else _of(spark, tables.carry, before)


def _stage_carry(spark: SparkSession, tables: Tables, month: str) -> None:
    parts = (_of(spark, t, month) for t in (tables.days, tables.partners, tables.months))
    behind = carry.advance(_carry_before(spark, tables, month), *parts)
    _put(behind.withColumn(STAGE_KEY, F.lit(month)), tables.carry, month)


def unread_partitions(spark: SparkSession, tables: Tables) -> list[str]:
    """Source partitions that were never read. Their rows, also those dated in months that
    are staged, are missing from all features."""
    read = {p[SOURCE_KEY] for p in _partitions(spark, tables.rows)}
    return sorted({p["partition_month"] for p in _partitions(spark, tables.invoices)} - read)


def build_features(
    spark: SparkSession, tables: Tables, run_dates: Sequence[dt.date], policy: InvoicePolicy = CURRENT
) -> None:
    """Feature rows of every run date, in one pass over staged tables.

    Windows merge the states of at most twelve months. Gaps and previous months see all
    history through the carry in front of the reported month, so a month-by-month run gives
    the same rows as one over everything.
    """
    last_days = sorted(dates.last_closed_day(d) for d in set(run_dates))
    reported = [d.strftime("%Y%m") for d in last_days]
    first = dates.month_start(last_days[0], 11).strftime("%Y%m")
    this_month: DataFrame | None = None
    for month in sorted(set(reported)):
        before = _carry_before(spark, tables, month)
        if before is None:
            before = _of(spark, tables.carry, "")  # nothing was staged earlier: no rows
        found = carry.raw_month(_of(spark, tables.days, month), _of(spark, tables.partners, month), before)
        this_month = found if this_month is None else this_month.unionByName(found)
    staged = (_of(spark, t, first, reported[-1]) for t in (tables.states, tables.months, tables.partners))
    features = features_from_states(*staged, this_month, run_dates, night=policy.night_flag)
    replace_partitions(features, tables.features, ["report_date"])


def run(
    spark: SparkSession,
    tables: Tables,
    run_dates: Sequence[dt.date],
    mode: str = "all",
    policy: InvoicePolicy = CURRENT,
    layout: dict[str, str] = NAMED_LAYOUT,
) -> None:
    """``staging``, ``features``, or ``all`` for both."""
    if mode not in ("staging", "features", "all"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode != "features":
        stage(spark, tables, run_dates, policy, layout)
    if mode != "staging":
        build_features(spark, tables, run_dates, policy)
