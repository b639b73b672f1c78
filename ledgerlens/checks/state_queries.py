"""Queries that start from tables a month-by-month run keeps: states, carry, buyer sets."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.checks import base_sql as q
from ledgerlens.checks import inputs
from ledgerlens.checks.aggregate_queries import EXACT_FUNCTIONS, PERIOD_FUNCTIONS, RUNS, _period_sql
from ledgerlens.checks.feature_queries import RAW_COLUMNS, RAW_COUNTS, typed_list, uniform
from ledgerlens.checks.join_queries import BALANCES, balance_days
from ledgerlens.checks.registry import ORACLES, plain, query, snap_sql
from ledgerlens.functions import dates
from ledgerlens.operators import month_states
from ledgerlens.plans import buyer_sets, carry, grains, seller_features
from ledgerlens.sources import star_tables
from ledgerlens.sources.invoices import CURRENT, FIRST, SECOND, InvoicePolicy, analysis_rows
from ledgerlens.sources.store import bucketed, materialize, release

REPORTED = [dates.last_closed_day(d) for d in RUNS]


def moved(sql: str, run: dt.date) -> str:
    """A statement about ``inputs.RUN_DATE`` as one about another run date."""
    last = dates.last_closed_day(run)
    starts = dates.trailing_starts(last)
    there = {q.LAST_DAY: str(last)} | {start: str(starts[name]) for name, start in q.PERIODS.items()}
    return re.sub("|".join(map(re.escape, there)), lambda m: there[m[0]], sql)


def _written(spark: SparkSession, sf_dir: str, policy: InvoicePolicy = CURRENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Day, partner and month grain as tables, days and months bucketed by seller."""
    invoices = star_tables.order_invoices if policy.sale == "adjusted" else star_tables.invoices
    days, partners = seller_features.written_grains(analysis_rows(invoices(spark, sf_dir), policy), policy.filter_pairs)
    months = grains.month_grain(grains.daily_sellers(days))
    return days, partners, bucketed(months, "months", "mst_seller", ["mst_seller", "report_date"])


def _carries(days: DataFrame, partners: DataFrame, months: DataFrame, last_days: list[dt.date]) -> Mapping[dt.date, DataFrame]:
    """The carry in front of each month: written once for all history before the first, then
    advanced by one month's rows at a time."""
    out: dict[dt.date, DataFrame] = {}
    at = dates.month_start(last_days[0])
    table = materialize(carry.advance(None, *(_before(f, c, at) for f, c in _dated(days, partners, months))), "carry")
    while True:
        if any(dates.month_start(d) == at for d in last_days):
            out[at] = table
        if at >= dates.month_start(last_days[-1]):
            return out
        table = materialize(carry.advance(table, *(_month(f, c, at) for f, c in _dated(days, partners, months))), "carry")
        at = dates.month_start(at, -1)


def _dated(days: DataFrame, partners: DataFrame, months: DataFrame) -> list[tuple[DataFrame, str]]:
    return [(days, "report_date"), (partners, "month_start"), (months, "report_date")]


def _before(frame: DataFrame, column: str, day: dt.date) -> DataFrame:
    return frame.filter(F.col(column) < F.lit(day))


def _month(frame: DataFrame, column: str, start: dt.date) -> DataFrame:
    return frame.filter((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(dates.month_start(start, -1))))


def _raw_months(spark: SparkSession, days: DataFrame, partners: DataFrame, months: DataFrame, last_days: list[dt.date]) -> DataFrame:
    out: DataFrame | None = None
    for start, before in _carries(days, partners, months, last_days).items():
        found = carry.raw_month(_month(days, "report_date", start), _month(partners, "month_start", start), before)
        out = found if out is None else out.unionByName(found)
    return out


def _wide(spark: SparkSession, sf_dir: str, runs: list[dt.date], policy: InvoicePolicy = CURRENT) -> DataFrame:
    """The feature table from month states and carry, as a month-by-month run builds it.

    States are made of the months that a window of the runs holds: no other is ever merged.
    """
    last_days = [dates.last_closed_day(d) for d in runs]
    days, partners, months = _written(spark, sf_dir, policy)
    merged = days.filter(dates.within("report_date", dates.month_start(min(last_days), 11), max(last_days)))
    states = bucketed(seller_features.states_of_days(merged), "states", "mst_seller", ["mst_seller", "report_date", "metric"])
    release(spark)
    raw = _raw_months(spark, days, partners, months, last_days)
    release(spark)
    return uniform(seller_features.features_from_states(states, months, partners, raw, runs, night=policy.night_flag))


@query("backfill_wide", " UNION ALL ".join(f"SELECT * FROM ({moved(ORACLES['seller_features'], run)})" for run in RUNS))
def backfill_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 969 columns for three run dates, from at most twelve states of a month each."""
    return _wide(spark, sf_dir, RUNS)


NIGHT_FLAG_SQL = f"""night AS (SELECT mst_seller,
        count(*) FILTER (WHERE avg_invoices_per_day >= 100 AND avg_night_ratio >= 0.3) AS qualified,
        {q.mean_sql('avg_night_ratio')} AS avg_night, max(avg_night_ratio) AS max_night, {q.mean_sql('avg_core_ratio')} AS avg_core
        FROM monthly GROUP BY ALL)"""
NIGHT_COLUMNS = f"""{snap_sql('n.qualified', 4)} AS night_flag_qualified_months_l12m,
        {snap_sql('n.avg_night', 4)} AS avg_night_ratio_l12m, {snap_sql('n.max_night', 4)} AS max_night_ratio_l12m,
        {snap_sql('n.avg_core', 4)} AS avg_core_ratio_l12m, n.qualified >= 2 AS is_night_flagged"""


def _with_rules(typed: str, invoices: str | None = None) -> str:
    """The wide table's SQL under other rules: issued invoices count, buyer-side totals see
    those alone, and the night verdict is added. ``typed`` replaces the typed rows."""
    sql = ORACLES["seller_features"]
    if invoices is not None:
        sql = sql.replace(f"inv AS ({q.CTE['inv']})", invoices)
    sql = sql.replace(f"typed AS ({q.CTE['typed']})", f"typed AS ({typed})")
    for name in ("partner", "extremes"):
        sql = sql.replace(f"{name} AS ({q.CTE[name]})", f"{name} AS ({q.CTE[name].replace('FROM typed WHERE', 'FROM typed WHERE counts AND')})")
    sql = sql.replace(" SELECT DATE '", f", {NIGHT_FLAG_SQL} SELECT DATE '", 1)
    head, tail = sql.split("d.*, m.* EXCLUDE (mst_seller),", 1)
    return f"{head}d.*, m.* EXCLUDE (mst_seller), {NIGHT_COLUMNS}, {tail} LEFT JOIN night n ON n.mst_seller = d.mst_seller"


SECOND_TYPED = """
        SELECT trim(seller) AS mst_seller, trim(buyer) AS mst_buyer, CAST(coalesce(issue_ts, record_ts) AS DATE) AS report_date,
               hour(coalesce(issue_ts, record_ts)) AS hr, sale AS total_sales, tax AS tax_amt, discount AS discount_amt, with_vat,
               without_vat, payment, transport, coalesce(adjusted_with_vat, adjusted_without_vat) AS adjusted,
               CAST(status AS INT) = 1 AS counts,
               round(CAST(tax AS DOUBLE) / CAST(sale + discount + tax AS DOUBLE) * 100, 2) AS pct
        FROM inv WHERE trim(seller) IS NOT NULL AND coalesce(issue_ts, record_ts) IS NOT NULL"""


@query("seller_features_second", _with_rules(SECOND_TYPED))
def seller_features_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second generation: issued invoices on issue dates, with the night verdict."""
    return _wide(spark, sf_dir, [inputs.RUN_DATE], SECOND)


FIRST_TYPED = """
        SELECT seller AS mst_seller, buyer AS mst_buyer, CAST(coalesce(issue_ts, record_ts) AS DATE) AS report_date,
               hour(coalesce(issue_ts, record_ts)) AS hr, worth AS total_sales, CAST(0 AS DOUBLE) AS tax_amt, discount AS discount_amt,
               with_vat, without_vat, payment, transport, CAST(NULL AS DOUBLE) AS adjusted, status = '1' AS counts,
               CASE WHEN worth + discount <> 0 THEN CAST(0 AS DOUBLE) END AS pct
        FROM (SELECT i.*, CASE i.adjust_type WHEN '9' THEN coalesce(i.with_vat_foreign, 0) + coalesce(o.worth, 0)
                   WHEN '3' THEN coalesce(o.worth, 0) ELSE coalesce(i.with_vat_foreign, 0) END AS worth
              FROM oinv i LEFT JOIN (SELECT invoice_id, partition_month, max(with_vat_foreign) AS worth FROM oinv WHERE status = '1'
                                     GROUP BY ALL) o ON o.invoice_id = i.original_invoice AND o.partition_month = i.partition_month)"""


@query("seller_features_first", _with_rules(FIRST_TYPED, f"oinv AS ({q.CTE['oinv']})"))
def seller_features_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first generation: amounts of correcting invoices include their originals'."""
    return _wide(spark, sf_dir, [inputs.RUN_DATE], FIRST)


IN_REPORTED = ", ".join(f"DATE '{d}'" for d in REPORTED)


@query(
    "gap_carry_months",
    q.with_ctes(
        "raw_months",
        f"SELECT mst_seller, report_date, {typed_list(RAW_COLUMNS, RAW_COUNTS)} FROM raw_months WHERE report_date IN ({IN_REPORTED})",
    ),
)
def gap_carry_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps and previous months of three months, each from its own rows and a carry table."""
    days, partners, months = _written(spark, sf_dir)
    return uniform(_raw_months(spark, days, partners, months, REPORTED))


@query(
    "change_carry_months",
    q.with_ctes(
        "change_all",
        f"""SELECT mst_seller, report_date, CAST(monthly_total_sales_last_mth AS DOUBLE) AS monthly_total_sales_last_mth,
                   CAST(monthly_invoice_count_last_mth AS BIGINT) AS monthly_invoice_count_last_mth,
                   {snap_sql('sales_amt_perc_change', 4)} AS sales_amt_perc_change,
                   {snap_sql('invoice_cnt_perc_change_self', 4)} AS invoice_cnt_perc_change_self
            FROM change_all WHERE report_date IN ({IN_REPORTED})""",
    ),
)
def change_carry_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes against the previous present month, which the carry table remembers."""
    days, partners, months = _written(spark, sf_dir)
    out: DataFrame | None = None
    for start, before in _carries(days, partners, months, REPORTED).items():
        found = carry.monthly_change(_month(months, "report_date", start), before)
        out = found if out is None else out.unionByName(found)
    changes = ("monthly_total_sales_last_mth", "monthly_invoice_count_last_mth", "sales_amt_perc_change", "invoice_cnt_perc_change_self")
    return plain(out.select("mst_seller", "report_date", *changes), 4)


@query(
    "states_multi_period",
    q.with_ctes("recent", f"SELECT mst_seller, {_period_sql(PERIOD_FUNCTIONS, 'daily_total_sales', False)} FROM recent GROUP BY ALL"),
)
def states_multi_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve statistics in four windows, merged from month states."""
    measure = ["daily_total_sales"]
    daily = month_states.with_gap(inputs.daily(spark, sf_dir), ["mst_seller"], "report_date")
    states = materialize(month_states.month_states(daily, ["mst_seller"], "report_date", measure, runs=measure), "states")
    found = month_states.window_states(states, ["mst_seller"], [inputs.LAST_DAY])
    return plain(found.selectExpr("mst_seller", *month_states.unpack_states({measure[0]: PERIOD_FUNCTIONS})), 4)


@query(
    "states_exact_percentiles",
    f"WITH {BALANCES} SELECT cusid, {_period_sql(EXACT_FUNCTIONS, 'a_bal_catd', True)} FROM bal GROUP BY ALL",
)
def states_exact_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of balances from merged runs of values."""
    measure = ["a_bal_catd"]
    daily = balance_days(spark, sf_dir)
    states = materialize(month_states.month_states(daily, ["cusid"], "report_date", measure, runs=measure), "states")
    found = month_states.window_states(states, ["cusid"], [inputs.LAST_DAY])
    return plain(found.selectExpr("cusid", *month_states.unpack_states({measure[0]: EXACT_FUNCTIONS}, exact=True)), 4)


DISTINCT_BUYERS = ", ".join(
    f"count(DISTINCT CASE WHEN report_date >= DATE '{start}' THEN mst_buyer END) AS distinct_buyers_{name}" for name, start in q.PERIODS.items()
)


@query(
    "distinct_buyers_windows",
    q.with_ctes(
        "typed",
        f"""SELECT mst_seller, {DISTINCT_BUYERS} FROM typed WHERE counts AND mst_buyer IS NOT NULL
            AND report_date BETWEEN DATE '{q.PERIODS['l12m']}' AND DATE '{q.LAST_DAY}' GROUP BY ALL""",
    ),
)
def distinct_buyers_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True distinct buyers in four windows, from bitmaps of days merged to months."""
    rows = inputs.typed(spark, sf_dir).filter("counts")
    sets = buyer_sets.day_sets(rows, "mst_seller", "mst_buyer", "report_date")
    months = materialize(buyer_sets.month_sets(sets, "mst_seller", "report_date", laid_out=True), "buyer-sets")
    return buyer_sets.window_counts(months, "mst_seller", [inputs.LAST_DAY], "distinct_buyers").drop("as_of")
