"""The library's expressions for users who write SQL, as temporary functions of a session.

Spark expands their bodies into the plan of the query that calls them, so they optimise like
the expressions themselves. The scalar functions and the calendar function stand alone;
:func:`register_sales` adds table functions over a given set of invoices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.functions import scalars
from ledgerlens.functions.aggregates import PERCENTILES
from ledgerlens.functions.dates import TRAILING_MONTHS
from ledgerlens.plans import grains

ROWS_VIEW = "ledger_rows"


def _in_hours(start: int, end: int) -> str:
    joined = "AND" if start <= end else "OR"
    return f"hour >= {start} {joined} hour < {end}"


def _band() -> str:
    cases = " ".join(f"WHEN percent = {rate}D THEN '{label}'" for label, rate in scalars.TAX_BANDS.items())
    return f"CASE {cases} ELSE '{scalars.OTHER_BAND}' END"


def _ratio(top: str, bottom: str, instead: str) -> str:
    return f"CASE WHEN {bottom} > 0 THEN {top} / {bottom} ELSE {instead} END"


# Texts rather than calls where one function needs another: Spark does not expand calls
# within a table function that another table function calls.
_CLOSED_DAY = "date_sub(trunc(run_date, 'month'), 1)"

# Name and parameters, result, body.
SCALARS = [
    ("ledger_is_night(hour INT)", "BOOLEAN", _in_hours(*scalars.NIGHT_HOURS)),
    ("ledger_is_core(hour INT)", "BOOLEAN", _in_hours(*scalars.CORE_HOURS)),
    ("ledger_key(id STRING)", "STRING", "trim(id)"),
    ("ledger_ratio(top DOUBLE, bottom DOUBLE, instead DOUBLE DEFAULT 0D)", "DOUBLE", _ratio("top", "bottom", "instead")),
    ("ledger_tax_percent(tax DOUBLE, sales DOUBLE, discount DOUBLE)", "DOUBLE", "round(try_divide(tax, sales + discount + tax) * 100, 2)"),
    ("ledger_tax_band(percent DOUBLE)", "STRING", _band()),
    ("ledger_months_back(day DATE, last_day DATE)", "INT", "12 * (year(last_day) - year(day)) + month(last_day) - month(day)"),
    ("ledger_closed_day(run_date DATE)", "DATE", _CLOSED_DAY),
]

_LIST = ", ".join(
    f"named_struct('window_name', '{name}', 'first_day', add_months(trunc(run_date, 'month'), {-n}), 'last_day', {_CLOSED_DAY})"
    for name, n in TRAILING_MONTHS.items()
)
_WINDOW = "window_name STRING, first_day DATE, last_day DATE"
SCALARS.append(("ledger_window_list(run_date DATE)", f"ARRAY<STRUCT<{_WINDOW}>>", f"array({_LIST})"))
WINDOWS_FUNCTION = ("ledger_windows(run_date DATE)", _WINDOW, "SELECT inline(listed) FROM (SELECT ledger_window_list(run_date) AS listed)")


def _create(spark: SparkSession, head: str, result: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {result} RETURN {body}")


def register(spark: SparkSession) -> None:
    """Adds the scalar functions and ``ledger_windows`` to the session."""
    for head, result, body in SCALARS:
        _create(spark, head, result, body)
    head, columns, body = WINDOWS_FUNCTION
    _create(spark, head, f"TABLE ({columns})", body)


_DAILY = (
    "mst_seller STRING, report_date DATE, daily_total_sales DOUBLE, daily_invoice_count BIGINT, daily_buyer_count BIGINT, "
    "daily_total_tax DOUBLE, daily_total_discount DOUBLE, daily_night_invoice_count BIGINT, daily_core_invoice_count BIGINT, "
    "daily_night_ratio DOUBLE, daily_core_ratio DOUBLE, daily_discount_ratio DOUBLE, daily_sales_per_buyer DOUBLE, daily_sales_per_invoice DOUBLE"
)


def _ratios() -> str:
    """The daily ratios by their common definition."""
    return ", ".join(_ratio(f"coalesce(CAST({top} AS DOUBLE), 0D)", f"CAST({bottom} AS DOUBLE)", "0D") for top, bottom in grains.DAILY_RATIOS.values())


# The pair counts come from rows made distinct first, as in the DataFrame form.
_DAILY_ROWS = f"""
    SELECT mst_seller, report_date, daily_total_sales, daily_invoice_count, daily_buyer_count, daily_total_tax, daily_total_discount,
           daily_night_invoice_count, daily_core_invoice_count, {_ratios()}
    FROM (SELECT mst_seller, report_date, sum(total_sales) AS daily_total_sales, count(*) AS daily_invoice_count,
                 count(DISTINCT mst_buyer) AS daily_buyer_count, sum(tax_amt) AS daily_total_tax, sum(discount_amt) AS daily_total_discount,
                 count_if({_in_hours(*scalars.NIGHT_HOURS)}) AS daily_night_invoice_count, count_if({_in_hours(*scalars.CORE_HOURS)}) AS daily_core_invoice_count
          FROM {ROWS_VIEW} WHERE counts AND report_date BETWEEN {{first}} AND {{last}} GROUP BY mst_seller, report_date)"""
_DAILY_BODY = _DAILY_ROWS.format(first="first_date", last="last_date")

_PERIOD_FUNCTIONS = {"sum": "sum({0})", "avg": "avg({0})", "min": "min({0})", "max": "max({0})", "std": "stddev_samp({0})"} | {
    name: f"percentile({{0}}, {rank}D)" for name, rank in PERCENTILES.items() if name in ("pct25", "med", "pct75")
}
_PERIOD = "mst_seller STRING, window_name STRING, days BIGINT, buyer_counts BIGINT, " + ", ".join(f"sales_{f} DOUBLE" for f in _PERIOD_FUNCTIONS)
# A day is repeated for each window it is in, so no join is needed. The daily rows are given
# in full: a call with arguments that depend on this function's own would become a join.
_PERIOD_BODY = f"""
    SELECT mst_seller, w.window_name, count(*), count(DISTINCT daily_buyer_count),
           {', '.join(f.format('daily_total_sales') for f in _PERIOD_FUNCTIONS.values())}
    FROM (SELECT mst_seller, daily_buyer_count, daily_total_sales, explode(filter(listed, x -> x.first_day <= report_date)) AS w
          FROM (SELECT *, array({_LIST}) AS listed
                FROM ({_DAILY_ROWS.format(first="add_months(trunc(run_date, 'month'), -12)", last=_CLOSED_DAY)})))
    GROUP BY mst_seller, w.window_name"""


def register_sales(spark: SparkSession, rows: DataFrame) -> None:
    """Adds table functions over typed invoice rows (:func:`invoices.analysis_rows`):
    ``ledger_daily(first_date, last_date)``, the seller-day table, and
    ``ledger_period(run_date)``, statistics of daily sales in the trailing windows. ``rows``
    becomes the temporary view ``ledger_rows``."""
    register(spark)
    rows.createOrReplaceTempView(ROWS_VIEW)
    _create(spark, "ledger_daily(first_date DATE, last_date DATE)", f"TABLE ({_DAILY})", _DAILY_BODY)
    _create(spark, "ledger_period(run_date DATE)", f"TABLE ({_PERIOD})", _PERIOD_BODY)
