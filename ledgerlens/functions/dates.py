"""Calendar arithmetic: run dates on the driver, calendar columns on Spark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The trailing windows, in calendar months including the last one.
TRAILING_MONTHS: dict[str, int] = {"l1m": 1, "l3m": 3, "l6m": 6, "l12m": 12}

EPOCH_DAY = dt.date(2020, 1, 1)  # fixed value: day 0 of the regression axis


def month_start(day: dt.date, months_back: int = 0) -> dt.date:
    """First day of the month ``months_back`` months before ``day``'s month."""
    index = day.year * 12 + day.month - 1 - months_back
    return dt.date(index // 12, index % 12 + 1, 1)


def last_closed_day(run_date: dt.date) -> dt.date:
    """Last day of the month before ``run_date``: what a run on that date reports on."""
    return month_start(run_date) - dt.timedelta(days=1)


def closed_month_key(run_date: dt.date) -> str:
    """``YYYYMM`` of the month a run reports on."""
    return last_closed_day(run_date).strftime("%Y%m")


def month_anchor_weeks(day: dt.date, weeks: int) -> dt.date:
    """First day of ``day``'s month moved back by whole weeks (not a trailing week)."""
    return month_start(day) - dt.timedelta(weeks=weeks)


def trailing_starts(last_day: dt.date, months: Mapping[str, int] = TRAILING_MONTHS) -> dict[str, dt.date]:
    """Start date per trailing window ending on ``last_day``."""
    return {name: month_start(last_day, n - 1) for name, n in months.items()}


def month_index(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Every calendar column the reports use, derived from one timestamp."""
    day = F.to_date(ts)
    return {
        "report_date": day,
        "hour": F.hour(ts),
        "month_start": F.trunc(day, "month"),
        "month_end": F.last_day(day),
        "month": F.date_format(day, "yyyy-MM"),
        "year": F.year(day),
        "month_of_year": F.month(day),
        "day_of_month": F.dayofmonth(day),
    }


def within(column: str, first: dt.date, last: dt.date) -> Column:
    """Closed date range with literal bounds, so it prunes partitions and row groups."""
    return F.col(column).between(F.lit(first), F.lit(last))


def trailing_frame(
    df: DataFrame, date_col: str, last_days: Iterable[dt.date], months: int = 12
) -> DataFrame:
    """Attach each row to every report date whose trailing window contains it.

    Adds ``as_of`` (the report date) and ``months_back`` (0 for the month of
    ``as_of``). Windows are whole calendar months, so membership is plain month
    arithmetic; several report dates are served in one pass without a join.
    """
    ends = sorted(set(last_days))
    bounded = df.filter(within(date_col, month_start(ends[0], months - 1), ends[-1]))
    day = F.col(date_col)

    def back(as_of: Column) -> Column:
        return month_index(as_of) - month_index(day)

    if len(ends) == 1:
        as_of = F.lit(ends[0])
    else:
        candidates = F.array(*[F.lit(end) for end in ends])
        as_of = F.explode(
            F.filter(candidates, lambda end: (day <= end) & (back(end) < months))
        )
    return bounded.select("*", as_of.alias("as_of")).withColumn("months_back", back(F.col("as_of")))


def since_conditions(date_col: str, starts: Mapping[str, dt.date]) -> list[tuple[Column, str]]:
    """(condition, suffix) per window given explicit start dates."""
    return [(F.col(date_col) >= F.lit(start), f"_{name}") for name, start in starts.items()]
