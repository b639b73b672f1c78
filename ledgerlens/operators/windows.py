"""Ordered operators.

Windows run over grains whose partitions the calendar bounds (days of a seller,
days of a month), and none lacks a partition key but over dates. Rankings over partners, whose number has no bound, always keep
``row_number() <= k`` as a filter, which Spark also applies before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import ratio
from ledgerlens.sources.store import materialize


def ranked(df: DataFrame, keys: Sequence[str], metric: str, tie: str, name: str, largest: bool = True) -> DataFrame:
    """Add the rank by falling (or rising) ``metric``; ``tie`` makes it deterministic."""
    order = Window.partitionBy(*keys).orderBy(F.desc(metric) if largest else F.asc(metric), F.asc(tie))
    return df.withColumn(name, F.row_number().over(order))


def top_rows(
    df: DataFrame, keys: Sequence[str], metric: str, tie: str, k: int, rank: str = "rank", largest: bool = True
) -> DataFrame:
    """The ``k`` rows of each group with the largest (or smallest) metric."""
    return ranked(df, keys, metric, tie, rank, largest).filter(F.col(rank) <= k)


def sum_of_top(rank: str, k: int, value: str) -> Column:
    """Aggregate: total of the first ``k`` ranks."""
    return F.sum(F.when(F.col(rank) <= k, F.col(value)))


def with_day_gap(df: DataFrame, keys: Sequence[str], date_col: str, name: str = "days_gap") -> DataFrame:
    """Days since the group's previous date."""
    order = Window.partitionBy(*keys).orderBy(date_col)
    return df.withColumn(name, F.datediff(F.col(date_col), F.lag(date_col).over(order)))


def with_month_gap(df: DataFrame, keys: Sequence[str], month_col: str, name: str = "months_gap") -> DataFrame:
    """Months since the group's previous month (both month ends, so a whole number)."""
    order = Window.partitionBy(*keys).orderBy(month_col)
    return df.withColumn(name, F.months_between(F.col(month_col), F.lag(month_col).over(order)))


def with_previous_change(
    df: DataFrame, keys: Sequence[str], order_col: str, metric: str, previous: str, change: str
) -> DataFrame:
    """Previous present value and percent change; null unless the previous is positive."""
    order = Window.partitionBy(*keys).orderBy(order_col)
    before = F.col(previous)
    percent = ratio((F.col(metric) - before).cast("double") * 100, before, None)
    return df.withColumn(previous, F.lag(metric).over(order)).withColumn(change, percent)


def with_running_share(
    df: DataFrame, keys: Sequence[str], metric: str, tie: str, rank: str, running: str, share: str
) -> DataFrame:
    """Rank by falling metric, running total and its share of the group total.

    A group whose total is not positive has share zero throughout.
    """
    group = Window.partitionBy(*keys)
    order = group.orderBy(F.desc(metric), F.asc(tie))
    rows = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(metric).over(group)
    return df.withColumns({rank: F.row_number().over(order), running: F.sum(metric).over(rows)}).withColumn(
        share, ratio(F.col(running), total)
    )


def largest_gap(df: DataFrame, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Largest number of days between consecutive distinct dates, per group or overall.

    Distinct dates come first: what is left per group is bounded by the calendar.
    """
    days = df.select(*keys, date_col).distinct()
    gaps = with_day_gap(days, keys, date_col)
    return gaps.groupBy(*keys).agg(F.max("days_gap").alias("max_days_gap"))


def at_extreme(df: DataFrame, metric: str, largest: bool = True) -> DataFrame:
    """Rows whose metric equals the overall maximum (or minimum); ties are kept.

    The metric is written once. Its extreme is one row, which is broadcast, so tied rows stay
    in the tasks they are in, however many they are. Null metrics take no part.
    """
    rows = materialize(df, "extremes")
    edge = rows.agg((F.max(metric) if largest else F.min(metric)).alias("_edge")).filter("_edge IS NOT NULL")
    return rows.join(F.broadcast(edge), F.col(metric) == F.col("_edge")).drop("_edge")  # one row
