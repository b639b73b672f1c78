"""Stand-alone sales questions.

Input has one row per invoice: ``seller``, ``day``, ``sales``, ``buyer``,
``discount``. Questions about extreme buyers are answered from per-buyer totals, so
invoices are aggregated once and never joined back to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.operators import windows
from ledgerlens.operators.joins import days_without


def _per_month(rows: DataFrame, *keys: str):
    calendar = dates.calendar_columns(F.col("day"))
    return rows.groupBy(*keys, calendar["year"].alias("year"), calendar["month_of_year"].alias("month"))


def _per_buyer(rows: DataFrame) -> DataFrame:
    return rows.groupBy("buyer").agg(
        F.count(F.lit(1)).alias("num_transactions"),
        F.sum("sales").alias("total_sales"),
        F.sum("discount").alias("total_discount"),
    )


def top5_days_total(rows: DataFrame) -> DataFrame:
    """Per seller: total of its five best days."""
    daily = rows.groupBy("seller", "day").agg(F.sum("sales").alias("day_sales"))
    best = windows.top_rows(daily, ["seller"], "day_sales", "day", 5)
    return best.groupBy("seller").agg(F.sum("day_sales").alias("total_sales_top5"))


def highest_invoice_per_month(rows: DataFrame) -> DataFrame:
    return _per_month(rows, "seller").agg(F.max("sales").alias("max_invoice_total_sales"))


def months_with_most_sales(rows: DataFrame) -> DataFrame:
    return windows.at_extreme(_per_month(rows).agg(F.sum("sales").alias("total_sales")), "total_sales")


def months_with_most_buyers(rows: DataFrame) -> DataFrame:
    return windows.at_extreme(_per_month(rows).agg(F.count_distinct("buyer").alias("num_buyers")), "num_buyers")


def most_frequent_buyers(rows: DataFrame) -> DataFrame:
    return windows.at_extreme(_per_buyer(rows), "num_transactions").select("buyer", "num_transactions")


def transactions_of_least_frequent_buyers(rows: DataFrame) -> DataFrame:
    """How many invoices go to the buyers with the fewest; a missing buyer never matches."""
    rare = windows.at_extreme(_per_buyer(rows), "num_transactions", largest=False)
    return rare.filter(F.col("buyer").isNotNull()).agg(
        F.coalesce(F.sum("num_transactions"), F.lit(0)).alias("num_transactions")
    )


def discount_of_most_frequent_buyers(rows: DataFrame) -> DataFrame:
    common = windows.at_extreme(_per_buyer(rows), "num_transactions")
    return common.filter(F.col("buyer").isNotNull()).select("buyer", "total_discount")


def top_buyers(rows: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` buyers with the most sales overall, by a distributed top-k."""
    return _per_buyer(rows).orderBy(F.desc("total_sales"), F.asc("buyer")).limit(k).select("buyer", "total_sales")


def sales_with_top_buyers(rows: DataFrame, k: int = 3) -> DataFrame:
    return (
        top_buyers(rows, k)
        .filter(F.col("buyer").isNotNull())
        .agg(F.sum("total_sales").alias("total_sales_with_top3_buyers"))
    )


def days_without_sales(rows: DataFrame) -> DataFrame:
    return days_without(rows.filter(F.col("day").isNotNull()), "day").agg(
        F.count(F.lit(1)).alias("num_days_without_sales")
    )


def longest_gap(rows: DataFrame) -> DataFrame:
    return windows.largest_gap(rows.filter(F.col("day").isNotNull()), "day")


def longest_gap_per_buyer(rows: DataFrame) -> DataFrame:
    return windows.largest_gap(rows, "day", ["buyer"])
