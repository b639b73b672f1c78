"""Mapped inputs and grains the queries start from."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.functions.contacts import contact_values
from ledgerlens.plans import grains
from ledgerlens.sources import star_tables
from ledgerlens.sources.invoices import analysis_rows

RUN_DATE = dt.date(1998, 1, 1)
LAST_DAY = dates.last_closed_day(RUN_DATE)
FIRST_DAY = dates.month_start(LAST_DAY, 11)


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis_rows(star_tables.invoices(spark, sf_dir))


def day_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grains.day_grain(typed(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grains.daily_sellers(day_grain(spark, sf_dir))


def recent_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir).filter(dates.within("report_date", FIRST_DAY, LAST_DAY))


def recent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing frame of the daily table for the run date."""
    return dates.trailing_frame(daily(spark, sf_dir).repartition("mst_seller"), "report_date", [LAST_DAY])


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grains.partner_month(typed(spark, sf_dir))


def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input of the stand-alone sales questions."""
    return typed(spark, sf_dir).select(
        F.col("mst_seller").alias("seller"),
        F.col("report_date").alias("day"),
        F.col("total_sales").alias("sales"),
        F.col("mst_buyer").alias("buyer"),
        F.col("discount_amt").alias("discount"),
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contact_values(
        star_tables.contact_cards(spark, sf_dir), "entity", ("phone_1", "phone_2"), ("email_1",), ("rep_id",)
    )
