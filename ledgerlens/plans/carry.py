"""What a month has to know of all months before it: one row per seller.

Gaps reach over month edges and a change looks at the previous present month. The carry
table holds each seller's last active day, last day with a known buyer, last month with a
known buyer, and last counted month with its totals. A month's features need the month's own
rows and the carry in front of it; the carry behind it needs the same two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import ratio
from ledgerlens.plans import grains

SELLER = "mst_seller"
CARRY = ("last_day", "last_named_day", "last_partner_month", "last_month")


def activity(days: DataFrame, partners: DataFrame, months: DataFrame) -> DataFrame:
    """The carry behind the given rows of the day, partner and month grain alone."""
    of_days = days.groupBy(SELLER).agg(
        F.max("report_date").alias("last_day"), F.max(F.when(F.col("has_buyer"), F.col("report_date"))).alias("last_named_day")
    )
    of_partners = partners.groupBy(SELLER).agg(F.max(F.last_day("month_start")).alias("last_partner_month"))
    of_months = months.groupBy(SELLER).agg(
        F.max(
            F.struct(
                F.col("report_date"),
                F.col("monthly_total_sales").cast("double").alias("sales"),
                F.col("monthly_invoice_count").cast("long").alias("invoices"),
            )
        ).alias("last_month")
    )
    return of_days.unionByName(of_partners, allowMissingColumns=True).unionByName(of_months, allowMissingColumns=True)


def advance(carry: DataFrame | None, days: DataFrame, partners: DataFrame, months: DataFrame) -> DataFrame:
    """The carry behind these rows, which come after those of ``carry``. The older rows
    and the new ones meet in one aggregate; there is no join."""
    found = activity(days, partners, months)
    if carry is not None:
        found = carry.select(SELLER, *CARRY).unionByName(found)
    return found.groupBy(SELLER).agg(*[F.max(c).alias(c) for c in CARRY])


def silent_days(days: DataFrame, carry: DataFrame) -> DataFrame:
    """As :func:`grains.silent_days`, for the days of one month and the carry before it."""
    order = Window.partitionBy(SELLER).orderBy("report_date")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    day = F.col("report_date")
    named = F.when(F.col("has_buyer"), day)
    known = days.select(*grains.SELLER_DAY, *grains.UNFILTERED).join(carry.select(SELLER, "last_day", "last_named_day"), SELLER, "left")
    return (
        known.withColumns(
            {
                "gap": F.datediff(day, F.coalesce(F.lag("report_date").over(order), "last_day")),
                "named_gap": F.datediff(named, F.coalesce(F.last(named, ignorenulls=True).over(earlier), F.col("last_named_day"))),
            }
        )
        .groupBy(SELLER, F.last_day("report_date").alias("report_date"))
        .agg(
            F.max("max_positive_sale").alias("monthly_sales_amt_highest_inv"),
            F.sum("gap").alias("day_cnt_no_sales"),
            F.sum("named_gap").alias("day_cnt_no_sales_per_cus_taxcode"),
        )
    )


def raw_month(days: DataFrame, partners: DataFrame, carry: DataFrame) -> DataFrame:
    """As :func:`grains.raw_monthly`, for the rows of one month and the carry before it."""
    before = carry.select(SELLER, F.col("last_partner_month").alias("prev_report_date"))
    base = grains.partner_extremes(partners).join(before, SELLER, "left")
    base = base.withColumn("mth_cnt_no_rev", F.months_between("report_date", "prev_report_date"))
    return grains.with_gaps(base, silent_days(days, carry))


def _change(now: Column, before: Column) -> Column:
    return ratio((now - before).cast("double") * 100, before, None)


def monthly_change(months: DataFrame, carry: DataFrame) -> DataFrame:
    """As :func:`grains.with_monthly_change`, for the rows of one month and the carry before it."""
    last = carry.select(
        SELLER,
        F.col("last_month.sales").alias("monthly_total_sales_last_mth"),
        F.col("last_month.invoices").alias("monthly_invoice_count_last_mth"),
    )
    sales, invoices = (F.col(c) for c in ("monthly_total_sales", "monthly_invoice_count"))
    return months.join(last, SELLER, "left").withColumns(
        {
            "sales_amt_perc_change": _change(sales, F.col("monthly_total_sales_last_mth")),
            "invoice_cnt_perc_change_self": _change(invoices, F.col("monthly_invoice_count_last_mth")),
        }
    )
