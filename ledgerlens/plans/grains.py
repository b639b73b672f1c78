"""The three grains every seller feature is built from.

``day_grain`` and ``partner_month`` are the only two that read invoices; everything
later works on their output.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerlens.functions.aggregates import aggregate, count_if, distinct_counts, mean, sum_if
from ledgerlens.functions.scalars import OTHER_BAND, TAX_BANDS, ratio
from ledgerlens.operators import windows

SELLER_DAY = ("mst_seller", "report_date")
SELLER_MONTH = ("mst_seller", "report_date")

# Feature-name ending of each tax band.
BAND_SUFFIX = {band: "tax" + band.rstrip("%") for band in TAX_BANDS} | {OTHER_BAND: "taxOthers"}

# Columns of the day grain that look at every invoice, counted or not.
UNFILTERED = ("has_buyer", "max_positive_sale")

# Numerator and denominator of each daily ratio.
DAILY_RATIOS: dict[str, tuple[str, str]] = {
    "daily_night_ratio": ("daily_night_invoice_count", "daily_invoice_count"),
    "daily_core_ratio": ("daily_core_invoice_count", "daily_invoice_count"),
    "daily_discount_ratio": ("daily_total_discount", "daily_total_sales"),
    "daily_sales_per_buyer": ("daily_total_sales", "daily_buyer_count"),
    "daily_sales_per_invoice": ("daily_total_sales", "daily_invoice_count"),
}

# Monthly measures as (function, daily measure).
MONTHLY_MEASURES: dict[str, tuple[str, str]] = {
    "monthly_total_sales": ("sum", "daily_total_sales"),
    "monthly_invoice_count": ("sum", "daily_invoice_count"),
    "monthly_buyer_count": ("sum", "daily_buyer_count"),
    "monthly_avg_daily_sales": ("avg", "daily_total_sales"),
    "monthly_avg_daily_invoices": ("avg", "daily_invoice_count"),
    "monthly_avg_daily_buyers": ("avg", "daily_buyer_count"),
    "avg_invoices_per_day": ("avg", "daily_invoice_count"),
    "avg_night_ratio": ("avg", "daily_night_ratio"),
    "avg_core_ratio": ("avg", "daily_core_ratio"),
    "avg_night_invoice_count": ("avg", "daily_night_invoice_count"),
    "avg_core_invoice_count": ("avg", "daily_core_invoice_count"),
    "active_days": ("count", "report_date"),
    "monthly_total_night_invoices_count": ("sum", "daily_night_invoice_count"),
    "monthly_total_core_invoices_count": ("sum", "daily_core_invoice_count"),
    "monthly_total_invoice_adjusted_count": ("sum", "daily_invoice_adjusted_count"),
    "monthly_total_invoice_adjusted_amount": ("sum", "daily_invoice_adjusted_amount"),
    "monthly_total_tax": ("sum", "daily_total_tax"),
} | {
    f"monthly_{measure}_{ending}": ("sum", f"daily_{measure}_{ending}")
    for measure in ("invoice_count", "total_sales")
    for ending in BAND_SUFFIX.values()
}

# The monthly measures of the SQL reading, under its own names.
MONTHLY_MEASURES_SQL: dict[str, tuple[str, str]] = {
    "monthly_total_sales": ("sum", "daily_total_sales"),
    "monthly_invoice_count": ("sum", "daily_invoice_count"),
    "monthly_total_buyer_touches": ("sum", "daily_buyer_count"),
    "monthly_avg_daily_sales": ("avg", "daily_total_sales"),
    "monthly_avg_daily_invoices": ("avg", "daily_invoice_count"),
    "monthly_avg_daily_buyers": ("avg", "daily_buyer_count"),
    "monthly_avg_night_ratio": ("avg", "daily_night_ratio"),
    "monthly_avg_core_ratio": ("avg", "daily_core_ratio"),
    "monthly_night_invoices": ("sum", "daily_night_invoice_count"),
    "monthly_active_days": ("count", "report_date"),
    "monthly_total_discount": ("sum", "daily_total_discount"),
    "monthly_avg_discount_ratio": ("avg", "daily_discount_ratio"),
}


def tax_band_measures(band: Column, value: Column) -> dict[str, Column]:
    """Invoice count and sales per tax band: a pivot with fixed columns."""
    counts = {f"invoice_count_{s}": count_if(band == b) for b, s in BAND_SUFFIX.items()}
    sales = {f"total_sales_{s}": sum_if(band == b, value) for b, s in BAND_SUFFIX.items()}
    return counts | sales


def day_grain(rows: DataFrame) -> DataFrame:
    """Seller-day measures.

    A measure starting with ``daily_`` covers the invoices that count; the others
    cover all. A day without counted invoices has ``daily_invoice_count`` zero.
    """
    counted = F.col("counts")

    def only(name: str) -> Column:
        return F.when(counted, F.col(name))

    sales = only("total_sales")
    zero = F.when(counted, F.coalesce(F.col("adjusted_amount"), F.lit(0)))
    measures = {
        "total_sales": F.sum(sales),
        "invoice_count": count_if(counted),
        "total_tax": F.sum(only("tax_amt")),
        "total_discount": F.sum(only("discount_amt")),
        "total_without_vat": F.sum(only("total_without_vat")),
        "total_with_vat": F.sum(only("total_with_vat")),
        "night_invoice_count": count_if(counted & F.col("is_night")),
        "core_invoice_count": count_if(counted & F.col("is_core")),
        "max_invoice_value": F.max(sales),
        "min_invoice_value": F.min(sales),
        "avg_invoice_value": mean(sales),
        "std_invoice_value": F.stddev_samp(sales),
        "invoice_adjusted_count": count_if(counted & F.col("adjusted_amount").isNotNull()),
        "invoice_adjusted_amount": F.sum(zero),
    } | tax_band_measures(only("tax_band"), F.col("total_sales"))
    grain = rows.groupBy(*SELLER_DAY).agg(
        *[e.alias(f"daily_{name}") for name, e in measures.items()],
        F.max(F.col("mst_buyer").isNotNull()).alias("has_buyer"),
        F.max(F.when(F.col("total_sales") > 0, F.col("total_sales"))).alias("max_positive_sale"),
    )
    distinct = distinct_counts(
        rows.filter(counted),
        SELLER_DAY,
        {
            "daily_buyer_count": F.col("mst_buyer"),
            "daily_distinct_payment_methods": F.col("payment_method"),
            "daily_distinct_transport": F.col("transport"),
        },
    )
    grain = grain.join(distinct, list(SELLER_DAY), "left").na.fill(0, subset=distinct.columns[2:])
    return grain.withColumns(
        {
            name: ratio(F.coalesce(F.col(top), F.lit(0)), F.col(bottom))
            for name, (top, bottom) in DAILY_RATIOS.items()
        }
    )


def daily_sellers(grain: DataFrame) -> DataFrame:
    """The filtered daily table: days with at least one counted invoice."""
    return grain.filter(F.col("daily_invoice_count") > 0).drop(*UNFILTERED)


def partner_month(rows: DataFrame, filter_pairs: bool = False) -> DataFrame:
    """Seller-buyer-month totals, with the positive-sale parts the ranking needs."""
    rows = rows.filter("counts") if filter_pairs else rows
    positive = F.col("total_sales") > 0
    return (
        rows.filter(F.col("mst_buyer").isNotNull())
        .groupBy("mst_seller", "mst_buyer", F.trunc("report_date", "month").alias("month_start"))
        .agg(
            F.sum("total_sales").alias("buyer_monthly_sales"),
            F.count(F.lit(1)).alias("buyer_monthly_invoice_count"),
            F.sum("discount_amt").alias("buyer_monthly_discount"),
            count_if(positive).alias("inv_cnt"),
            F.sum(F.when(positive, F.col("total_sales"))).alias("sales_amt"),
            F.sum(F.when(positive, F.col("discount_amt"))).alias("disc_amt"),
        )
    )


def buyer_months(partners: DataFrame) -> DataFrame:
    """The published columns of the seller-buyer-month table."""
    return partners.select(
        "mst_seller", "mst_buyer", "month_start", "buyer_monthly_sales", "buyer_monthly_invoice_count"
    )


def month_grain(
    daily: DataFrame,
    measures: Mapping[str, tuple[str, str]] = MONTHLY_MEASURES,
    top_days: Sequence[int] = (5, 10),
) -> DataFrame:
    """Seller-month measures keyed by month end, with the share of the best days.

    Day ranks are computed beside the aggregate input, so top-day totals are plain
    conditional sums of the same ``groupBy``. ``active_days`` counts rows: the daily
    table has one per date.
    """
    month = daily.withColumn("month_end", F.last_day("report_date"))
    keys = ["mst_seller", "month_end"]
    if top_days:
        month = windows.ranked(month, keys, "daily_total_sales", "report_date", "month_rank")
    wanted = [aggregate(F.col(column), function).alias(name) for name, (function, column) in measures.items()]
    tops = [
        windows.sum_of_top("month_rank", k, "daily_total_sales").alias(f"top{k}_days_by_month_sales")
        for k in top_days
    ]
    grain = month.groupBy(*keys).agg(*wanted, *tops).withColumnRenamed("month_end", "report_date")
    return grain.withColumns(
        {
            f"top{k}_days_by_month_concentration": ratio(
                F.col(f"top{k}_days_by_month_sales"), F.col("monthly_total_sales")
            )
            for k in top_days
        }
    )


def with_monthly_change(months: DataFrame, keys: Sequence[str] = ("mst_seller",)) -> DataFrame:
    """Percent change of sales and invoice count against the previous present month."""
    months = windows.with_previous_change(
        months, keys, "report_date", "monthly_total_sales", "monthly_total_sales_last_mth", "sales_amt_perc_change"
    )
    return windows.with_previous_change(
        months,
        keys,
        "report_date",
        "monthly_invoice_count",
        "monthly_invoice_count_last_mth",
        "invoice_cnt_perc_change_self",
    )


TOP_BUYERS = 3


def partner_extremes(partners: DataFrame) -> DataFrame:
    """Per seller-month: buyer totals, most and least frequent buyer, top buyers.

    The most and the least frequent trading buyer are one row each: the least of structs, which
    combine before the shuffle like the totals beside them. The largest buyers are a ranking whose
    filter on a row number is one that Spark applies before the shuffle as well, so at most three
    rows of a seller-month leave a task. Ties go to the smaller buyer id.
    """
    months = partners.withColumn("report_date", F.last_day("month_start"))

    def total_type(column: str) -> DataType:
        return months.agg(F.sum(column)).schema[0].dataType

    def first(by: Column) -> Column:
        values = [F.col(c).cast(total_type(c)).alias(c) for c in ("inv_cnt", "sales_amt", "disc_amt")]
        return F.min(F.when(F.col("inv_cnt") > 0, F.struct(by.alias("by"), F.col("mst_buyer"), *values)))

    totals = months.groupBy(*SELLER_MONTH).agg(
        F.sum("buyer_monthly_discount").alias("monthly_total_discount_buyer_taxcode"),
        F.count(F.lit(1)).alias("monthly_distinct_buyer_count"),
        F.sum("buyer_monthly_sales").alias("monthly_total_sales_buyer_taxcode"),
        F.sum("sales_amt").alias("monthly_sales_amt"),
        first(-F.col("inv_cnt")).alias("most"),
        first(F.col("inv_cnt")).alias("least"),
    )
    entered = months.filter(F.col("inv_cnt") > 0).select(
        *SELLER_MONTH, "mst_buyer", "sales_amt", (-F.col("sales_amt").cast("double")).alias("by")
    )
    largest = windows.top_rows(entered, SELLER_MONTH, "by", "mst_buyer", TOP_BUYERS, largest=False)
    tops = {f"sales_amt_top{k}_big_buyer_taxcode": windows.sum_of_top("rank", k, "sales_amt") for k in range(1, TOP_BUYERS + 1)}
    best = largest.groupBy(*SELLER_MONTH).agg(*[e.alias(name) for name, e in tops.items()])

    def per_trade(who: str) -> Column:
        return F.col(f"{who}.sales_amt").cast("double") / F.col(f"{who}.inv_cnt")

    return totals.join(best, list(SELLER_MONTH), "left").select(
        *SELLER_MONTH,
        "monthly_total_discount_buyer_taxcode",
        "monthly_distinct_buyer_count",
        "monthly_total_sales_buyer_taxcode",
        F.col("most.inv_cnt").alias("inv_cnt_freq_buyer_taxcode"),
        F.col("most.sales_amt").alias("sales_amt_most_freq_buyer_taxcode"),
        per_trade("most").alias("sales_amt_most_freq_buyer_taxcode_per_trans"),
        F.col("most.disc_amt").alias("disc_amt_most_freq_buyer_taxcode"),
        F.col("least.inv_cnt").alias("inv_cnt_least_freq_buyer_taxcode"),
        F.col("least.sales_amt").alias("sales_amt_least_freq_buyer_taxcode"),
        per_trade("least").alias("sales_amt_least_freq_buyer_taxcode_per_trans"),
        "monthly_sales_amt",
        *[f"sales_amt_top{k}_big_buyer_taxcode" for k in range(1, TOP_BUYERS + 1)],
        ratio(F.col("sales_amt_top3_big_buyer_taxcode"), F.col("monthly_sales_amt"), None).alias(
            "sales_amt_top3_big_buyer_taxcode_vs_sales_amt"
        ),
    )


def silent_days(grain: DataFrame) -> DataFrame:
    """Per seller-month: summed day gaps (all invoices; invoices with a buyer) and the
    highest single invoice.

    A gap belongs to the month of its later date and may reach into earlier months.
    Both gap series come from one window pass over the seller's days.
    """
    order = Window.partitionBy("mst_seller").orderBy("report_date")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    named = F.when(F.col("has_buyer"), F.col("report_date"))
    day = F.col("report_date")
    return (
        grain.select(*SELLER_DAY, *UNFILTERED)
        .withColumns(
            {
                "gap": F.datediff(day, F.lag("report_date").over(order)),
                "named_gap": F.datediff(named, F.last(named, ignorenulls=True).over(earlier)),
            }
        )
        .groupBy("mst_seller", F.last_day("report_date").alias("report_date"))
        .agg(
            F.max("max_positive_sale").alias("monthly_sales_amt_highest_inv"),
            F.sum("gap").alias("day_cnt_no_sales"),
            F.sum("named_gap").alias("day_cnt_no_sales_per_cus_taxcode"),
        )
    )


def with_previous_month(months: DataFrame) -> DataFrame:
    """The seller's previous present month and how many months ago it was."""
    order = Window.partitionBy("mst_seller").orderBy("report_date")
    return months.withColumn("prev_report_date", F.lag("report_date").over(order)).withColumn(
        "mth_cnt_no_rev", F.months_between("report_date", "prev_report_date")
    )


def raw_monthly(grain: DataFrame, partners: DataFrame, only: Sequence[dt.date] | None = None) -> DataFrame:
    """Seller-month features that look at every invoice, for months with a known buyer.

    Both inputs hold the full history, so gaps and previous months are not cut off.
    With ``only`` (month ends) just those months are computed: the buyer rankings then
    read the partner rows of these months alone, and the history is touched only for
    which days and months a seller was active in.
    """
    gaps = silent_days(grain)
    if only is None:
        base = with_previous_month(partner_extremes(partners))
    else:
        wanted = F.col("report_date").isin(list(only))
        active = partners.select("mst_seller", F.last_day("month_start").alias("report_date")).distinct()
        starts = [day.replace(day=1) for day in only]
        base = partner_extremes(partners.filter(F.col("month_start").isin(starts)))
        base = base.join(with_previous_month(active).filter(wanted), list(SELLER_MONTH))
        gaps = gaps.filter(wanted)
    return with_gaps(base, gaps)


def with_gaps(base: DataFrame, gaps: DataFrame) -> DataFrame:
    """Buyer-side and gap features of the same months in the published order."""
    per_buyer = ratio(F.col("monthly_total_sales_buyer_taxcode"), F.col("monthly_distinct_buyer_count"), None)
    previous = ["prev_report_date", "mth_cnt_no_rev"]
    return base.join(gaps, list(SELLER_MONTH), "left").select(
        *SELLER_MONTH,
        *[c for c in base.columns if c not in (*SELLER_MONTH, *previous)],
        *[c for c in gaps.columns if c not in SELLER_MONTH],
        per_buyer.alias("Sales_amt_per_buyer_taxcode"),
        *previous,
    )
