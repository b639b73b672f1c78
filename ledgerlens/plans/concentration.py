"""How few days make up most of a month's revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates, scalars
from ledgerlens.operators import windows
from ledgerlens.operators.joins import recent_months


def revenue_concentration(
    df: DataFrame,
    date_col: str = "invoice_date",
    amount_col: str = "amount",
    id_col: str = "ID_KH",
    last_n_months: int = 12,
    threshold: float = 0.8,
    drop_null_amounts: bool = True,
    positive_only: bool = False,
    by_customer: bool = True,
    amount: str = "double",
) -> DataFrame:
    """Per (customer and) month: the fewest best days whose share reaches ``threshold``.

    Months are the last ones present in the data. Days are aggregated first, so each
    window partition is one month of days. Total, cut-off, chosen days and day count
    all come from a single aggregate over the ranked days. Where the month's total is
    not positive no day count qualifies and those columns are null.
    """
    by_customer = by_customer and id_col in df.columns
    value = F.col(amount_col).try_cast(amount)
    calendar = dates.calendar_columns(scalars.to_timestamp(df, date_col))
    rows = df.select(
        *([F.col(id_col)] if by_customer else []),
        calendar["report_date"].alias("day"),
        calendar["month_start"].alias("month_start"),
        (value if drop_null_amounts else F.coalesce(value, F.lit(0).cast(amount))).alias("value"),
    ).filter(F.col("day").isNotNull() & F.col("value").isNotNull())

    month_keys = [*([id_col] if by_customer else []), "month_start"]
    daily = (
        recent_months(rows, "month_start", last_n_months)
        .groupBy(*month_keys, "day")
        .agg(F.sum("value").alias("daily_revenue"))
    )
    counted = F.col("daily_revenue") > 0 if positive_only else F.lit(True)
    ranked = windows.with_running_share(
        daily.withColumn("counted_revenue", F.when(counted, F.col("daily_revenue"))),
        month_keys,
        "counted_revenue",
        "day",
        "day_rank",
        "running",
        "share",
    )
    reached = F.col("counted_revenue").isNotNull() & (F.col("share") >= threshold)
    chosen = ranked.groupBy(*month_keys).agg(
        F.sum("daily_revenue").alias("net_month_total"),
        F.sum("counted_revenue").alias("month_total"),
        F.min(F.when(reached, F.col("day_rank"))).alias("days_needed_for_threshold"),
        F.array_sort(F.collect_list(F.struct("day_rank", "day", "share"))).alias("days"),
        F.count("day").alias("total_days_in_month_in_data"),
    )
    taken = F.filter("days", lambda d: d["day_rank"] <= F.col("days_needed_for_threshold"))
    found = F.col("days_needed_for_threshold").isNotNull()
    return (
        chosen.select(
            *([id_col] if by_customer else []),
            F.date_format("month_start", "yyyy-MM").alias("month"),
            "month_start",
            "net_month_total",
            "month_total",
            "days_needed_for_threshold",
            F.when(found, F.array_max(F.transform(taken, lambda d: d["share"]))).alias("covered_pct"),
            F.when(found, F.array_sort(F.transform(taken, lambda d: F.dayofmonth(d["day"])))).alias("selected_days"),
            "total_days_in_month_in_data",
            scalars.ratio(F.col("days_needed_for_threshold"), F.col("total_days_in_month_in_data")).alias(
                "share_of_days"
            ),
        )
    )
