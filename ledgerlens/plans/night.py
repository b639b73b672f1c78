"""Sellers that issue most of their invoices at night."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates, scalars
from ledgerlens.functions.aggregates import count_if, mean


# The wording of the verdict's note.
NOTE_VOLUME = "tháng đạt: TB>="
NOTE_RATIO = "HĐ/ngày & TB>="
NOTE_END = "% HĐ ban đêm"


@dataclass(frozen=True)
class NightRule:
    """Fixed values of the rule; every one can be changed per call."""

    night: tuple[int, int] = scalars.NIGHT_HOURS
    core: tuple[int, int] = scalars.CORE_HOURS
    min_invoices_per_day: float = 100.0
    min_night_ratio: float = 0.30
    min_months: int = 2


def night_sales(
    invoices: DataFrame,
    ts_col: str = "record_ts",
    seller_col: str = "seller",
    months: int = 12,
    now: str | None = None,
    calendar_days: bool = False,
    rule: NightRule = NightRule(),
) -> tuple[DataFrame, DataFrame]:
    """Verdict per issuer and the monthly figures behind it.

    A month qualifies on its invoices per day and its mean daily night ratio. The
    per-day divisor is active days, or all days of the month with ``calendar_days``.
    Empty input gives empty frames with the same columns.
    """
    moment = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    calendar = dates.calendar_columns(F.col("ts"))
    rows = (
        invoices.select(
            scalars.to_timestamp(invoices, ts_col).alias("ts"),
            scalars.clean_key(F.col(seller_col)).alias("issuer"),
        )
        .filter(F.col("issuer").isNotNull() & (F.col("ts") >= F.add_months(moment, -months)))
        .select("issuer", calendar["report_date"].alias("day"), calendar["hour"].alias("hour"))
    )
    total = F.col("invoices").cast("double")
    daily = (
        rows.groupBy("issuer", "day")
        .agg(
            F.count(F.lit(1)).alias("invoices"),
            count_if(scalars.in_hours(F.col("hour"), *rule.night)).alias("night_invoices"),
            count_if(scalars.in_hours(F.col("hour"), *rule.core)).alias("core_invoices"),
        )
        .withColumns({"night_ratio": F.col("night_invoices") / total, "core_ratio": F.col("core_invoices") / total})
    )
    days = F.dayofmonth(F.last_day("month_start")) if calendar_days else F.col("active_days")
    monthly = (
        daily.groupBy("issuer", F.trunc("day", "month").alias("month_start"))
        .agg(
            mean(F.col("night_ratio")).alias("avg_night_ratio_month"),
            mean(F.col("core_ratio")).alias("avg_core_ratio_month"),
            F.count("day").alias("active_days"),
            F.sum("invoices").alias("total_invoices_month"),
            F.sum("night_invoices").alias("total_night_invoices_month"),
        )
        .withColumn("month", F.date_format("month_start", "yyyy-MM"))
        .withColumn("avg_invoices_per_day_month", F.col("total_invoices_month").cast("double") / days)
        .withColumns(
            {
                "meets_volume": scalars.at_least(F.col("avg_invoices_per_day_month"), rule.min_invoices_per_day),
                "meets_night_ratio": scalars.at_least(F.col("avg_night_ratio_month"), rule.min_night_ratio),
            }
        )
        .withColumn("qualified_month", F.col("meets_volume") & F.col("meets_night_ratio"))
    )
    verdict = (
        monthly.groupBy("issuer")
        .agg(
            count_if(F.col("qualified_month")).cast("int").alias("qualified_months_count_12m"),
            F.array_sort(F.collect_set(F.when(F.col("qualified_month"), F.col("month")))).alias("qualified_months"),
        )
        .withColumn("is_flagged", F.col("qualified_months_count_12m") >= rule.min_months)
        .withColumn(
            "notes",
            F.concat_ws(
                " ",
                F.col("qualified_months_count_12m").cast("string"),
                F.lit(NOTE_VOLUME),
                F.lit(str(int(rule.min_invoices_per_day))),
                F.lit(NOTE_RATIO),
                F.lit(str(int(rule.min_night_ratio * 100))),
                F.lit(NOTE_END),
            ),
        )
    )
    return (
        verdict,
        monthly,
    )
