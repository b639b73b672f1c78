"""The wide one-row-per-seller feature table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.functions.aggregates import mean
from ledgerlens.functions.scalars import at_least, ratio
from ledgerlens.operators import month_states, trailing, windows
from ledgerlens.plans import grains
from ledgerlens.sources.invoices import CURRENT, InvoicePolicy, analysis_rows
from ledgerlens.sources.store import Growing, GrowingBuckets, in_slices, together

KEYS = ("as_of", "mst_seller")

ALL_FIVE = ("sum", "avg", "min", "max", "std")

# The direct daily feature groups.
SALES: dict[str, Sequence[str]] = dict.fromkeys(
    (
        "daily_total_sales",
        "daily_invoice_count",
        "daily_buyer_count",
        "daily_sales_per_buyer",
        "daily_sales_per_invoice",
        "daily_invoice_adjusted_count",
        "daily_invoice_adjusted_amount",
    ),
    ALL_FIVE,
)
NIGHT = dict.fromkeys(("daily_night_ratio", "daily_core_ratio"), ("avg", "max", "std"))
DISCOUNT = dict.fromkeys(("daily_discount_ratio", "daily_total_discount"), ("sum", "avg", "max"))
VALUE = dict.fromkeys(
    ("daily_avg_invoice_value", "daily_max_invoice_value"), ("avg", "max", "min", "std", "med", "skew")
)
MONTH_GAP = {"months_gap": ("sum",)}
ACTIVITY = {"days_gap": ("avg", "max", "min", "std")}
DIVERSITY = dict.fromkeys(("daily_distinct_payment_methods", "daily_distinct_transport"), ("avg", "max"))
DIRECT = SALES | NIGHT | DISCOUNT | VALUE | ACTIVITY | DIVERSITY

TOP_DAYS = (5, 10)
CHANGES = ("sales_amt_perc_change", "invoice_cnt_perc_change_self")

# Columns of the monthly table that are keys or inputs of others, not metrics.
NOT_METRICS = {
    "mst_seller",
    "as_of",
    "months_back",
    "report_date",
    "months_gap",
    "monthly_total_sales_last_mth",
    "monthly_invoice_count_last_mth",
}

# Thresholds of a month with suspicious night sales.
NIGHT_MIN_INVOICES = 100
NIGHT_MIN_RATIO = 0.30
NIGHT_MIN_MONTHS = 2


DIRECT_NAMES = [f"{c}_{f}" for c, functions in DIRECT.items() for f in functions]


def pack_direct(days: DataFrame) -> DataFrame:
    """Daily rows straight to windows, plus the best-day totals, in one aggregate.

    ``days`` is a trailing frame. Active days are a row count: the daily table has one
    row per date.
    """
    framed = windows.with_day_gap(days, KEYS, "report_date")
    framed = windows.ranked(framed, KEYS, "daily_total_sales", "report_date", "day_rank")
    measures = trailing.statistics(DIRECT) | {"active_days": F.count("report_date")}
    measures |= {f"top{k}_days_sales": windows.sum_of_top("day_rank", k, "daily_total_sales") for k in TOP_DAYS}
    return trailing.pack(framed, KEYS, measures, "direct")


def unpack_direct() -> list[str]:
    best = trailing.unpack("direct", [f"top{k}_days_sales" for k in TOP_DAYS], ["l12m"])
    return trailing.unpack("direct", [*DIRECT_NAMES, "active_days"], zero=["active_days"]) + best


def direct_features(days: DataFrame) -> DataFrame:
    return pack_direct(days).selectExpr(*KEYS, *unpack_direct())


def monthly_metrics(months: DataFrame) -> list[str]:
    """Every metric of the month grain: whatever is not a key or an input of another."""
    return [c for c in [*months.columns, *CHANGES] if c not in NOT_METRICS]


def pack_monthly(months: DataFrame) -> DataFrame:
    """Every monthly metric over every window, and the summed month gaps.

    ``months`` is a trailing frame of the month grain.
    """
    framed = windows.with_month_gap(grains.with_monthly_change(months, KEYS), KEYS, "report_date")
    spec = dict.fromkeys(monthly_metrics(months), ALL_FIVE) | MONTH_GAP
    return trailing.pack(framed, KEYS, trailing.statistics(spec), "monthly")


def unpack_monthly(metrics: Sequence[str]) -> list[str]:
    return trailing.unpack("monthly", [f"{c}_{f}" for c in metrics for f in ALL_FIVE])


def unpack_month_gaps() -> list[str]:
    return trailing.unpack("monthly", ["months_gap_sum"])


def monthly_features(months: DataFrame) -> DataFrame:
    return pack_monthly(months).selectExpr(*KEYS, *unpack_monthly(monthly_metrics(months)), *unpack_month_gaps())


def night_flag(months: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Night-sale verdict from the month grain."""
    suspicious = at_least(F.col("avg_invoices_per_day"), NIGHT_MIN_INVOICES) & at_least(
        F.col("avg_night_ratio"), NIGHT_MIN_RATIO
    )
    return (
        months.groupBy(*keys)
        .agg(
            F.count(F.when(suspicious, F.lit(1))).cast("int").alias("night_flag_qualified_months_l12m"),
            mean(F.col("avg_night_ratio")).alias("avg_night_ratio_l12m"),
            F.max("avg_night_ratio").alias("max_night_ratio_l12m"),
            mean(F.col("avg_core_ratio")).alias("avg_core_ratio_l12m"),
        )
        .withColumn("is_night_flagged", F.col("night_flag_qualified_months_l12m") >= NIGHT_MIN_MONTHS)
    )


def buyer_concentration(partners: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Twelve-month seller total, distinct buyers, and the share of the top 3 and 5.

    ``partners`` is a trailing frame. Totals combine before the shuffle and the top
    five survive a pre-shuffle rank limit, so a seller with most of all buyers is
    spread over many tasks until only five of them are left per task.
    """
    per_buyer = partners.groupBy(*keys, "mst_buyer").agg(F.sum("buyer_monthly_sales").alias("total_buyer_sales"))
    totals = per_buyer.groupBy(*keys).agg(
        F.sum("total_buyer_sales").alias("seller_total_sales_l12m"),
        F.count("mst_buyer").alias("distinct_buyers_l12m"),
    )
    best = (
        windows.top_rows(per_buyer, keys, "total_buyer_sales", "mst_buyer", 5)
        .groupBy(*keys)
        .agg(
            *[
                windows.sum_of_top("rank", k, "total_buyer_sales").alias(f"top{k}_buyer_sales_l12m")
                for k in (3, 5)
            ]
        )
    )
    return totals.join(best, list(keys), "left").withColumns(
        {
            f"top{k}_buyer_concentration_l12m": ratio(
                F.col(f"top{k}_buyer_sales_l12m"), F.col("seller_total_sales_l12m")
            )
            for k in (3, 5)
        }
    )


def top_day_shares(total: str = "direct['l12m'].top{0}_days_sales") -> list[str]:
    """Share of the best days in the buyer-side total, which is the published formula.

    The total comes from the partner table, which omits invoices without a buyer and
    by default ignores the status filter, so a share may exceed one.
    """
    return [
        f"CASE WHEN seller_total_sales_l12m > 0 THEN CAST({total.format(k)} AS DOUBLE)"
        f" / CAST(seller_total_sales_l12m AS DOUBLE) ELSE 0D END AS top{k}_days_concentration_l12m"
        for k in TOP_DAYS
    ]


# Measures that are whole numbers, and those whose values or largest values a state keeps.
WHOLE = (
    "daily_invoice_count",
    "daily_buyer_count",
    "daily_invoice_adjusted_count",
    "daily_distinct_payment_methods",
    "daily_distinct_transport",
    "days_gap",
)
KEPT_RUNS = tuple(c for c, functions in DIRECT.items() if "med" in functions)
KEPT_BEST = ("daily_total_sales",)


def states_of_days(grain: DataFrame) -> DataFrame:
    """Month states of all direct measures: what a window needs instead of its days."""
    daily = month_states.with_gap(grains.daily_sellers(grain), ["mst_seller"], "report_date")
    return month_states.month_states(daily, ["mst_seller"], "report_date", list(DIRECT), KEPT_RUNS, KEPT_BEST)


def _best_days(k: int | str) -> str:
    best = f"slice(states['daily_total_sales'][3].best, 1, {k})"
    return f"IF(size({best}) > 0, aggregate({best}, 0D, (a, v) -> a + v), NULL)"


def unpack_direct_states() -> list[str]:
    """As :func:`unpack_direct`, from merged month states."""
    active = [f"{month_states.statistic(f"states['daily_invoice_count'][{i}]", 'count')} AS active_days_{w}" for i, w in enumerate(dates.TRAILING_MONTHS)]
    best = [f"{_best_days(k)} AS top{k}_days_sales_l12m" for k in TOP_DAYS]
    return month_states.unpack_states(DIRECT, whole=WHOLE) + active + best


def _beside(table: DataFrame, group: DataFrame) -> DataFrame:
    """Left join on the keys within the layout by seller, which has few rows of a seller: one per
    report date. As a key of the join, the date would ask for a shuffle of both sides by it."""
    group = group.withColumnsRenamed({c: f"_{c}" for c in KEYS})
    same = (F.col("mst_seller") == F.col("_mst_seller")) & (F.datediff("as_of", "_as_of") == 0)
    return table.join(group, same, "left").drop(*[f"_{c}" for c in KEYS])


def _wide(
    direct: DataFrame,
    direct_columns: list[str],
    shares: list[str],
    months: DataFrame,
    pairs: DataFrame,
    this_month: DataFrame,
    night: bool,
) -> DataFrame:
    """The groups joined while their statistics are packed, then spread into columns once.

    ``direct`` has one row per key; ``months`` and ``pairs`` are trailing frames.
    """
    narrow = [night_flag(months)] if night else []
    narrow += [buyer_concentration(pairs), this_month]
    table = direct
    for group in (pack_monthly(months), *narrow):
        table = _beside(table, group)
    added = [f"`{c}`" for group in narrow for c in group.columns if c not in KEYS]
    return table.selectExpr(
        "as_of AS report_date",
        "mst_seller",
        *direct_columns,
        *unpack_monthly(monthly_metrics(months)),
        *added,
        *shares,
        *unpack_month_gaps(),
    )


def seller_features(
    grain: DataFrame,
    partners: DataFrame,
    run_dates: Sequence[dt.date],
    night: bool = False,
    by_seller: bool = False,
) -> DataFrame:
    """One row per (report date, seller) for every run date, in one pass.

    ``grain`` and ``partners`` are the full-history day and partner grains. The daily
    table is hashed on the seller once, unless it lies ``by_seller`` already
    (:func:`store.bucketed`); windows, monthly roll-up and both wide aggregates all work
    within that layout. Partners are never laid out by seller: their number has no bound.
    """
    last_days = [dates.last_closed_day(d) for d in run_dates]
    first, last = dates.month_start(min(last_days), 11), max(last_days)
    daily = grains.daily_sellers(grain).filter(dates.within("report_date", first, last))
    daily = daily if by_seller else daily.repartition("mst_seller")
    days = dates.trailing_frame(daily, "report_date", last_days)
    months = dates.trailing_frame(grains.month_grain(daily), "report_date", last_days)
    pairs = dates.trailing_frame(grains.buyer_months(partners), "month_start", last_days)
    this_month = grains.raw_monthly(grain, partners, last_days).withColumnRenamed("report_date", "as_of")
    return _wide(pack_direct(days), unpack_direct(), top_day_shares(), months, pairs, this_month, night)


def features_from_states(
    states: DataFrame,
    months: DataFrame,
    partners: DataFrame,
    this_month: DataFrame,
    run_dates: Sequence[dt.date],
    night: bool = False,
) -> DataFrame:
    """As :func:`seller_features`, without looking at days.

    ``states`` and ``months`` hold the month states and the month grain, ``partners`` the
    partner grain, of the last twelve months at least. ``this_month`` has the raw monthly
    features of each report date's own month (:func:`carry.raw_month`).
    """
    last_days = [dates.last_closed_day(d) for d in run_dates]
    return _wide(
        month_states.window_states(states, ["mst_seller"], last_days),
        unpack_direct_states(),
        top_day_shares(_best_days("{0}")),
        dates.trailing_frame(months, "report_date", last_days),
        dates.trailing_frame(grains.buyer_months(partners), "month_start", last_days),
        this_month.withColumnRenamed("report_date", "as_of"),
        night,
    )


def written_grains(rows: DataFrame, filter_pairs: bool = False) -> tuple[DataFrame, DataFrame]:
    """Day and partner grain of typed rows as tables, the days bucketed by seller.

    The rows are written first and worked slice by slice, so that what the grains shuffle never lies
    on disk for all rows at once. A slice holds whole seller-months, which both grains are made of.
    """
    spark = rows.sparkSession
    days = GrowingBuckets(spark, "days", "mst_seller", ["mst_seller", "report_date"])
    partners = Growing(spark, "partners")

    def use(part: DataFrame) -> None:
        together(spark, lambda: days.add(grains.day_grain(part)), lambda: partners.add(grains.partner_month(part, filter_pairs)))

    in_slices(rows, "rows", [F.col("mst_seller"), F.trunc("report_date", "month")], use)
    return days.read(), partners.read()


def from_invoices(
    invoices: DataFrame, run_dates: Sequence[dt.date], policy: InvoicePolicy = CURRENT
) -> DataFrame:
    """The feature table straight from logical invoices.

    The slim typed rows are written first and the grains from them, so that the invoices
    are read once (under adjusted sales: once more by the lookup of originals). Runs these
    writes to the shared folder when called; the files go when the process ends.
    """
    grain, partners = written_grains(analysis_rows(invoices, policy), policy.filter_pairs)
    return seller_features(grain, partners, run_dates, night=policy.night_flag, by_seller=True)
