"""Account balances: business-day staging, daily totals, and trailing features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.functions.aggregates import Condition, mean, over_windows, regression_over_windows
from ledgerlens.functions.scalars import BALANCE_UNIT
from ledgerlens.operators.joins import fill_subset, latest_business_day, merge_on_key

# Which holdings and which account types make up the balance.
HOLDING_STATUS = 1
EXCLUDED_LINE = "RETAIL"
HOLDING_PRODUCTS = ("Valuable papers issued to customers", "CORP_Valuable papers issued to customers")
BALANCE_TYPES = ("INDUE_PRIN_BAL", "INDUE_PRIN_BAL_DEBIT", "PST_DUE_PRIN")
INFLOW = "IN"

TOTAL = "a_bal_catd"
MONTHLY_TOTAL = "a_bal_catd_avgmly"
INFLOW_RATIO = "a_rto_amt_in_vs_catd"

CUSTOMER_DAY = ["cusid", "report_date"]


def business_days(calendar: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Dates of the range, each with the working day its balance is read from.

    The look-back reaches the start of the month before the range.
    """
    lookback = dates.month_start(first, 1)
    wide = calendar.select(F.col("date_code").cast("date").alias("date_code"), "off_date").filter(
        dates.within("date_code", lookback, last)
    )
    return latest_business_day(wide).filter(dates.within("date_code", first, last) & F.col("latest").isNotNull())


def positive_account_days(balances: DataFrame) -> DataFrame:
    """Account-days whose summed balance is positive."""
    return (
        balances.filter(F.col("au_tp_code").isin(*BALANCE_TYPES))
        .groupBy("unq_id_src_stm", F.col("ppn_dt").cast("date").alias("latest"))
        .agg(F.sum("net_amt_lcy").alias("net_amt_lcy"))
        .filter(F.col("net_amt_lcy") > 0)
    )


def balance_staging(
    calendar: DataFrame,
    holdings: DataFrame,
    balances: DataFrame,
    first: dt.date,
    last: dt.date,
    unit: float = BALANCE_UNIT,
) -> DataFrame:
    """Customer balance per calendar date, read at the latest working day.

    Customers are totalled per working day first; days off then repeat that total,
    so a weekend costs three output rows and not three times the join. Equal holding
    rows are counted before the join, so both of its sides are unique per account and
    day but for the customer. The calendar is broadcast: one row per requested date.
    """
    lookback = dates.month_start(first, 1)
    held = holdings.filter(
        (F.col("ds_rec_st") == HOLDING_STATUS)
        & (F.col("ar_bsn_line") != EXCLUDED_LINE)
        & F.col("pd_lvl_2_nm").isin(*HOLDING_PRODUCTS)
    ).select("unq_id_src_stm", F.col("ds_partition_date").cast("date").alias("latest"), "cst_code")
    held = held.filter(dates.within("latest", lookback, last))
    held = held.groupBy(*held.columns).agg(F.count(F.lit(1)).alias("rows"))
    accounts = positive_account_days(balances.filter(dates.within("ppn_dt", lookback, last)))
    working_day = (
        held.join(accounts, ["unq_id_src_stm", "latest"])
        .groupBy(F.col("cst_code").alias("cusid"), "latest")
        .agg((F.sum(F.col("net_amt_lcy") * F.col("rows")).cast("double") * F.lit(unit)).alias("asvcd_bal"))
    )
    calendar_days = F.broadcast(business_days(calendar, first, last))
    return working_day.join(calendar_days, "latest").select(
        "cusid", F.col("date_code").alias("report_date"), "asvcd_bal"
    )


def inflows(flows: DataFrame) -> DataFrame:
    """Incoming amount per customer and day; null where nothing came in."""
    return flows.groupBy(
        F.col("customer_code").alias("cusid"), F.col("ds_partition_date").cast("date").alias("report_date")
    ).agg(F.sum(F.when(F.col("cash_flow_lv1") == INFLOW, F.col("txn_amt"))).alias("trans_in_amt"))


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def balance_daily(
    current: DataFrame, deposits: DataFrame, flows: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Every customer-day that any of the three sources has, with the total balance."""

    def bounded(df: DataFrame, day: str) -> DataFrame:
        return df.filter(dates.within(day, first, last))

    merged = merge_on_key(
        [
            bounded(current, "report_date").select(*CUSTOMER_DAY, "atxca_bal"),
            bounded(deposits, "report_date").select(*CUSTOMER_DAY, "asvtd_bal"),
            inflows(bounded(flows, "ds_partition_date")),
        ],
        CUSTOMER_DAY,
    )
    return merged.withColumn(TOTAL, _or_zero("atxca_bal") + _or_zero("asvtd_bal"))


def inflow_ratio(inflow: Column, balance: Column) -> Column:
    """Inflow against balance; zero for a zero balance."""
    return F.when(balance == 0, F.lit(0.0)).otherwise(
        F.coalesce(inflow, F.lit(0)).cast("double") / balance.cast("double")
    )


def balance_monthly(daily: DataFrame) -> DataFrame:
    """Mean balances, inflow and their ratio per customer and month end.

    Balance means and inflow are one aggregate: they share the grain.
    """
    return (
        daily.groupBy("cusid", F.last_day("report_date").alias("report_date"))
        .agg(
            mean(F.col("atxca_bal")).alias("atxca_bal_avgmly"),
            mean(F.col("asvtd_bal")).alias("asvtd_bal_avgmly"),
            F.sum("trans_in_amt").alias("trans_in_amt_monthly"),
        )
        .withColumn(MONTHLY_TOTAL, _or_zero("atxca_bal_avgmly") + _or_zero("asvtd_bal_avgmly"))
        .withColumn(INFLOW_RATIO, inflow_ratio(F.col("trans_in_amt_monthly"), F.col(MONTHLY_TOTAL)))
    )


def nominal_average(total: Column, months: int) -> Column:
    """Period total over the nominal number of months, present or not."""
    return total.cast("double") / F.lit(months)


def monthly_balance_features(monthly: DataFrame, conditions: list[Condition]) -> DataFrame:
    """Trailing statistics of the monthly balance and the inflow ratio."""
    features = monthly.groupBy("cusid").agg(
        *over_windows([MONTHLY_TOTAL], ["sum", "min", "max", "std"], conditions),
        *over_windows([INFLOW_RATIO], ["sum", "min", "max"], conditions),
    )
    features = features.withColumns(
        {
            f"{metric}_avg_{name}": nominal_average(F.col(f"{metric}_sum_{name}"), months)
            for metric in (MONTHLY_TOTAL, INFLOW_RATIO)
            for name, months in dates.TRAILING_MONTHS.items()
        }
    )
    zero = [f"{MONTHLY_TOTAL}_min_{name}" for name in dates.TRAILING_MONTHS]
    zero += [f"{INFLOW_RATIO}_{f}_{name}" for f in ("avg", "min", "max") for name in dates.TRAILING_MONTHS]
    return fill_subset(features, zero)


def balance_features(
    current: DataFrame, deposits: DataFrame, flows: DataFrame, run_date: dt.date
) -> DataFrame:
    """One row per customer: monthly statistics, daily statistics, percentiles and trend.

    The daily frame is hashed on the customer once; the monthly roll-up and both
    feature aggregates reuse that layout, as does the join of the two. Exact
    percentiles buffer a customer's days, at most one year of them.
    """
    last = dates.last_closed_day(run_date)
    months = dates.trailing_starts(last)
    weeks = {f"l{n + 1}w": dates.month_anchor_weeks(last, n) for n in (0, 1)}
    daily = (
        balance_daily(current, deposits, flows, months["l12m"], last)
        .withColumn("date_id", F.date_diff("report_date", F.lit(dates.EPOCH_DAY)))
        .repartition("cusid")
    )
    monthly_windows = dates.since_conditions("report_date", months)
    daily_windows = dates.since_conditions("report_date", weeks | months)
    from_days = daily.groupBy("cusid").agg(
        *over_windows([TOTAL], ["avg", "min", "max"], daily_windows),
        *over_windows(
            [TOTAL],
            ["std", "pct10", "pct25", "med", "pct75", "pct90", "kurt", "skew"],
            monthly_windows,
            exact=True,
        ),
        *regression_over_windows([TOTAL], "date_id", ["regr_slope"], monthly_windows),
    )
    features = monthly_balance_features(balance_monthly(daily), monthly_windows).join(from_days, "cusid")
    return features.select(F.lit(last).alias("report_date"), "*")
