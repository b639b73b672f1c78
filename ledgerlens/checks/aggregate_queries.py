"""Aggregation queries: grains, window statistics, and the stand-alone reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.checks import base_sql as q
from ledgerlens.checks import inputs
from ledgerlens.checks.feature_queries import (
    CONCENTRATION,
    DIRECT_SQL,
    MONTHLY_SQL,
    RAW_COLUMNS,
    RAW_COUNTS,
    typed_list,
    uniform,
)
from ledgerlens.checks.join_queries import BALANCES, adjusted_cte, balance_days
from ledgerlens.checks.registry import plain, query, snap_sql
from ledgerlens.functions import dates
from ledgerlens.functions.aggregates import over_windows, regression_over_windows
from ledgerlens.operators import trailing, windows
from ledgerlens.plans import buyer_profile, concentration, grains, night, sales_reports, seller_features, two_phase
from ledgerlens.sources import star_tables
from ledgerlens.sources.store import materialize

DAILY_COUNTS = [
    "daily_invoice_count",
    "daily_buyer_count",
    "daily_night_invoice_count",
    "daily_core_invoice_count",
    "daily_distinct_payment_methods",
    "daily_distinct_transport",
    "daily_invoice_adjusted_count",
    *[f"daily_invoice_count_tax{b}" for b in q.BANDS],
]
DAILY_EXACT = [
    "daily_total_sales",
    "daily_total_tax",
    "daily_total_discount",
    "daily_total_without_vat",
    "daily_total_with_vat",
    "daily_max_invoice_value",
    "daily_min_invoice_value",
    "daily_avg_invoice_value",
    "daily_invoice_adjusted_amount",
    *[f"daily_total_sales_tax{b}" for b in q.BANDS],
    "daily_night_ratio",
    "daily_core_ratio",
    "daily_discount_ratio",
    "daily_sales_per_buyer",
    "daily_sales_per_invoice",
]


@query(
    "agg_daily_seller",
    q.with_ctes(
        "daily",
        f"""SELECT mst_seller, report_date, {typed_list(DAILY_COUNTS, set(DAILY_COUNTS))},
                   {typed_list(DAILY_EXACT, snapped=None)},
                   {snap_sql('daily_std_invoice_value', 4)} AS daily_std_invoice_value FROM daily""",
    ),
)
def agg_daily_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table from written typed rows, as a run builds it: invoices are read once."""
    rows = materialize(inputs.typed(spark, sf_dir), "rows")
    return plain(grains.daily_sellers(grains.day_grain(rows)), 4, {"daily_std_invoice_value"})


STAGED_MONTHS = ["199711", "199712"]


@query(
    "staged_day_grain",
    q.with_ctes(
        "daily",
        f"""SELECT mst_seller, report_date, strftime(report_date, '%Y%m') AS stage_month,
                   {typed_list(DAILY_COUNTS, set(DAILY_COUNTS))}, {typed_list(DAILY_EXACT, snapped=None)}
            FROM daily WHERE strftime(report_date, '%Y%m') IN ('199711', '199712')""",
    ),
)
def staged_day_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged days of two months, whose rows came in partitions of any month."""
    typed = inputs.typed(spark, sf_dir)
    source = F.date_format(F.add_months("report_date", F.pmod(F.xxhash64("mst_buyer", "hour"), F.lit(7)).cast("int") - 3), "yyyyMM")
    days, _ = two_phase.grains_of_months(two_phase.rows_by_month(typed, source), STAGED_MONTHS)
    daily = grains.daily_sellers(days)
    return plain(daily.select("mst_seller", "report_date", "stage_month", *DAILY_COUNTS, *DAILY_EXACT), 4, set())


@query(
    "agg_buyer_month",
    q.with_ctes("partner", "SELECT * FROM partner"),
)
def agg_buyer_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grains.buyer_months(inputs.partners(spark, sf_dir))


MONTH_COUNTS = {n for n, c in q.SUM_UP.items() if c in DAILY_COUNTS} | {"active_days"}
MONTH_COLUMNS = [*q.SUM_UP, *q.AVERAGE, "active_days"]


@query(
    "agg_daily_to_month",
    q.with_ctes(
        "monthly_all", f"SELECT mst_seller, report_date, {typed_list(MONTH_COLUMNS, MONTH_COUNTS)} FROM monthly_all"
    ),
)
def agg_daily_to_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(grains.month_grain(inputs.daily(spark, sf_dir), top_days=()), 4)


SQL_MONTH_COUNTS = {
    "monthly_invoice_count",
    "monthly_total_buyer_touches",
    "monthly_night_invoices",
    "monthly_active_days",
}


def _sql_month() -> str:
    source = {"sum": "sum({})", "avg": "CAST(sum({0}) AS DOUBLE) / count({0})", "count": "count(DISTINCT {})"}
    columns = ", ".join(
        f"{source[f].format(c)} AS {n}" for n, (f, c) in grains.MONTHLY_MEASURES_SQL.items()
    )
    selected = typed_list(list(grains.MONTHLY_MEASURES_SQL), SQL_MONTH_COUNTS)
    return q.with_ctes(
        "daily",
        f"""SELECT mst_seller, report_date, {selected} FROM (SELECT mst_seller, last_day(daily.report_date) AS
            report_date, {columns.replace('report_date', 'daily.report_date')} FROM daily
            GROUP BY mst_seller, last_day(daily.report_date))""",
    )


@query("agg_daily_to_month_sql", _sql_month())
def agg_daily_to_month_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly table under the SQL reading's names and measures."""
    return plain(grains.month_grain(inputs.daily(spark, sf_dir), grains.MONTHLY_MEASURES_SQL, top_days=()), 4)


@query(
    "agg_month_to_period",
    q.with_ctes("change", MONTHLY_SQL),
)
def agg_month_to_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = grains.month_grain(inputs.daily(spark, sf_dir))
    framed = dates.trailing_frame(months, "report_date", [inputs.LAST_DAY])
    return uniform(seller_features.monthly_features(framed).drop("as_of"))


@query("agg_direct_groups", q.with_ctes("recent", DIRECT_SQL))
def agg_direct_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniform(seller_features.direct_features(inputs.recent_days(spark, sf_dir)).drop("as_of"))


PERIOD_FUNCTIONS = ["sum", "avg", "min", "max", "std", "kurt", "skew", "count", "countDistinct", "med", "pct25", "pct75"]


def _period_sql(functions: list[str], column: str, exact: bool) -> str:
    out = []
    for f in functions:
        for name, start in q.PERIODS.items():
            value = f"CASE WHEN report_date >= DATE '{start}' THEN {column} END"
            if f == "kurt":
                e = f"CASE WHEN var_pop({value}) > 1e-9 THEN kurtosis_pop({value}) END"
            elif exact and f in EXACT_RANKS:
                e = f"quantile_cont({value}, {EXACT_RANKS[f]})"
            else:
                e = q.aggregate_sql(f, value)
            e = e if f in ("count", "countDistinct") else snap_sql(e, 4)
            out.append(f'{e} AS "{column}_{f}_{name}"')
    return ", ".join(out)


EXACT_RANKS = {"pct5": 0.05, "pct10": 0.1, "pct25": 0.25, "med": 0.5, "pct75": 0.75, "pct90": 0.9, "pct95": 0.95}


@query(
    "agg_multi_period",
    q.with_ctes(
        "recent",
        f"SELECT mst_seller, {_period_sql(PERIOD_FUNCTIONS, 'daily_total_sales', False)} FROM recent GROUP BY ALL",
    ),
)
def agg_multi_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = dates.since_conditions("report_date", dates.trailing_starts(inputs.LAST_DAY))
    daily = inputs.recent_daily(spark, sf_dir)
    return plain(
        daily.groupBy("mst_seller").agg(*over_windows(["daily_total_sales"], PERIOD_FUNCTIONS, conditions)), 4
    )


EXACT_FUNCTIONS = ["sum", "avg", "min", "max", "std", *EXACT_RANKS, "kurt", "skew"]


@query(
    "agg_multi_period_exact",
    f"WITH {BALANCES} SELECT cusid, {_period_sql(EXACT_FUNCTIONS, 'a_bal_catd', True)} FROM bal GROUP BY ALL",
)
def agg_multi_period_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = dates.since_conditions("report_date", dates.trailing_starts(inputs.LAST_DAY))
    statistics = over_windows(["a_bal_catd"], EXACT_FUNCTIONS, conditions, exact=True)
    return plain(balance_days(spark, sf_dir).groupBy("cusid").agg(*statistics), 4)


def _regression_sql() -> str:
    out = []
    for f in ("regr_slope", "regr_intercept", "regr_r2"):
        for name, start in q.PERIODS.items():
            inside = f"report_date >= DATE '{start}'"
            y = f"CASE WHEN {inside} THEN a_bal_catd END"
            x = f"CASE WHEN {inside} THEN datediff('day', DATE '2020-01-01', report_date) END"
            enough = f"count(DISTINCT {x}) > 1"
            digits = 2 if f == "regr_intercept" else 4
            out.append(f"{snap_sql(f'CASE WHEN {enough} THEN {f}({y}, {x}) END', digits)} AS a_bal_catd_{f}_{name}")
    return f"WITH {BALANCES} SELECT cusid, {', '.join(out)} FROM bal GROUP BY cusid"


@query("agg_regression", _regression_sql())
def agg_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = dates.since_conditions("report_date", dates.trailing_starts(inputs.LAST_DAY))
    daily = balance_days(spark, sf_dir).withColumn("day", F.date_diff("report_date", F.lit(dates.EPOCH_DAY)))
    fits = daily.groupBy("cusid").agg(
        *regression_over_windows(["a_bal_catd"], "day", ["regr_slope", "regr_intercept", "regr_r2"], conditions)
    )
    return plain(plain(fits, 4, {c for c in fits.columns if "intercept" not in c}), 2, {
        c for c in fits.columns if "intercept" in c
    })


SQL_SPEC = {
    "daily_total_sales": ["sum", "avg", "min", "max", "std", "med"],
    "daily_buyer_count": ["countDistinct"],
}


@query(
    "agg_sql_period",
    q.with_ctes(
        "recent",
        "SELECT mst_seller, "
        + ", ".join(_period_sql(fs, c, True) for c, fs in SQL_SPEC.items())
        + " FROM recent GROUP BY ALL",
    ),
)
def agg_sql_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = dates.since_conditions("report_date", dates.trailing_starts(inputs.LAST_DAY))
    statistics = [e for c, fs in SQL_SPEC.items() for e in over_windows([c], fs, conditions, exact=True)]
    return plain(inputs.recent_daily(spark, sf_dir).groupBy("mst_seller").agg(*statistics), 4)


@query(
    "agg_active_days",
    q.with_ctes(
        "recent",
        "SELECT mst_seller, "
        + ", ".join(
            f"count(DISTINCT CASE WHEN report_date >= DATE '{s}' THEN report_date END) AS active_days_{n}"
            for n, s in q.PERIODS.items()
        )
        + " FROM recent GROUP BY ALL",
    ),
)
def agg_active_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = trailing.pack(
        inputs.recent_days(spark, sf_dir), ["mst_seller"], {"active_days": F.count("report_date")}, "w"
    )
    return packed.selectExpr("mst_seller", *trailing.unpack("w", ["active_days"], zero=["active_days"]))


@query(
    "agg_adjusted_invoice",
    q.with_ctes(
        "typed",
        """SELECT mst_seller, report_date, count(adjusted) AS daily_invoice_adjusted_count,
                  sum(coalesce(adjusted, 0)) AS daily_invoice_adjusted_amount FROM typed WHERE counts GROUP BY ALL""",
    ),
)
def agg_adjusted_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.daily(spark, sf_dir).select(
        "mst_seller", "report_date", "daily_invoice_adjusted_count", "daily_invoice_adjusted_amount"
    )


@query(
    "agg_tax_band",
    q.with_ctes(
        "banded",
        "SELECT mst_seller, "
        + ", ".join(f"count(*) FILTER (WHERE band = '{b}') AS invoice_count_tax{b}" for b in q.BANDS)
        + ", "
        + ", ".join(f"sum(CASE WHEN band = '{b}' THEN total_sales ELSE 0 END) AS total_sales_tax{b}" for b in q.BANDS)
        + " FROM banded GROUP BY ALL",
    ),
)
def agg_tax_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = grains.tax_band_measures(F.col("tax_band"), F.col("total_sales"))
    return inputs.typed(spark, sf_dir).groupBy("mst_seller").agg(*[e.alias(n) for n, e in measures.items()])


def _extremes(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    found = grains.partner_extremes(materialize(inputs.partners(spark, sf_dir), "partners"))
    return plain(found.select("mst_seller", "report_date", *columns), snapped=set())


def _extremes_sql(columns: list[str]) -> str:
    selected = typed_list(columns, RAW_COUNTS, snapped=None)
    return q.with_ctes("extremes", f"SELECT mst_seller, report_date, {selected} FROM extremes")


TOTALS = ["monthly_total_discount_buyer_taxcode", "monthly_distinct_buyer_count", "monthly_total_sales_buyer_taxcode"]
FREQUENT = [c for c in RAW_COLUMNS if "freq_buyer" in c]
BIGGEST = ["monthly_sales_amt", *[c for c in RAW_COLUMNS if "big_buyer" in c]]


@query("agg_taxcode_totals", _extremes_sql(TOTALS))
def agg_taxcode_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extremes(spark, sf_dir, TOTALS)


@query("win_freq_buyer", _extremes_sql(FREQUENT))
def win_freq_buyer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extremes(spark, sf_dir, FREQUENT)


@query("agg_top_buyers_cond", _extremes_sql(BIGGEST))
def agg_top_buyers_cond(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extremes(spark, sf_dir, BIGGEST)


@query(
    "agg_highest_invoice",
    q.with_ctes(
        "typed",
        """SELECT mst_seller AS seller, CAST(year(report_date) AS BIGINT) AS year,
                  CAST(month(report_date) AS BIGINT) AS month, max(total_sales) AS max_invoice_total_sales
           FROM typed GROUP BY ALL""",
    ),
)
def agg_highest_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(sales_reports.highest_invoice_per_month(inputs.sales_rows(spark, sf_dir)), snapped=set())


@query(
    "win_gap_sum_month",
    q.with_ctes(
        ["gaps", "named_gaps", "highest"],
        """SELECT mst_seller, report_date, monthly_sales_amt_highest_inv, CAST(day_cnt_no_sales AS BIGINT) AS
                  day_cnt_no_sales, CAST(day_cnt_no_sales_per_cus_taxcode AS BIGINT) AS day_cnt_no_sales_per_cus_taxcode
           FROM gaps LEFT JOIN named_gaps USING (mst_seller, report_date)
           LEFT JOIN highest USING (mst_seller, report_date)""",
    ),
)
def win_gap_sum_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(grains.silent_days(inputs.day_grain(spark, sf_dir)), snapped=set())


@query(
    "raw_monthly_features",
    q.with_ctes(
        "raw_months", f"SELECT mst_seller, report_date, {typed_list(RAW_COLUMNS, RAW_COUNTS)} FROM raw_months"
    ),
)
def raw_monthly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(inputs.typed(spark, sf_dir), "rows")
    return uniform(grains.raw_monthly(grains.day_grain(rows), materialize(grains.partner_month(rows), "partners")))


@query(
    "win_topn_buyers",
    q.with_ctes(
        "concentration",
        f"""SELECT mst_seller, {typed_list(['seller_total_sales_l12m', 'distinct_buyers_l12m', *CONCENTRATION],
                                           {'distinct_buyers_l12m'}, snapped=None)} FROM concentration""",
    ),
)
def win_topn_buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = dates.trailing_frame(inputs.partners(spark, sf_dir), "month_start", [inputs.LAST_DAY])
    return plain(seller_features.buyer_concentration(pairs, ["mst_seller"]), snapped=set())


@query(
    "win_topn_days",
    q.with_ctes(
        ["recent", "concentration"],
        """SELECT t.mst_seller, top5 AS top5_days_sales_l12m, top10 AS top10_days_sales_l12m,
                  CASE WHEN seller_total_sales_l12m > 0 THEN top5 / seller_total_sales_l12m ELSE 0 END
                      AS top5_days_concentration_l12m,
                  CASE WHEN seller_total_sales_l12m > 0 THEN top10 / seller_total_sales_l12m ELSE 0 END
                      AS top10_days_concentration_l12m
           FROM (SELECT mst_seller, sum(daily_total_sales) FILTER (WHERE r <= 5) AS top5,
                        sum(daily_total_sales) FILTER (WHERE r <= 10) AS top10
                 FROM (SELECT *, row_number() OVER (PARTITION BY mst_seller
                              ORDER BY daily_total_sales DESC, report_date) AS r FROM recent) GROUP BY ALL) t
           LEFT JOIN concentration c ON c.mst_seller = t.mst_seller""",
    ),
)
def win_topn_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = windows.ranked(
        inputs.recent_days(spark, sf_dir), seller_features.KEYS, "daily_total_sales", "report_date", "day_rank"
    )
    totals = {
        f"top{k}_days_sales": windows.sum_of_top("day_rank", k, "daily_total_sales") for k in seller_features.TOP_DAYS
    }
    packed = trailing.pack(ranked, seller_features.KEYS, totals, "direct")
    pairs = dates.trailing_frame(inputs.partners(spark, sf_dir), "month_start", [inputs.LAST_DAY])
    joined = packed.join(seller_features.buyer_concentration(pairs), list(seller_features.KEYS), "left")
    best = trailing.unpack("direct", [f"top{k}_days_sales" for k in seller_features.TOP_DAYS], ["l12m"])
    return joined.selectExpr("mst_seller", *best, *seller_features.top_day_shares())


@query(
    "win_topn_days_month",
    q.with_ctes(
        "monthly_all",
        """SELECT mst_seller, report_date, top5_days_by_month_sales, top10_days_by_month_sales,
                  top5_days_by_month_concentration, top10_days_by_month_concentration FROM monthly_all""",
    ),
)
def win_topn_days_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = grains.month_grain(inputs.daily(spark, sf_dir))
    return months.select("mst_seller", "report_date", *[c for c in months.columns if c.startswith("top")])


@query(
    "win_invoice_gap",
    q.with_ctes(
        "daily",
        """SELECT mst_seller, report_date, datediff('day', lag(report_date) OVER (PARTITION BY mst_seller
                  ORDER BY report_date), report_date) AS days_gap FROM daily""",
    ),
)
def win_invoice_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = inputs.daily(spark, sf_dir).select("mst_seller", "report_date")
    return plain(windows.with_day_gap(daily, ["mst_seller"], "report_date"))


@query(
    "win_month_gap",
    q.with_ctes(
        "change", "SELECT mst_seller, " + q.windows_sql(["months_gap"], ["sum"]) + " FROM change GROUP BY ALL"
    ),
)
def win_month_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = dates.trailing_frame(grains.month_grain(inputs.daily(spark, sf_dir)), "report_date", [inputs.LAST_DAY])
    framed = windows.with_month_gap(months, ["mst_seller"], "report_date")
    packed = trailing.pack(framed, ["mst_seller"], trailing.statistics(seller_features.MONTH_GAP), "monthly")
    return plain(packed.selectExpr("mst_seller", *seller_features.unpack_month_gaps()), 4)


@query(
    "win_mom_change",
    q.with_ctes(
        "change_all",
        """SELECT mst_seller, report_date, monthly_total_sales_last_mth, CAST(monthly_invoice_count_last_mth AS BIGINT)
                  AS monthly_invoice_count_last_mth, CAST(sales_amt_perc_change AS DOUBLE) AS sales_amt_perc_change,
                  CAST(invoice_cnt_perc_change_self AS DOUBLE) AS invoice_cnt_perc_change_self FROM change_all""",
    ),
)
def win_mom_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = grains.with_monthly_change(grains.month_grain(inputs.daily(spark, sf_dir), top_days=()))
    return months.select(
        "mst_seller",
        "report_date",
        "monthly_total_sales_last_mth",
        "monthly_invoice_count_last_mth",
        "sales_amt_perc_change",
        "invoice_cnt_perc_change_self",
    )


@query(
    "win_cumulative_share",
    q.with_ctes(
        "daily",
        """SELECT mst_seller, report_date, day_rank, cum_revenue,
                  CASE WHEN total > 0 THEN cum_revenue / total ELSE 0 END AS cum_pct
           FROM (SELECT mst_seller, report_date, row_number() OVER w AS day_rank,
                        sum(daily_total_sales) OVER (w ROWS UNBOUNDED PRECEDING) AS cum_revenue,
                        sum(daily_total_sales) OVER (PARTITION BY mst_seller, last_day(report_date)) AS total
                 FROM daily WINDOW w AS (PARTITION BY mst_seller, last_day(report_date)
                                         ORDER BY daily_total_sales DESC, report_date))""",
    ),
)
def win_cumulative_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = inputs.daily(spark, sf_dir).select(
        "mst_seller", "report_date", "daily_total_sales", F.last_day("report_date").alias("m")
    )
    shared = windows.with_running_share(
        daily, ["mst_seller", "m"], "daily_total_sales", "report_date", "day_rank", "cum_revenue", "cum_pct"
    )
    return plain(shared.drop("m", "daily_total_sales"), snapped=set())


SALES_ROWS = """s AS (SELECT mst_seller AS seller, report_date AS day, total_sales AS sales, mst_buyer AS buyer,
                             discount_amt AS discount FROM typed),
    per_month AS (SELECT CAST(year(day) AS BIGINT) AS year, CAST(month(day) AS BIGINT) AS month,
                         sum(sales) AS total_sales, count(DISTINCT buyer) AS num_buyers FROM s GROUP BY ALL),
    per_buyer AS (SELECT buyer, count(*) AS num_transactions, sum(sales) AS total_sales, sum(discount) AS total_discount
                  FROM s GROUP BY ALL)"""


def sales_sql(body: str) -> str:
    return q.with_ctes("typed", "").rstrip() + f", {SALES_ROWS} {body}"


def sales_query(name: str, report, sql: str) -> None:
    """Register one stand-alone sales report."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(report(inputs.sales_rows(spark, sf_dir)), snapped=set())

    query(name, sales_sql(sql))(run)


sales_query(
    "win_top5_days_per_seller",
    sales_reports.top5_days_total,
    """SELECT seller, sum(t) AS total_sales_top5 FROM (SELECT seller, t, row_number() OVER (PARTITION BY seller
              ORDER BY t DESC, day) AS r FROM (SELECT seller, day, sum(sales) AS t FROM s GROUP BY ALL))
       WHERE r <= 5 GROUP BY ALL""",
)
sales_query(
    "agg_argmax_ties",
    sales_reports.months_with_most_sales,
    "SELECT year, month, total_sales FROM per_month WHERE total_sales = (SELECT max(total_sales) FROM per_month)",
)
sales_query(
    "agg_argmax_ties_buyers",
    sales_reports.months_with_most_buyers,
    "SELECT year, month, num_buyers FROM per_month WHERE num_buyers = (SELECT max(num_buyers) FROM per_month)",
)
sales_query(
    "agg_argmax_ties_frequent",
    lambda rows: sales_reports.most_frequent_buyers(rows.filter(F.col("buyer").isNotNull())),
    """SELECT buyer, num_transactions FROM per_buyer WHERE buyer IS NOT NULL
       AND num_transactions = (SELECT max(num_transactions) FROM per_buyer WHERE buyer IS NOT NULL)""",
)
sales_query(
    "agg_argmin_ties",
    sales_reports.transactions_of_least_frequent_buyers,
    """SELECT count(*) AS num_transactions FROM s JOIN (SELECT buyer FROM per_buyer
       WHERE num_transactions = (SELECT min(num_transactions) FROM per_buyer)) USING (buyer)""",
)
sales_query(
    "agg_discount_top_buyers",
    lambda rows: sales_reports.discount_of_most_frequent_buyers(rows.filter(F.col("buyer").isNotNull())),
    """SELECT buyer, sum(discount) AS total_discount FROM s JOIN (SELECT buyer FROM per_buyer WHERE num_transactions
       = (SELECT max(num_transactions) FROM per_buyer WHERE buyer IS NOT NULL)) USING (buyer) GROUP BY ALL""",
)
sales_query(
    "agg_top3_buyer_total",
    sales_reports.sales_with_top_buyers,
    """SELECT sum(sales) AS total_sales_with_top3_buyers FROM s JOIN (SELECT buyer FROM per_buyer
       ORDER BY total_sales DESC, buyer LIMIT 3) USING (buyer)""",
)
sales_query(
    "topk_global",
    lambda rows: sales_reports.top_buyers(rows, 10),
    "SELECT buyer, total_sales FROM per_buyer ORDER BY total_sales DESC, buyer LIMIT 10",
)
sales_query(
    "agg_count_no_sale_days",
    sales_reports.days_without_sales,
    """SELECT datediff('day', min(day), max(day)) + 1 - count(DISTINCT day) AS num_days_without_sales FROM s""",
)
sales_query(
    "win_gap_global_max",
    sales_reports.longest_gap,
    """SELECT max(g) AS max_days_gap FROM (SELECT datediff('day', lag(day) OVER (ORDER BY day), day) AS g
       FROM (SELECT DISTINCT day FROM s))""",
)
sales_query(
    "win_gap_buyer_max",
    sales_reports.longest_gap_per_buyer,
    """SELECT buyer, max(g) AS max_days_gap FROM (SELECT buyer, datediff('day', lag(day) OVER
       (PARTITION BY buyer ORDER BY day), day) AS g FROM (SELECT DISTINCT buyer, day FROM s)) GROUP BY ALL""",
)

PROFILE = adjusted_cte("adjust_status", 2, 3) + ", a AS (SELECT * FROM adjusted WHERE status = '1' AND buyer IS NOT NULL)"


def _profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(buyer_profile.buyer_profile(star_tables.order_invoices(spark, sf_dir)), snapped=set())


def _mode_sql(column: str) -> str:
    return f"""(SELECT partition_month, buyer, count(*) AS count_{column}, min_by({column}, r) AS most_freq_{column}
                FROM (SELECT *, row_number() OVER (PARTITION BY partition_month, buyer ORDER BY n DESC, {column}) AS r
                      FROM (SELECT partition_month, buyer, {column}, count(DISTINCT invoice_id) AS n FROM a
                            WHERE {column} IS NOT NULL GROUP BY ALL)) GROUP BY ALL)"""


@query(
    "agg_attribute_mode",
    PROFILE
    + f""" SELECT * FROM {_mode_sql('transport')} FULL JOIN {_mode_sql('payment')} USING (partition_month, buyer)
           FULL JOIN {_mode_sql('buyer_address')} USING (partition_month, buyer)""",
)
def agg_attribute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [f"{kind}_{c}" for c in buyer_profile.ATTRIBUTES for kind in ("count", "most_freq")]
    return _profile_rows(spark, sf_dir).select("partition_month", "buyer", *columns)


RATIOS = {
    "total_sales_per_number_buyer": ("total_sales", "number_of_buyer"),
    "total_sales_per_number_invoice": ("total_sales", "number_of_invoice"),
    "total_sales_per_number_sold_item": ("total_sales", "number_of_sold_item"),
    "number_sold_item_per_number_invoice": ("number_of_sold_item", "number_of_invoice"),
    "number_sold_item_per_number_buyer": ("number_of_sold_item", "number_of_buyer"),
    "discount_per_sales": ("total_discount", "total_sales"),
}


@query(
    "agg_buyer_ratios",
    PROFILE
    + " SELECT *, "
    + ", ".join(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0) AS {n}" for n, (a, b) in RATIOS.items())
    + """ FROM (SELECT partition_month, buyer, sum(worth) AS total_sales, count(DISTINCT buyer_name) AS number_of_buyer,
                 count(DISTINCT invoice_id) AS number_of_invoice, count(DISTINCT items) AS number_of_sold_item,
                 sum(settlement_discount) AS total_discount FROM a GROUP BY ALL)""",
)
def agg_buyer_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _profile_rows(spark, sf_dir)
    return rows.select(*[c for c in rows.columns if not c.startswith(("count_", "most_freq_"))])


CONCENTRATE = """daily AS (SELECT CAST(o_custkey % 200 AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS day,
                       CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
                       sum(floor(o_totalprice / 100) - 1500) AS revenue FROM orders
                WHERE date_trunc('month', o_orderdate) IN (SELECT DISTINCT date_trunc('month', o_orderdate) AS x
                      FROM orders ORDER BY x DESC LIMIT 12) GROUP BY ALL),
    ranked AS (SELECT {id} m, day, revenue, row_number() OVER w AS day_rank,
                      CASE WHEN sum(revenue) OVER (PARTITION BY {id} m) > 0 THEN sum(revenue) OVER (w ROWS UNBOUNDED
                           PRECEDING) / sum(revenue) OVER (PARTITION BY {id} m) ELSE 0 END AS cum_pct
               FROM {source} WINDOW w AS (PARTITION BY {id} m ORDER BY revenue DESC, day)),
    need AS (SELECT {id} m, min(day_rank) AS needed FROM ranked WHERE cum_pct >= 0.8 GROUP BY ALL),
    taken AS (SELECT {id} m, max(cum_pct) AS covered_pct, string_agg(CAST(day(day) AS VARCHAR), ',' ORDER BY day) AS picked
              FROM ranked JOIN need USING ({id} m) WHERE day_rank <= needed GROUP BY ALL)
    SELECT {id} strftime(m, '%Y-%m') AS month, m AS month_start, sum(revenue) AS net_month_total,
           sum(revenue) AS month_total, any_value(needed) AS days_needed_for_threshold,
           any_value(covered_pct) AS covered_pct, any_value(picked) AS selected_days,
           count(*) AS total_days_in_month_in_data, any_value(needed) / CAST(count(*) AS DOUBLE) AS share_of_days
    FROM {source} LEFT JOIN need USING ({id} m) LEFT JOIN taken USING ({id} m) GROUP BY ALL"""


def _concentrated(spark: SparkSession, sf_dir: str, by_customer: bool) -> DataFrame:
    orders = star_tables.read(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 200).cast("string").alias("id"),
        F.col("o_orderdate").alias("invoice_date"),
        (F.floor(F.col("o_totalprice") / 100) - 1500).alias("amount"),
    )
    report = concentration.revenue_concentration(orders, id_col="id", by_customer=by_customer)
    days = F.array_join(F.transform("selected_days", lambda d: d.cast("string")), ",")
    return plain(report.withColumn("selected_days", days), snapped=set())


@query("revenue_concentration", "WITH " + CONCENTRATE.format(id="id,", source="daily"))
def revenue_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _concentrated(spark, sf_dir, True)


@query(
    "revenue_concentration_overall",
    "WITH "
    + CONCENTRATE.replace("    ranked AS", "    alldays AS (SELECT day, m, sum(revenue) AS revenue FROM daily GROUP BY ALL),\n    ranked AS")
    .format(id="", source="alldays"),
)
def revenue_concentration_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _concentrated(spark, sf_dir, False)


NIGHT_RULE = night.NightRule(min_invoices_per_day=2.0, min_night_ratio=0.30, min_months=1)
NIGHT_CTE = """d AS (SELECT CAST(user_id AS VARCHAR) AS issuer, CAST(ts AS DATE) AS day, count(*) AS n,
                 count(*) FILTER (WHERE hour(ts) >= 22 OR hour(ts) < 6) / CAST(count(*) AS DOUBLE) AS night_ratio,
                 count(*) FILTER (WHERE hour(ts) < 4) / CAST(count(*) AS DOUBLE) AS core_ratio,
                 count(*) FILTER (WHERE hour(ts) >= 22 OR hour(ts) < 6) AS nights
          FROM events WHERE ts >= TIMESTAMP '2023-02-01' GROUP BY ALL),
    m0 AS (SELECT issuer, CAST(date_trunc('month', day) AS DATE) AS month_start, sum(night_ratio) / count(*)
                 AS avg_night_ratio_month, sum(core_ratio) / count(*) AS avg_core_ratio_month, count(*) AS active_days,
                 CAST(sum(n) AS BIGINT) AS total_invoices_month, CAST(sum(nights) AS BIGINT) AS total_night_invoices_month
          FROM d GROUP BY ALL),
    m AS (SELECT *, strftime(month_start, '%Y-%m') AS month, total_invoices_month / CAST({days} AS DOUBLE)
                 AS avg_invoices_per_day_month FROM m0),
    months AS (SELECT *, avg_invoices_per_day_month >= 2 AS meets_volume, avg_night_ratio_month >= 0.3 - 1e-9 AS
                 meets_night_ratio, avg_invoices_per_day_month >= 2 AND avg_night_ratio_month >= 0.3 - 1e-9 AS qualified_month
               FROM m)"""
BY_ACTIVE_DAYS = NIGHT_CTE.replace("{days}", "active_days")
BY_CALENDAR = NIGHT_CTE.replace("{days}", "day(last_day(month_start))")


def _night(spark: SparkSession, sf_dir: str, calendar_days: bool = False) -> tuple[DataFrame, DataFrame]:
    return night.night_sales(
        star_tables.event_invoices(spark, sf_dir),
        ts_col="ts",
        now="2024-02-01 00:00:00",
        calendar_days=calendar_days,
        rule=NIGHT_RULE,
    )


@query(
    "night_flag_report",
    f"""WITH {BY_ACTIVE_DAYS} SELECT issuer, count(*) FILTER (WHERE qualified_month) AS qualified_months_count_12m,
        coalesce(string_agg(month, ',' ORDER BY month) FILTER (WHERE qualified_month), '') AS qualified_months,
        count(*) FILTER (WHERE qualified_month) >= 1 AS is_flagged,
        count(*) FILTER (WHERE qualified_month) || ' tháng đạt: TB>= 2 HĐ/ngày & TB>= 30 % HĐ ban đêm' AS notes
        FROM months GROUP BY ALL""",
)
def night_flag_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = _night(spark, sf_dir)[0]
    return plain(verdict.withColumn("qualified_months", F.array_join("qualified_months", ",")))


def _night_months(sql: str) -> str:
    return f"""WITH {sql} SELECT * REPLACE ({snap_sql('avg_night_ratio_month')} AS avg_night_ratio_month,
               {snap_sql('avg_core_ratio_month')} AS avg_core_ratio_month,
               {snap_sql('avg_invoices_per_day_month')} AS avg_invoices_per_day_month) FROM months"""


@query("night_flag_monthly", _night_months(BY_ACTIVE_DAYS))
def night_flag_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_night(spark, sf_dir)[1], 6)


@query("night_flag_calendar_days", _night_months(BY_CALENDAR))
def night_flag_calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_night(spark, sf_dir, calendar_days=True)[1], 6)


@query(
    "night_flag_feature",
    q.with_ctes(
        "monthly",
        f"""SELECT mst_seller, count(*) FILTER (WHERE avg_invoices_per_day >= 100 AND avg_night_ratio >= 0.3 - 1e-9)
                   AS night_flag_qualified_months_l12m, {snap_sql('sum(avg_night_ratio) / count(*)')} AS
                   avg_night_ratio_l12m, {snap_sql('max(avg_night_ratio)')} AS max_night_ratio_l12m,
                   {snap_sql('sum(avg_core_ratio) / count(*)')} AS avg_core_ratio_l12m,
                   count(*) FILTER (WHERE avg_invoices_per_day >= 100 AND avg_night_ratio >= 0.3 - 1e-9) >= 2
                   AS is_night_flagged FROM monthly GROUP BY ALL""",
    ),
)
def night_flag_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = grains.month_grain(inputs.recent_daily(spark, sf_dir), top_days=())
    return plain(seller_features.night_flag(months, ["mst_seller"]), 6)


@query(
    "agg_collect",
    """SELECT CAST(o_custkey AS VARCHAR) AS buyer, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority)
              AS priorities FROM orders GROUP BY ALL""",
)
def agg_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star_tables.read(spark, sf_dir, "orders")
    distinct = F.array_sort(F.collect_set("o_orderpriority"))  # five priorities exist
    return orders.groupBy(F.col("o_custkey").cast("string").alias("buyer")).agg(
        F.array_join(distinct, ",").alias("priorities")
    )


@query(
    "agg_distinct",
    q.with_ctes(
        "typed",
        """SELECT mst_seller, count(DISTINCT mst_buyer) AS buyers, count(DISTINCT payment) AS payments,
                  count(DISTINCT report_date) AS days FROM typed GROUP BY ALL""",
    ),
)
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.functions.aggregates import distinct_counts

    values = {"buyers": F.col("mst_buyer"), "payments": F.col("payment_method"), "days": F.col("report_date")}
    return distinct_counts(inputs.typed(spark, sf_dir), ["mst_seller"], values)


RUNS = [dt.date(1997, 11, 1), dt.date(1997, 12, 15), dt.date(1998, 1, 1)]


def _backfill_sql() -> str:
    parts = []
    for run in RUNS:
        last = dates.last_closed_day(run)
        starts = dates.trailing_starts(last)
        sums = ", ".join(
            f"sum(CASE WHEN report_date >= DATE '{s}' THEN daily_total_sales END) AS daily_total_sales_sum_{n}"
            for n, s in starts.items()
        )
        parts.append(
            f"""SELECT DATE '{last}' AS report_date, mst_seller, {sums} FROM daily
                WHERE daily.report_date BETWEEN DATE '{starts['l12m']}' AND DATE '{last}' GROUP BY mst_seller"""
        )
    return q.with_ctes("daily", " UNION ALL ".join(parts))


@query("backfill_months", _backfill_sql())
def backfill_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    last_days = [dates.last_closed_day(d) for d in RUNS]
    framed = dates.trailing_frame(inputs.daily(spark, sf_dir), "report_date", last_days)
    packed = trailing.pack(framed, seller_features.KEYS, trailing.statistics({"daily_total_sales": ["sum"]}), "w")
    return packed.selectExpr(
        "as_of AS report_date", "mst_seller", *trailing.unpack("w", ["daily_total_sales_sum"])
    )


@query(
    "sort_output",
    """SELECT CAST(o_custkey AS VARCHAR) AS buyer, count(*) AS orders FROM orders GROUP BY ALL ORDER BY orders DESC, buyer""",
)
def sort_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star_tables.read(spark, sf_dir, "orders")
    counts = orders.groupBy(F.col("o_custkey").cast("string").alias("buyer")).agg(F.count(F.lit(1)).alias("orders"))
    return counts.orderBy(F.desc("orders"), "buyer")


@query(
    "union_by_name",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS name FROM customer
       UNION ALL SELECT CAST(s_suppkey AS VARCHAR), NULL, s_name FROM supplier""",
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = star_tables.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = star_tables.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    "view_temp",
    "SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY ALL",
)
def view_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    star_tables.read(spark, sf_dir, "supplier").createOrReplaceTempView("ledger_suppliers")
    return spark.sql("SELECT s_nationkey, count(*) AS suppliers FROM ledger_suppliers GROUP BY ALL")


@query(
    "exists_check",
    """SELECT 'P' AS status, EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P') AS found
       UNION ALL SELECT 'none', EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'none')""",
)
def exists_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star_tables.read(spark, sf_dir, "orders")

    def any_row(status: str) -> DataFrame:
        first = orders.filter(F.col("o_orderstatus") == status).limit(1)
        return first.agg((F.count(F.lit(1)) > 0).alias("found")).select(F.lit(status).alias("status"), "found")

    return any_row("P").unionByName(any_row("none"))
