"""Feature-table queries: the seller table, its parts, and the balance table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.checks import base_sql as q
from ledgerlens.checks import inputs
from ledgerlens.checks.registry import query, snap_sql, snap_text
from ledgerlens.plans import seller_features
from ledgerlens.sources import star_tables

ALL_FIVE = ["sum", "avg", "min", "max", "std"]
SALES = [
    "daily_total_sales",
    "daily_invoice_count",
    "daily_buyer_count",
    "daily_sales_per_buyer",
    "daily_sales_per_invoice",
    "daily_invoice_adjusted_count",
    "daily_invoice_adjusted_amount",
]
CHANGES = ["sales_amt_perc_change", "invoice_cnt_perc_change_self"]
TOPS = [f"top{k}_days_by_month_{m}" for k in (5, 10) for m in ("sales", "concentration")]
MONTH_METRICS = [*q.SUM_UP, *q.AVERAGE, "active_days", *TOPS, *CHANGES]
GAPPED = """(SELECT *, datediff('day', lag(report_date) OVER (PARTITION BY mst_seller ORDER BY report_date),
                          report_date) AS days_gap,
             row_number() OVER (PARTITION BY mst_seller ORDER BY daily_total_sales DESC, report_date) AS day_rank
             FROM recent)"""

DIRECT_LIST = ", ".join(
    [
        q.windows_sql(SALES, ALL_FIVE),
        q.windows_sql(["daily_night_ratio", "daily_core_ratio"], ["avg", "max", "std"]),
        q.windows_sql(["daily_discount_ratio", "daily_total_discount"], ["sum", "avg", "max"]),
        q.windows_sql(
            ["daily_avg_invoice_value", "daily_max_invoice_value"], ["avg", "max", "min", "std", "skew", "med"]
        ),
        q.windows_sql(["days_gap"], ["avg", "max", "min", "std"]),
        q.windows_sql(["daily_distinct_payment_methods", "daily_distinct_transport"], ["avg", "max"]),
        *[
            f"count(DISTINCT CASE WHEN report_date >= DATE '{s}' THEN report_date END) AS active_days_{n}"
            for n, s in q.PERIODS.items()
        ],
        *[
            f"{snap_sql(f'sum(daily_total_sales) FILTER (WHERE day_rank <= {k})', 4)} AS top{k}_days_sales_l12m"
            for k in (5, 10)
        ],
    ]
)
DIRECT_SQL = f"SELECT mst_seller, {DIRECT_LIST} FROM {GAPPED} GROUP BY mst_seller"
MONTHLY_SQL = f"""SELECT mst_seller, {q.windows_sql(MONTH_METRICS, ALL_FIVE)},
                         {q.windows_sql(['months_gap'], ['sum'])} FROM change GROUP BY mst_seller"""

RAW_FLOATS = {
    "sales_amt_most_freq_buyer_taxcode_per_trans",
    "sales_amt_least_freq_buyer_taxcode_per_trans",
    "sales_amt_top3_big_buyer_taxcode_vs_sales_amt",
    "Sales_amt_per_buyer_taxcode",
}
RAW_COLUMNS = [
    "monthly_total_discount_buyer_taxcode",
    "monthly_distinct_buyer_count",
    "monthly_total_sales_buyer_taxcode",
    "monthly_sales_amt_highest_inv",
    "inv_cnt_freq_buyer_taxcode",
    "sales_amt_most_freq_buyer_taxcode",
    "sales_amt_most_freq_buyer_taxcode_per_trans",
    "disc_amt_most_freq_buyer_taxcode",
    "inv_cnt_least_freq_buyer_taxcode",
    "sales_amt_least_freq_buyer_taxcode",
    "sales_amt_least_freq_buyer_taxcode_per_trans",
    "monthly_sales_amt",
    "sales_amt_top1_big_buyer_taxcode",
    "sales_amt_top2_big_buyer_taxcode",
    "sales_amt_top3_big_buyer_taxcode",
    "sales_amt_top3_big_buyer_taxcode_vs_sales_amt",
    "day_cnt_no_sales",
    "day_cnt_no_sales_per_cus_taxcode",
    "Sales_amt_per_buyer_taxcode",
    "prev_report_date",
    "mth_cnt_no_rev",
]
RAW_COUNTS = {
    "monthly_distinct_buyer_count",
    "inv_cnt_freq_buyer_taxcode",
    "inv_cnt_least_freq_buyer_taxcode",
    "day_cnt_no_sales",
    "day_cnt_no_sales_per_cus_taxcode",
}
CONCENTRATION = [f"top{k}_buyer_{m}" for k in (3, 5) for m in ("sales_l12m", "concentration_l12m")]


def typed_list(columns: list[str], counts: set[str] = frozenset(), prefix: str = "", snapped: int | None = 4) -> str:
    """Select list in the types :func:`registry.plain` gives."""
    out = []
    for c in columns:
        name = f'{prefix}"{c}"'
        if c == "prev_report_date":
            e = name
        elif c in counts:
            e = f"CAST({name} AS BIGINT)"
        else:
            e = f"CAST({name} AS DOUBLE)" if snapped is None else snap_sql(name, snapped)
        out.append(f'{e} AS "{c}"')
    return ", ".join(out)


def uniform(df: DataFrame, digits: int = 4) -> DataFrame:
    """Every numeric feature as a snapped double, plain counts as long."""
    columns = []
    for name, kind in df.dtypes:
        e = f"`{name}`"
        if name.startswith("active_days_l") or name in RAW_COUNTS or name == "distinct_buyers_l12m":
            e = f"CAST({e} AS BIGINT)"
        elif kind not in ("string", "date", "boolean"):
            e = snap_text(e, digits)
        columns.append(f"{e} AS `{name}`")
    return df.selectExpr(*columns)


TOP_DAYS = ", ".join(
    f"""{snap_sql(f'''CASE WHEN seller_total_sales_l12m > 0 THEN CAST(t.top{k} AS DOUBLE)
        / CAST(seller_total_sales_l12m AS DOUBLE) ELSE 0 END''', 4)} AS top{k}_days_concentration_l12m"""
    for k in (5, 10)
)
TOP_DAY_TOTALS = f"""SELECT mst_seller, sum(daily_total_sales) FILTER (WHERE day_rank <= 5) AS top5,
                            sum(daily_total_sales) FILTER (WHERE day_rank <= 10) AS top10
                     FROM {GAPPED} GROUP BY mst_seller"""


@query(
    "seller_features",
    q.with_ctes(
        ["recent", "change", "concentration", "raw_months"],
        f"""SELECT DATE '{q.LAST_DAY}' AS report_date, d.*, m.* EXCLUDE (mst_seller),
                   {typed_list(['seller_total_sales_l12m', 'distinct_buyers_l12m', *CONCENTRATION],
                               {'distinct_buyers_l12m'}, 'c.')},
                   {TOP_DAYS}, {typed_list(RAW_COLUMNS, RAW_COUNTS, 'r.')}
            FROM ({DIRECT_SQL}) d LEFT JOIN ({MONTHLY_SQL}) m USING (mst_seller)
            LEFT JOIN concentration c ON c.mst_seller = d.mst_seller
            LEFT JOIN ({TOP_DAY_TOTALS}) t ON t.mst_seller = d.mst_seller
            LEFT JOIN (SELECT * FROM raw_months WHERE report_date = DATE '{q.LAST_DAY}') r
                   ON r.mst_seller = d.mst_seller""",
    ),
)
def seller_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniform(seller_features.from_invoices(star_tables.invoices(spark, sf_dir), [inputs.RUN_DATE]))
