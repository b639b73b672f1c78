"""SQL readings of the mapped inputs and grains, as named common table expressions.

They restate the definitions independently of the DataFrame code, so a mistake in
one shows up as a difference.
"""

from __future__ import annotations

from ledgerlens.checks.registry import snap_sql

RUN_DATE = "1998-01-01"
LAST_DAY = "1997-12-31"
PERIODS = {"l1m": "1997-12-01", "l3m": "1997-10-01", "l6m": "1997-07-01", "l12m": "1997-01-01"}

_GROSS = "(floor(l_extendedprice / 100) * 100)"
_DISC = f"round({_GROSS} * l_discount)"
_TAX = f"round({_GROSS} * l_tax)"

CTE: dict[str, str] = {
    "inv": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS invoice_id,
               o_orderdate AS record_ts, CASE WHEN l_linenumber = 7 THEN '0' ELSE '1' END AS status,
               CASE WHEN l_partkey % 19 = 0 THEN '5' WHEN l_returnflag = 'N' THEN '1'
                    WHEN l_returnflag = 'A' THEN '9' ELSE '3' END AS adjust_type,
               ' ' || l_suppkey || ' ' AS seller,
               CASE WHEN l_partkey % 13 <> 0 THEN l_shipdate + to_hours(l_partkey % 24) END AS issue_ts,
               CASE WHEN o_custkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS buyer,
               l_linestatus AS transport, o_orderstatus || '-' || (o_custkey % 7) AS buyer_address,
               {_TAX} AS tax, CASE WHEN l_partkey % 23 <> 0 THEN {_DISC} END AS discount,
               {_DISC} * 2 AS settlement_discount,
               {_GROSS} - {_DISC} AS with_vat,
               {_GROSS} - {_DISC} - {_TAX} AS without_vat,
               CASE WHEN l_partkey % 29 <> 0 THEN o_orderpriority END AS payment,
               '[{{"sku": ' || l_partkey || '}}]' AS items,
               strftime(l_shipdate + to_hours(l_partkey % 24), '%Y%m') AS partition_month,
               CASE WHEN l_partkey % 211 <> 0 THEN l_shipdate + to_hours(l_partkey % 24) END AS signed_ts,
               CASE WHEN l_partkey % 17 = 0 THEN 'PENDING' WHEN l_partkey % 17 = 1 THEN 'CODE_APPROVED'
                    ELSE 'TAX_CODE_APPROVED_1' END AS error_code,
               {_GROSS} - {_DISC} - {_TAX} AS sale,
               CASE WHEN l_partkey % 19 <> 0 AND l_returnflag = 'A'
                    THEN {_GROSS} - {_DISC} - {_TAX} END AS adjusted_with_vat,
               CASE WHEN l_partkey % 19 <> 0 AND l_returnflag NOT IN ('N', 'A') THEN {_TAX} END AS adjusted_without_vat
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "oinv": """
        SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id, o_orderdate AS record_ts,
               CASE WHEN o_orderkey % 10 = 9 THEN '2' ELSE '1' END AS status,
               CASE o_orderkey % 5 WHEN 0 THEN '9' WHEN 1 THEN '3' ELSE '1' END AS adjust_type,
               CASE o_orderkey % 5 WHEN 0 THEN '2' WHEN 1 THEN '3' ELSE '1' END AS adjust_status,
               CAST(o_orderkey % 100 AS VARCHAR) AS seller,
               CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate + to_hours(o_orderkey % 24) END AS issue_ts,
               CASE WHEN o_custkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS buyer,
               o_orderstatus AS transport, o_orderstatus || '/' || (o_orderkey % 3) AS buyer_address,
               CAST(o_custkey % 50 AS VARCHAR) AS buyer_name,
               CASE WHEN o_orderkey % 4 <> 0 THEN floor(o_totalprice) END AS with_vat_foreign,
               floor(o_totalprice / 1000) AS discount,
               floor(o_totalprice / 500) AS settlement_discount,
               floor(o_totalprice) AS with_vat, floor(o_totalprice) AS without_vat,
               CAST(o_orderkey - 1 AS VARCHAR) AS original_invoice, o_orderpriority AS payment,
               '[' || (o_orderkey % 40) || ']' AS items, CAST(o_orderkey // 100 AS VARCHAR) AS partition_month
        FROM orders""",
    "typed": """
        SELECT trim(seller) AS mst_seller, trim(buyer) AS mst_buyer, CAST(signed_ts AS DATE) AS report_date,
               hour(signed_ts) AS hr, sale AS total_sales, tax AS tax_amt, discount AS discount_amt, with_vat,
               without_vat, payment, transport, coalesce(adjusted_with_vat, adjusted_without_vat) AS adjusted,
               CAST(status AS INT) = 1 AND error_code LIKE '%_CODE_APPROVED%'
                   AND adjust_type IN ('1', '3', '7', '9') AS counts,
               round(CAST(tax AS DOUBLE) / CAST(sale + discount + tax AS DOUBLE) * 100, 2) AS pct
        FROM inv WHERE trim(seller) IS NOT NULL AND signed_ts IS NOT NULL""",
    "banded": """
        SELECT *, CASE WHEN pct = 10 THEN '10' WHEN pct = 8 THEN '8' WHEN pct = 5 THEN '5' WHEN pct = 0 THEN '0'
                       ELSE 'Others' END AS band
        FROM typed""",
    "partner": """
        SELECT mst_seller, mst_buyer, CAST(date_trunc('month', report_date) AS DATE) AS month_start,
               sum(total_sales) AS buyer_monthly_sales, count(*) AS buyer_monthly_invoice_count
        FROM typed WHERE mst_buyer IS NOT NULL GROUP BY ALL""",
}

BANDS = ("10", "8", "5", "0", "Others")


def _ratio(top: str, bottom: str, otherwise: str = "CAST(0 AS DOUBLE)") -> str:
    return f"CASE WHEN {bottom} > 0 THEN CAST({top} AS DOUBLE) / CAST({bottom} AS DOUBLE) ELSE {otherwise} END"


def _daily_sql() -> str:
    count_band = ", ".join(
        f"count(*) FILTER (WHERE band = '{b}') AS daily_invoice_count_tax{b}" for b in BANDS
    )
    sales_band = ", ".join(
        f"sum(CASE WHEN band = '{b}' THEN total_sales ELSE 0 END) AS daily_total_sales_tax{b}" for b in BANDS
    )
    return f"""
        SELECT *, {_ratio('daily_night_invoice_count', 'daily_invoice_count')} AS daily_night_ratio,
               {_ratio('daily_core_invoice_count', 'daily_invoice_count')} AS daily_core_ratio,
               {_ratio('coalesce(daily_total_discount, 0)', 'daily_total_sales')} AS daily_discount_ratio,
               {_ratio('daily_total_sales', 'daily_buyer_count')} AS daily_sales_per_buyer,
               {_ratio('daily_total_sales', 'daily_invoice_count')} AS daily_sales_per_invoice
        FROM (SELECT mst_seller, report_date, sum(total_sales) AS daily_total_sales, count(*) AS daily_invoice_count,
                     count(DISTINCT mst_buyer) AS daily_buyer_count, sum(tax_amt) AS daily_total_tax,
                     sum(discount_amt) AS daily_total_discount, sum(without_vat) AS daily_total_without_vat,
                     sum(with_vat) AS daily_total_with_vat,
                     count(*) FILTER (WHERE hr >= 22 OR hr < 6) AS daily_night_invoice_count,
                     count(*) FILTER (WHERE hr < 4) AS daily_core_invoice_count,
                     count(DISTINCT payment) AS daily_distinct_payment_methods,
                     count(DISTINCT transport) AS daily_distinct_transport,
                     max(total_sales) AS daily_max_invoice_value, min(total_sales) AS daily_min_invoice_value,
                     CAST(sum(total_sales) AS DOUBLE) / count(total_sales) AS daily_avg_invoice_value,
                     stddev_samp(CAST(total_sales AS DOUBLE)) AS daily_std_invoice_value,
                     count(adjusted) AS daily_invoice_adjusted_count,
                     sum(coalesce(adjusted, 0)) AS daily_invoice_adjusted_amount, {count_band}, {sales_band}
              FROM banded WHERE counts GROUP BY mst_seller, report_date)"""


CTE["daily"] = _daily_sql()
CTE["recent"] = f"SELECT * FROM daily WHERE report_date BETWEEN DATE '{PERIODS['l12m']}' AND DATE '{LAST_DAY}'"

SUM_UP = {
    "monthly_total_sales": "daily_total_sales",
    "monthly_invoice_count": "daily_invoice_count",
    "monthly_buyer_count": "daily_buyer_count",
    "monthly_total_night_invoices_count": "daily_night_invoice_count",
    "monthly_total_core_invoices_count": "daily_core_invoice_count",
    "monthly_total_invoice_adjusted_count": "daily_invoice_adjusted_count",
    "monthly_total_invoice_adjusted_amount": "daily_invoice_adjusted_amount",
    "monthly_total_tax": "daily_total_tax",
} | {f"monthly_{m}_tax{b}": f"daily_{m}_tax{b}" for m in ("invoice_count", "total_sales") for b in BANDS}
AVERAGE = {
    "monthly_avg_daily_sales": "daily_total_sales",
    "monthly_avg_daily_invoices": "daily_invoice_count",
    "monthly_avg_daily_buyers": "daily_buyer_count",
    "avg_invoices_per_day": "daily_invoice_count",
    "avg_night_ratio": "daily_night_ratio",
    "avg_core_ratio": "daily_core_ratio",
    "avg_night_invoice_count": "daily_night_invoice_count",
    "avg_core_invoice_count": "daily_core_invoice_count",
}


def mean_sql(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)"


def _monthly_sql(source: str) -> str:
    parts = [f"sum({c}) AS {n}" for n, c in SUM_UP.items()]
    parts += [f"{mean_sql(c)} AS {n}" for n, c in AVERAGE.items()]
    parts += [f"sum(daily_total_sales) FILTER (WHERE rk <= {k}) AS top{k}_days_by_month_sales" for k in (5, 10)]
    shares = ", ".join(
        f"{_ratio(f'top{k}_days_by_month_sales', 'monthly_total_sales')} AS top{k}_days_by_month_concentration"
        for k in (5, 10)
    )
    return f"""
        SELECT *, {shares} FROM (
          SELECT mst_seller, month_end AS report_date, count(DISTINCT report_date) AS active_days, {', '.join(parts)}
          FROM (SELECT *, last_day(report_date) AS month_end,
                       row_number() OVER (PARTITION BY mst_seller, last_day(report_date)
                                          ORDER BY daily_total_sales DESC, report_date) AS rk
                FROM {source}) GROUP BY mst_seller, month_end)"""


CTE["monthly"] = _monthly_sql("recent")
CTE["monthly_all"] = _monthly_sql("daily")


def _change_sql(source: str) -> str:
    def change(metric: str, last: str) -> str:
        return _ratio(f"({metric} - {last}) * 100", last, "NULL")

    return f"""
        SELECT *, {change('monthly_total_sales', 'monthly_total_sales_last_mth')} AS sales_amt_perc_change,
               {change('monthly_invoice_count', 'monthly_invoice_count_last_mth')} AS invoice_cnt_perc_change_self
        FROM (SELECT *, lag(monthly_total_sales) OVER w AS monthly_total_sales_last_mth,
                     lag(monthly_invoice_count) OVER w AS monthly_invoice_count_last_mth,
                     datediff('month', lag(report_date) OVER w, report_date) AS months_gap
              FROM {source} WINDOW w AS (PARTITION BY mst_seller ORDER BY report_date))"""


CTE["change"] = _change_sql("monthly")
CTE["change_all"] = _change_sql("monthly_all")

CTE["extremes"] = f"""
        SELECT t.mst_seller, t.report_date, monthly_total_discount_buyer_taxcode, monthly_distinct_buyer_count,
               monthly_total_sales_buyer_taxcode, inv_cnt_freq_buyer_taxcode, sales_amt_most_freq_buyer_taxcode,
               CAST(sales_amt_most_freq_buyer_taxcode AS DOUBLE) / inv_cnt_freq_buyer_taxcode
                   AS sales_amt_most_freq_buyer_taxcode_per_trans,
               disc_amt_most_freq_buyer_taxcode, inv_cnt_least_freq_buyer_taxcode, sales_amt_least_freq_buyer_taxcode,
               CAST(sales_amt_least_freq_buyer_taxcode AS DOUBLE) / inv_cnt_least_freq_buyer_taxcode
                   AS sales_amt_least_freq_buyer_taxcode_per_trans,
               monthly_sales_amt, sales_amt_top1_big_buyer_taxcode, sales_amt_top2_big_buyer_taxcode,
               sales_amt_top3_big_buyer_taxcode,
               {_ratio('sales_amt_top3_big_buyer_taxcode', 'monthly_sales_amt', 'NULL')}
                   AS sales_amt_top3_big_buyer_taxcode_vs_sales_amt
        FROM (SELECT mst_seller, last_day(report_date) AS report_date,
                     sum(discount_amt) AS monthly_total_discount_buyer_taxcode,
                     count(DISTINCT mst_buyer) AS monthly_distinct_buyer_count,
                     sum(total_sales) AS monthly_total_sales_buyer_taxcode
              FROM typed WHERE mst_buyer IS NOT NULL GROUP BY ALL) t
        LEFT JOIN (
          SELECT mst_seller, report_date, sum(s) AS monthly_sales_amt,
                 sum(s) FILTER (WHERE r_sales <= 1) AS sales_amt_top1_big_buyer_taxcode,
                 sum(s) FILTER (WHERE r_sales <= 2) AS sales_amt_top2_big_buyer_taxcode,
                 sum(s) FILTER (WHERE r_sales <= 3) AS sales_amt_top3_big_buyer_taxcode,
                 max(c) FILTER (WHERE r_most = 1) AS inv_cnt_freq_buyer_taxcode,
                 max(s) FILTER (WHERE r_most = 1) AS sales_amt_most_freq_buyer_taxcode,
                 max(d) FILTER (WHERE r_most = 1) AS disc_amt_most_freq_buyer_taxcode,
                 max(c) FILTER (WHERE r_least = 1) AS inv_cnt_least_freq_buyer_taxcode,
                 max(s) FILTER (WHERE r_least = 1) AS sales_amt_least_freq_buyer_taxcode
          FROM (SELECT *, row_number() OVER (PARTITION BY mst_seller, report_date ORDER BY c DESC, mst_buyer) AS r_most,
                       row_number() OVER (PARTITION BY mst_seller, report_date ORDER BY c, mst_buyer) AS r_least,
                       row_number() OVER (PARTITION BY mst_seller, report_date ORDER BY s DESC, mst_buyer) AS r_sales
                FROM (SELECT mst_seller, last_day(report_date) AS report_date, mst_buyer, count(total_sales) AS c,
                             sum(total_sales) AS s, sum(discount_amt) AS d
                      FROM typed WHERE mst_buyer IS NOT NULL AND total_sales > 0 GROUP BY ALL))
          GROUP BY mst_seller, report_date) b
        ON t.mst_seller = b.mst_seller AND t.report_date = b.report_date"""

CTE["highest"] = """
        SELECT mst_seller, last_day(report_date) AS report_date, max(total_sales) AS monthly_sales_amt_highest_inv
        FROM typed WHERE total_sales > 0 GROUP BY ALL"""


def _gap_sql(where: str, name: str) -> str:
    return f"""
        SELECT mst_seller, last_day(report_date) AS report_date, sum(gap) AS {name}
        FROM (SELECT mst_seller, report_date, datediff('day', lag(report_date) OVER
                     (PARTITION BY mst_seller ORDER BY report_date), report_date) AS gap
              FROM (SELECT DISTINCT mst_seller, report_date FROM typed WHERE {where})) GROUP BY ALL"""


CTE["gaps"] = _gap_sql("true", "day_cnt_no_sales")
CTE["named_gaps"] = _gap_sql("mst_buyer IS NOT NULL", "day_cnt_no_sales_per_cus_taxcode")
CTE["raw_months"] = f"""
        SELECT *, {_ratio('monthly_total_sales_buyer_taxcode', 'monthly_distinct_buyer_count', 'NULL')}
                      AS "Sales_amt_per_buyer_taxcode",
               lag(report_date) OVER w AS prev_report_date,
               CAST(datediff('month', lag(report_date) OVER w, report_date) AS DOUBLE) AS mth_cnt_no_rev
        FROM extremes LEFT JOIN highest USING (mst_seller, report_date) LEFT JOIN gaps USING (mst_seller, report_date)
        LEFT JOIN named_gaps USING (mst_seller, report_date)
        WINDOW w AS (PARTITION BY mst_seller ORDER BY report_date)"""

CTE["concentration"] = f"""
        SELECT *, {_ratio('top3_buyer_sales_l12m', 'seller_total_sales_l12m')} AS top3_buyer_concentration_l12m,
               {_ratio('top5_buyer_sales_l12m', 'seller_total_sales_l12m')} AS top5_buyer_concentration_l12m
        FROM (SELECT mst_seller, sum(s) AS seller_total_sales_l12m, count(*) AS distinct_buyers_l12m,
                     sum(s) FILTER (WHERE rk <= 3) AS top3_buyer_sales_l12m,
                     sum(s) FILTER (WHERE rk <= 5) AS top5_buyer_sales_l12m
              FROM (SELECT *, row_number() OVER (PARTITION BY mst_seller ORDER BY s DESC, mst_buyer) AS rk
                    FROM (SELECT mst_seller, mst_buyer, sum(buyer_monthly_sales) AS s FROM partner
                          WHERE month_start BETWEEN DATE '{PERIODS['l12m']}' AND DATE '{LAST_DAY}' GROUP BY ALL))
              GROUP BY mst_seller)"""

NEEDS = {
    "typed": ["inv"],
    "banded": ["typed"],
    "partner": ["typed"],
    "daily": ["banded"],
    "recent": ["daily"],
    "monthly": ["recent"],
    "monthly_all": ["daily"],
    "change": ["monthly"],
    "change_all": ["monthly_all"],
    "extremes": ["typed"],
    "highest": ["typed"],
    "gaps": ["typed"],
    "named_gaps": ["typed"],
    "raw_months": ["extremes", "highest", "gaps", "named_gaps"],
    "concentration": ["partner"],
}


def with_ctes(names: str | list[str], body: str) -> str:
    """Prefix a statement with the expressions it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS.get(name, []):
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in [names] if isinstance(names, str) else names:
        visit(name)
    ctes = ", ".join(f"{n} AS ({CTE[n]})" for n in ordered)
    return f"WITH {ctes} {body}"


def skew_sql(x: str) -> str:
    """Population skewness, null for fewer than one distinct deviation."""
    x = f"CAST({x} AS DOUBLE)"
    n, m = f"count({x})", f"avg({x})"
    m2 = f"var_pop({x})"
    m3 = f"(avg({x} * {x} * {x}) - 3 * {m} * avg({x} * {x}) + 2 * {m} * {m} * {m})"
    return f"CASE WHEN {n} > 0 AND {m2} > 1e-9 THEN {m3} / power({m2}, 1.5) END"


def aggregate_sql(function: str, x: str) -> str:
    """One feature aggregate over an already conditional value."""
    d = f"CAST({x} AS DOUBLE)"
    return {
        "sum": f"sum({x})",
        "avg": mean_sql(x),
        "min": f"min({x})",
        "max": f"max({x})",
        "std": f"stddev_samp({d})",
        "count": f"count({x})",
        "countDistinct": f"count(DISTINCT {x})",
        "med": f"quantile_disc({d}, 0.5)",
        "pct25": f"quantile_disc({d}, 0.25)",
        "pct75": f"quantile_disc({d}, 0.75)",
        "skew": skew_sql(x),
        "kurt": f"kurtosis_pop({d})",
    }[function]


def windows_sql(
    columns: list[str], functions: list[str], periods: dict[str, str] = PERIODS, digits: int | None = 4
) -> str:
    """Select-list of every column, function and window."""
    out = []
    for column in columns:
        for function in functions:
            for name, start in periods.items():
                value = f"CASE WHEN report_date >= DATE '{start}' THEN {column} END"
                e = aggregate_sql(function, value)
                if function not in ("count", "countDistinct") and digits is not None:
                    e = snap_sql(e, digits)
                out.append(f'{e} AS "{column}_{function}_{name}"')
    return ", ".join(out)
