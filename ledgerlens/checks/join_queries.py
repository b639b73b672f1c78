"""Join-shaped queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.checks import base_sql as q
from ledgerlens.checks import inputs
from ledgerlens.checks.registry import plain, query, snap, snap_sql
from ledgerlens.checks.row_queries import TRADES, recent_trades
from ledgerlens.functions import dates
from ledgerlens.operators import joins, windows
from ledgerlens.plans import balances, grains, related
from ledgerlens.sources import invoices as inv
from ledgerlens.sources import star_tables
from ledgerlens.sources.store import materialize

ADJUSTED = """adjusted AS (
    SELECT i.*, CASE CAST(i.{code} AS INT)
                  WHEN {money} THEN coalesce(i.with_vat_foreign, 0) + coalesce(o.with_vat_foreign, 0)
                  WHEN {replaced} THEN coalesce(o.with_vat_foreign, 0) ELSE coalesce(i.with_vat_foreign, 0) END AS worth
    FROM oinv i LEFT JOIN oinv o ON i.original_invoice = o.invoice_id AND i.partition_month = o.partition_month
         {extra})"""


def adjusted_cte(code: str = "adjust_type", money: int = 9, replaced: int = 3, issued: bool = False) -> str:
    extra = "AND o.status = '1'" if issued else ""
    return "WITH oinv AS (" + q.CTE["oinv"] + "), " + ADJUSTED.format(
        code=code, money=money, replaced=replaced, extra=extra
    )


@query(
    "join_adjusted_sales",
    adjusted_cte() + " SELECT invoice_id, adjust_type, CAST(worth AS DOUBLE) AS adjusted_sale FROM adjusted",
)
def join_adjusted_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_tables.order_invoices(spark, sf_dir)
    return joins.adjusted_amount(rows, rows).select("invoice_id", "adjust_type", "adjusted_sale")


@query(
    "join_feature_left",
    q.with_ctes(
        ["recent", "concentration"],
        """SELECT s.mst_seller, s.sales, CAST(n.nights AS BIGINT) AS nights, CAST(c.seller_total_sales_l12m AS DOUBLE)
                  AS seller_total_sales_l12m
           FROM (SELECT mst_seller, sum(daily_total_sales) AS sales FROM recent GROUP BY ALL) s
           LEFT JOIN (SELECT mst_seller, sum(daily_night_invoice_count) AS nights FROM recent GROUP BY ALL) n
                USING (mst_seller) LEFT JOIN concentration c ON c.mst_seller = s.mst_seller""",
    ),
)
def join_feature_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.plans.seller_features import buyer_concentration

    groups = {
        "sales": [F.sum("daily_total_sales").alias("sales")],
        "night": [F.sum("daily_night_invoice_count").alias("nights")],
    }
    folded = joins.fold_groups(inputs.recent_daily(spark, sf_dir), ["mst_seller"], groups)
    pairs = dates.trailing_frame(inputs.partners(spark, sf_dir), "month_start", [inputs.LAST_DAY])
    totals = buyer_concentration(pairs, ["mst_seller"]).select("mst_seller", "seller_total_sales_l12m")
    return plain(folded.join(totals, "mst_seller", "left"), snapped=set())


BALANCES = """o AS (SELECT CAST(o_custkey AS VARCHAR) AS cusid, CAST(o_orderdate AS DATE) AS report_date,
                           floor(o_totalprice / 100) AS amount, o_orderkey AS k FROM orders),
    cur AS (SELECT cusid, report_date, sum(amount) AS atxca_bal FROM o WHERE k % 3 = 0 GROUP BY ALL),
    dep AS (SELECT cusid, report_date, sum(amount) AS asvtd_bal FROM o WHERE k % 3 = 1 GROUP BY ALL),
    flows AS (SELECT cusid AS customer_code, report_date AS ds_partition_date,
                     CASE WHEN k % 2 = 0 THEN 'IN' ELSE 'OUT' END AS cash_flow_lv1, amount AS txn_amt
              FROM o WHERE k % 3 <> 1),
    inflow AS (SELECT customer_code AS cusid, ds_partition_date AS report_date,
                      sum(CASE WHEN cash_flow_lv1 = 'IN' THEN txn_amt END) AS trans_in_amt FROM flows GROUP BY ALL),
    bal_all AS (SELECT cusid, report_date, atxca_bal, asvtd_bal, trans_in_amt,
                       coalesce(atxca_bal, 0) + coalesce(asvtd_bal, 0) AS a_bal_catd
                FROM cur FULL JOIN dep USING (cusid, report_date) FULL JOIN inflow USING (cusid, report_date)),
    bal AS (SELECT * FROM bal_all WHERE report_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'),
    bal_month AS (SELECT *, CASE WHEN a_bal_catd_avgmly = 0 THEN 0 ELSE coalesce(trans_in_amt_monthly, 0)
                                 / a_bal_catd_avgmly END AS a_rto_amt_in_vs_catd
                  FROM (SELECT *, coalesce(atxca_bal_avgmly, 0) + coalesce(asvtd_bal_avgmly, 0) AS a_bal_catd_avgmly
                        FROM (SELECT cusid, last_day(report_date) AS report_date,
                                     sum(atxca_bal) / count(atxca_bal) AS atxca_bal_avgmly,
                                     sum(asvtd_bal) / count(asvtd_bal) AS asvtd_bal_avgmly,
                                     sum(trans_in_amt) AS trans_in_amt_monthly FROM bal GROUP BY ALL)))"""


def balance_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balances.balance_daily(*star_tables.balance_sources(spark, sf_dir), inputs.FIRST_DAY, inputs.LAST_DAY)


@query(
    "join_full_outer",
    f"WITH {BALANCES} SELECT cusid, report_date, atxca_bal, asvtd_bal, trans_in_amt FROM bal_all",
)
def join_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, deposits, flows = star_tables.balance_sources(spark, sf_dir)
    return joins.merge_on_key([current, deposits, balances.inflows(flows)], balances.CUSTOMER_DAY)


@query(
    "join_month_flow",
    f"""WITH {BALANCES} SELECT cusid, report_date, atxca_bal_avgmly, asvtd_bal_avgmly, trans_in_amt_monthly,
                               a_bal_catd_avgmly FROM bal_month""",
)
def join_month_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balances.balance_monthly(balance_days(spark, sf_dir)).drop("a_rto_amt_in_vs_catd")


@query(
    "join_feature_inner",
    f"""WITH {BALANCES} SELECT cusid, high, days FROM (SELECT cusid, max(a_bal_catd_avgmly) AS high FROM bal_month
        GROUP BY ALL) JOIN (SELECT cusid, count(*) AS days FROM bal GROUP BY ALL) USING (cusid)""",
)
def join_feature_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = balance_days(spark, sf_dir).repartition("cusid")
    monthly = balances.balance_monthly(days).groupBy("cusid").agg(F.max("a_bal_catd_avgmly").alias("high"))
    return monthly.join(days.groupBy("cusid").agg(F.count(F.lit(1)).alias("days")), "cusid")


@query(
    "join_anti_no_sale_days",
    q.with_ctes("typed", "").rstrip()
    + """, span AS (SELECT mst_seller, min(report_date) AS a, max(report_date) AS z FROM typed GROUP BY ALL)
       SELECT mst_seller, CAST(d AS DATE) AS day
       FROM (SELECT mst_seller, unnest(generate_series(a, z, INTERVAL 1 DAY)) AS d FROM span) s
       WHERE NOT EXISTS (SELECT 1 FROM typed t WHERE t.mst_seller = s.mst_seller AND t.report_date = CAST(s.d AS DATE))""",
)
def join_anti_no_sale_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.typed(spark, sf_dir).select("mst_seller", F.col("report_date").alias("day"))
    return joins.days_without(days, "day", ["mst_seller"])


@query(
    "join_restrict_semi",
    q.with_ctes(
        "typed",
        """SELECT mst_seller, mst_buyer, report_date, total_sales FROM typed WHERE mst_buyer IN (
             SELECT mst_buyer FROM (SELECT mst_buyer, count(*) AS n FROM typed GROUP BY ALL)
             WHERE n = (SELECT max(n) FROM (SELECT mst_buyer, count(*) AS n FROM typed WHERE mst_buyer IS NOT NULL
                        GROUP BY ALL)))""",
    ),
)
def join_restrict_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.typed(spark, sf_dir)
    known = rows.filter(F.col("mst_buyer").isNotNull()).groupBy("mst_buyer").agg(F.count(F.lit(1)).alias("n"))
    busiest = windows.at_extreme(known, "n").select("mst_buyer")
    kept = rows.join(busiest, "mst_buyer", "left_semi")
    return plain(kept.select("mst_seller", "mst_buyer", "report_date", "total_sales"), snapped=set())


CALENDAR = """cal AS (SELECT CAST(d AS DATE) AS date_code, dayofweek(d) IN (0, 6) AS off_date
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)),
    lookup AS (SELECT c.date_code, max(b.date_code) AS latest FROM cal c JOIN cal b
                    ON b.date_code <= c.date_code AND NOT b.off_date AND b.date_code >= DATE '1996-12-01'
             WHERE c.date_code BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY ALL)"""


@query("join_asof_business_day", f"WITH {CALENDAR} SELECT date_code, latest FROM lookup")
def join_asof_business_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balances.business_days(star_tables.calendar(spark, sf_dir), inputs.FIRST_DAY, inputs.LAST_DAY)


@query(
    "win_latest_by_date",
    f"""WITH {CALENDAR} SELECT date_code, (SELECT max(b.date_code) FROM cal b WHERE NOT b.off_date
        AND b.date_code <= c.date_code) AS latest FROM cal c""",
)
def win_latest_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.latest_business_day(star_tables.calendar(spark, sf_dir))


HOLDINGS = """accounts AS (
    SELECT unq_id, latest, sum(net) AS net FROM (
      SELECT l_orderkey AS unq_id, CAST(l_shipdate AS DATE) AS latest,
             floor(l_extendedprice / 100) * 100 * CASE WHEN l_partkey % 7 = 0 THEN -1 ELSE 1 END AS net,
             l_linenumber % 4 AS kind FROM lineitem)
    WHERE kind IN (0, 1, 2) GROUP BY ALL HAVING sum(net) > 0),
    held AS (SELECT l_orderkey AS unq_id, CAST(l_shipdate AS DATE) AS latest, CAST(l_suppkey AS VARCHAR) AS cst
             FROM lineitem WHERE l_linenumber NOT IN (6, 7) AND l_returnflag IN ('N', 'A'))"""


@query(
    "join_asof_balance",
    f"""WITH {CALENDAR}, {HOLDINGS} SELECT cst AS cusid, lookup.date_code AS report_date, count(*) AS accounts
        FROM lookup JOIN held ON lookup.latest = held.latest
        JOIN accounts ON held.unq_id = accounts.unq_id AND held.latest = accounts.latest GROUP BY ALL""",
)
def join_asof_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = star_tables.holdings(spark, sf_dir).filter(
        (F.col("ds_rec_st") == balances.HOLDING_STATUS)
        & (F.col("ar_bsn_line") != balances.EXCLUDED_LINE)
        & F.col("pd_lvl_2_nm").isin(*balances.HOLDING_PRODUCTS)
    ).withColumnRenamed("ds_partition_date", "latest")
    accounts = balances.positive_account_days(star_tables.account_balances(spark, sf_dir))
    days = balances.business_days(star_tables.calendar(spark, sf_dir), inputs.FIRST_DAY, inputs.LAST_DAY)
    per_day = (
        held.join(accounts, ["unq_id_src_stm", "latest"])
        .groupBy(F.col("cst_code").alias("cusid"), "latest")
        .agg(F.count(F.lit(1)).alias("accounts"))
    )
    dated = per_day.join(F.broadcast(days), "latest")  # one row per date of a year
    return dated.select("cusid", F.col("date_code").alias("report_date"), "accounts")


@query(
    "balance_staging",
    f"""WITH {CALENDAR}, {HOLDINGS} SELECT cst AS cusid, lookup.date_code AS report_date,
               {snap_sql('sum(net) * 1e-6', 8)} AS asvcd_bal
        FROM lookup JOIN held ON lookup.latest = held.latest
        JOIN accounts ON held.unq_id = accounts.unq_id AND held.latest = accounts.latest GROUP BY ALL""",
)
def balance_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = balances.balance_staging(
        star_tables.calendar(spark, sf_dir),
        star_tables.holdings(spark, sf_dir),
        star_tables.account_balances(spark, sf_dir),
        inputs.FIRST_DAY,
        inputs.LAST_DAY,
    )
    return staged.withColumn("asvcd_bal", snap(F.col("asvcd_bal"), 8))


@query(
    "agg_having",
    f"WITH {HOLDINGS} SELECT unq_id AS unq_id_src_stm, latest, net AS net_amt_lcy FROM accounts",
)
def agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balances.positive_account_days(star_tables.account_balances(spark, sf_dir))


@query(
    "join_canonical_pair",
    q.with_ctes("inv", "").rstrip()
    + f""", {TRADES} SELECT least(issuer, buyer) AS a, greatest(issuer, buyer) AS b, sum(amount) AS revenue,
          count(*) AS invoices FROM trades GROUP BY ALL""",
)
def join_canonical_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recent_trades(spark, sf_dir)
    return rows.groupBy(*joins.canonical_pair(F.col("issuer"), F.col("buyer"))).agg(
        F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("invoices")
    )


@query(
    "join_recent_months",
    q.with_ctes(
        "typed",
        """SELECT mst_seller, month_start, count(*) AS n
           FROM (SELECT mst_seller, CAST(date_trunc('month', report_date) AS DATE) AS month_start FROM typed)
           WHERE month_start IN (SELECT DISTINCT CAST(date_trunc('month', report_date) AS DATE) AS m FROM typed
                                 ORDER BY m DESC LIMIT 3) GROUP BY ALL""",
    ),
)
def join_recent_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.typed(spark, sf_dir).select("mst_seller", F.trunc("report_date", "month").alias("month_start"))
    return joins.recent_months(rows, "month_start", 3).groupBy("mst_seller", "month_start").agg(
        F.count(F.lit(1)).alias("n")
    )


DENSE = """m AS (SELECT mst_seller, last_day(report_date) AS month_end, sum(total_sales) AS sales FROM typed GROUP BY ALL)"""


def month_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.typed(spark, sf_dir)
    return rows.groupBy("mst_seller", F.last_day("report_date").alias("month_end")).agg(
        F.sum("total_sales").alias("sales")
    )


@query(
    "densify_cross",
    q.with_ctes("typed", "").rstrip()
    + f""", {DENSE} SELECT mst_seller, month_end, coalesce(sales, 0) AS sales FROM (SELECT DISTINCT mst_seller FROM m)
          CROSS JOIN (SELECT DISTINCT month_end FROM m) LEFT JOIN m USING (mst_seller, month_end)""",
)
def densify_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.densify(month_sales(spark, sf_dir), ["mst_seller", "month_end"])


@query(
    "densify_customers",
    q.with_ctes("typed", "").rstrip()
    + f""", {DENSE} SELECT mst_seller, month_end, coalesce(sales, 0) AS sales
          FROM (SELECT CAST(s_suppkey AS VARCHAR) || CASE WHEN s_suppkey % 9 = 0 THEN 'x' ELSE '' END AS mst_seller
                FROM supplier) CROSS JOIN (SELECT DISTINCT month_end FROM m) LEFT JOIN m USING (mst_seller, month_end)""",
)
def densify_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    entities = star_tables.read(spark, sf_dir, "supplier").select(
        F.concat(key.cast("string"), F.when(key % 9 == 0, "x").otherwise("")).alias("mst_seller")
    )
    return joins.densify(month_sales(spark, sf_dir), ["mst_seller", "month_end"], entities=entities)


@query("balance_daily", f"WITH {BALANCES} SELECT * FROM bal")
def balance_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance_days(spark, sf_dir)


@query(
    "agg_cond_inflow",
    f"WITH {BALANCES} SELECT cusid, report_date, trans_in_amt FROM inflow",
)
def agg_cond_inflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balances.inflows(star_tables.balance_sources(spark, sf_dir)[2])


@query(
    "inflow_ratio",
    f"WITH {BALANCES} SELECT cusid, report_date, {snap_sql('a_rto_amt_in_vs_catd')} AS a_rto_amt_in_vs_catd FROM bal_month",
)
def inflow_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = balances.balance_monthly(balance_days(spark, sf_dir))
    return plain(monthly.select("cusid", "report_date", "a_rto_amt_in_vs_catd"), 6)


MONTH_STARTS = {"l1m": 1, "l3m": 3, "l6m": 6, "l12m": 12}


@query(
    "avg_over_nominal_months",
    f"WITH {BALANCES} SELECT cusid, "
    + ", ".join(
        snap_sql(
            f"sum(CASE WHEN report_date >= DATE '{q.PERIODS[p]}' THEN a_bal_catd_avgmly END) / {n}"
        )
        + f" AS a_bal_catd_avgmly_avg_{p}"
        for p, n in MONTH_STARTS.items()
    )
    + " FROM bal_month GROUP BY cusid",
)
def avg_over_nominal_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = dates.since_conditions("report_date", dates.trailing_starts(inputs.LAST_DAY))
    features = balances.monthly_balance_features(balances.balance_monthly(balance_days(spark, sf_dir)), conditions)
    return plain(features.select("cusid", *[f"a_bal_catd_avgmly_avg_{p}" for p in MONTH_STARTS]), 6)


WEEKS = {"l1w": "1997-12-01", "l2w": "1997-11-24"}


def _over(column: str, function: str, period: str, start: str) -> str:
    value = f"CASE WHEN report_date >= DATE '{start}' THEN {column} END"
    exact = {"pct10": 0.1, "pct25": 0.25, "med": 0.5, "pct75": 0.75, "pct90": 0.9}
    if function in exact:
        e = f"quantile_cont({value}, {exact[function]})"
    elif function == "regr_slope":
        x = "CASE WHEN report_date >= DATE '" + start + "' THEN datediff('day', DATE '2020-01-01', report_date) END"
        e = f"CASE WHEN regr_count({value}, {x}) > 1 THEN regr_slope({value}, {x}) END"
    elif function == "kurt":
        e = f"CASE WHEN var_pop({value}) > 1e-9 THEN kurtosis_pop({value}) END"
    else:
        e = q.aggregate_sql(function, value)
    return snap_sql(e, 4) + f" AS {column}_{function}_{period}"


def _balance_sql() -> str:
    monthly, ratio, total = "a_bal_catd_avgmly", "a_rto_amt_in_vs_catd", "a_bal_catd"
    m, d = [], []
    for p, start in q.PERIODS.items():
        value = f"CASE WHEN report_date >= DATE '{start}' THEN {{}} END"
        m += [_over(monthly, f, p, start) for f in ("sum", "max", "std")]
        m.append(f"{snap_sql(f'coalesce(min({value.format(monthly)}), 0)', 4)} AS {monthly}_min_{p}")
        m.append(f"{snap_sql(f'sum({value.format(monthly)}) / {MONTH_STARTS[p]}', 4)} AS {monthly}_avg_{p}")
        m.append(_over(ratio, "sum", p, start))
        m += [f"{snap_sql(f'coalesce({f}({value.format(ratio)}), 0)', 4)} AS {ratio}_{f}_{p}" for f in ("min", "max")]
        m.append(
            f"{snap_sql(f'coalesce(sum({value.format(ratio)}) / {MONTH_STARTS[p]}, 0)', 4)} AS {ratio}_avg_{p}"
        )
        d += [
            _over(total, f, p, start)
            for f in ("std", "pct10", "pct25", "med", "pct75", "pct90", "kurt", "skew", "regr_slope")
        ]
    for p, start in (WEEKS | q.PERIODS).items():
        d += [_over(total, f, p, start) for f in ("avg", "min", "max")]
    return f"""WITH {BALANCES} SELECT DATE '{q.LAST_DAY}' AS report_date, m.*, d.* EXCLUDE (cusid)
               FROM (SELECT cusid, {', '.join(m)} FROM bal_month GROUP BY cusid) m
               JOIN (SELECT cusid, {', '.join(d)} FROM bal GROUP BY cusid) d USING (cusid)"""


@query("balance_features", _balance_sql())
def balance_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(balances.balance_features(*star_tables.balance_sources(spark, sf_dir), inputs.RUN_DATE), 4)


CONTACTS = r"""cards AS (SELECT CAST(c_custkey AS VARCHAR) AS entity,
      '+849' || lpad(CAST(c_custkey // 3 AS VARCHAR), 8, '0') || '; tel 12' AS phone_1,
      '0091' || lpad(CAST(c_custkey // 5 AS VARCHAR), 7, '0')
             || CASE WHEN c_custkey % 3 = 0 THEN '/0281111222' ELSE '' END AS phone_2,
      CASE WHEN c_custkey % 7 <> 0 THEN 'U' || (c_custkey // 4) || '@Example.com, not-an-address;u'
             || (c_custkey // 4) || '@example.com' END AS email_1,
      'id ' || (c_custkey // 6) || '-x, doc.' || (c_custkey // 6) AS rep_id FROM customer),
    digits AS (SELECT entity, unnest(regexp_extract_all(phone_1 || ' ' || phone_2, '\d+')) AS t FROM cards),
    phones AS (SELECT entity, regexp_replace(CASE WHEN t LIKE '84%' AND length(t) >= 11 THEN '0' || t[3:] ELSE t END,
                      '^0+', '0') AS val FROM digits),
    mails AS (SELECT entity, unnest(regexp_split_to_array(lower(email_1), '[\s,;|/]+')) AS val FROM cards),
    docs AS (SELECT entity, regexp_replace(unnest(regexp_split_to_array(upper(rep_id), '[\s,;|/]+')),
                    '[^A-Z0-9]', '', 'g') AS val FROM cards),
    contacts AS (SELECT DISTINCT entity, 'Trùng SĐT' AS rel, val FROM phones WHERE length(val) BETWEEN 9 AND 12
      UNION SELECT DISTINCT entity, 'Trùng email', val FROM mails
            WHERE regexp_full_match(val, '[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}')
      UNION SELECT DISTINCT entity, 'Trùng Số giấy tờ người đại diện', val FROM docs WHERE val <> '')"""


def _contact_kind(kind: str) -> tuple[str, str]:
    return kind, f"WITH {CONTACTS} SELECT entity, val FROM contacts WHERE rel = '{kind}'"


def _of_kind(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return inputs.contacts(spark, sf_dir).filter(F.col("rel") == kind).select("entity", "val")


@query("contacts_phone", _contact_kind("Trùng SĐT")[1])
def contacts_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_kind(spark, sf_dir, "Trùng SĐT")


@query("contacts_email", _contact_kind("Trùng email")[1])
def contacts_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_kind(spark, sf_dir, "Trùng email")


@query("contacts_iddoc", _contact_kind("Trùng Số giấy tờ người đại diện")[1])
def contacts_iddoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_kind(spark, sf_dir, "Trùng Số giấy tờ người đại diện")


# A report of widely shared values starts at so many holders.
WIDELY_SHARED = 41
SIZES = "sizes AS (SELECT rel, val, count(*) AS holders FROM contacts GROUP BY ALL)"


@query(
    "join_entities_on_value",
    f"""WITH {CONTACTS}, {SIZES} SELECT rel, val, x.entity AS a, y.entity AS b, holders
        FROM contacts x JOIN contacts y USING (rel, val) JOIN sizes USING (rel, val) WHERE x.entity < y.entity""",
)
def join_entities_on_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All relations: every pair of holders of every shared value."""
    return related.shared_pairs(inputs.contacts(spark, sf_dir))


@query(
    "related_large_groups",
    f"""WITH {CONTACTS}, {SIZES} SELECT rel, val, entity, holders FROM contacts JOIN sizes USING (rel, val)
        WHERE holders >= {WIDELY_SHARED}""",
)
def related_large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Switchboards and the like: members of the values that very many share."""
    return related.shared_members(inputs.contacts(spark, sf_dir), WIDELY_SHARED)


LINKS = q.with_ctes("inv", "").rstrip() + f""", {TRADES}, {CONTACTS},
    linked AS (SELECT DISTINCT t.issuer, t.buyer, x.rel, x.val FROM (SELECT DISTINCT issuer, buyer FROM trades) t
               JOIN contacts x ON x.entity = t.issuer JOIN contacts y ON y.entity = t.buyer
                    AND y.rel = x.rel AND y.val = x.val),
    told AS (SELECT issuer, buyer, string_agg(rel, ', ' ORDER BY rel) AS relationship,
                    string_agg('{{' || rel || ': ' || vals || '}}', ', ' ORDER BY rel) AS relationship_detail
             FROM (SELECT issuer, buyer, rel, string_agg(val, ', ' ORDER BY val) AS vals FROM linked GROUP BY ALL)
             GROUP BY ALL),
    level AS (SELECT issuer, buyer, sum(coalesce(amount, 0)) AS revenue_12m, count(*) AS invoice_count_12m,
                     relationship, relationship_detail, relationship IS NOT NULL AS is_related
              FROM trades LEFT JOIN told USING (issuer, buyer) GROUP BY ALL)"""


PAIRS = (
    LINKS
    + """, traded AS (SELECT DISTINCT least(issuer, buyer) AS a, greatest(issuer, buyer) AS b FROM trades),
    proof AS (SELECT t.a, t.b, x.rel, x.val FROM traded t JOIN contacts x ON x.entity = t.a
              JOIN contacts y ON y.entity = t.b AND y.rel = x.rel AND y.val = x.val),
    pairs AS (SELECT a, b, string_agg(rel, ', ' ORDER BY rel) AS relationship,
                     string_agg('{' || rel || ': ' || vals || '}', ', ' ORDER BY rel) AS relationship_detail
              FROM (SELECT a, b, rel, string_agg(val, ', ' ORDER BY val) AS vals FROM proof GROUP BY ALL) GROUP BY ALL)"""
)


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return related.trading_relations(recent_trades(spark, sf_dir), inputs.contacts(spark, sf_dir))


@query("pair_generation", PAIRS + " SELECT DISTINCT a, b FROM proof")
def pair_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    traded = related.trading_pairs(recent_trades(spark, sf_dir))
    return related.evidence(traded, inputs.contacts(spark, sf_dir)).select("a", "b").distinct()


@query("related_pairs", PAIRS + " SELECT * FROM pairs")
def related_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relations(spark, sf_dir)


@query("related_detail_text", PAIRS + " SELECT a, b, relationship_detail FROM pairs")
def related_detail_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relations(spark, sf_dir).select("a", "b", "relationship_detail")


def links(spark: SparkSession, sf_dir: str) -> related.RevenueLinks:
    rows = materialize(recent_trades(spark, sf_dir), "trades")
    return related.revenue_links(rows, related.trading_relations(rows, inputs.contacts(spark, sf_dir)))


@query("revenue_links", LINKS + " SELECT * FROM level")
def revenue_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(spark, sf_dir).pairs


@query(
    "revenue_links_monthly",
    LINKS
    + """ SELECT issuer, buyer, CAST(date_trunc('month', ts) AS DATE) AS month_start, sum(coalesce(amount, 0)) AS revenue,
                 count(*) AS invoice_count, relationship, relationship_detail, relationship IS NOT NULL AS is_related
          FROM trades LEFT JOIN told USING (issuer, buyer) GROUP BY ALL""",
)
def revenue_links_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(spark, sf_dir).months


@query(
    "agg_seller_overview",
    LINKS
    + """ SELECT issuer, sum(revenue_12m) AS revenue_12m, CAST(sum(invoice_count_12m) AS BIGINT) AS invoice_count_12m,
                 sum(CASE WHEN is_related THEN revenue_12m ELSE 0 END) AS revenue_to_related_12m,
                 sum(CASE WHEN NOT is_related THEN revenue_12m ELSE 0 END) AS revenue_to_unrelated_12m,
                 count(DISTINCT buyer) AS n_counterparties,
                 count(*) FILTER (WHERE is_related) AS n_related_counterparties FROM level GROUP BY ALL""",
)
def agg_seller_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(spark, sf_dir).sellers


@query(
    "agg_pair_revenue",
    q.with_ctes("inv", "").rstrip()
    + f""", {TRADES} SELECT issuer, buyer, sum(amount) AS revenue_12m, count(*) AS invoice_count_12m
          FROM trades GROUP BY ALL""",
)
def agg_pair_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recent_trades(spark, sf_dir)
    return rows.groupBy("issuer", "buyer").agg(
        F.sum("amount").alias("revenue_12m"), F.count(F.lit(1)).alias("invoice_count_12m")
    )


def _adjusted_daily_sql(issued: bool) -> str:
    return (
        adjusted_cte(issued=issued)
        + """ SELECT seller AS mst_seller, CAST(coalesce(issue_ts, record_ts) AS DATE) AS report_date,
                     sum(worth) AS daily_total_sales, count(*) AS daily_invoice_count,
                     count(DISTINCT buyer) AS daily_buyer_count
              FROM adjusted WHERE status = '1' GROUP BY ALL"""
    )


def _adjusted_daily(spark: SparkSession, sf_dir: str, policy: inv.InvoicePolicy) -> DataFrame:
    grain = grains.day_grain(inv.analysis_rows(star_tables.order_invoices(spark, sf_dir), policy))
    return grains.daily_sellers(grain).select(
        "mst_seller", "report_date", "daily_total_sales", "daily_invoice_count", "daily_buyer_count"
    )


@query("join_adjusted_daily", _adjusted_daily_sql(True))
def join_adjusted_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first generation's daily table: adjusted amounts on issue dates."""
    return _adjusted_daily(spark, sf_dir, inv.FIRST)


@query("join_adjusted_daily_sql", _adjusted_daily_sql(False))
def join_adjusted_daily_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the SQL reading, where an original need not be issued."""
    return _adjusted_daily(spark, sf_dir, inv.FIRST_SQL)
