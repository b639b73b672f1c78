"""Row-level queries: slices, filters, keys, derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.checks import base_sql as q
from ledgerlens.checks import inputs
from ledgerlens.checks.registry import plain, query, snap_sql
from ledgerlens.functions import dates, scalars
from ledgerlens.plans import related
from ledgerlens.sources import invoices as inv
from ledgerlens.sources import star_tables, store


@query(
    "src_table",
    "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
)
def src_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star_tables.read(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate"))


@query(
    "src_month_slice",
    q.with_ctes("inv", "SELECT invoice_id, trim(seller) AS seller, sale FROM inv WHERE partition_month = '199712'"),
)
def src_month_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = inv.month_slice(star_tables.invoices(spark, sf_dir), inputs.RUN_DATE)
    return plain(month.select("invoice_id", F.trim("seller").alias("seller"), "sale"), snapped=set())


@query(
    "src_window_slice",
    q.with_ctes("recent", "SELECT mst_seller, report_date, daily_total_sales, daily_invoice_count FROM recent"),
)
def src_window_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = inv.window_slice(inputs.daily(spark, sf_dir), "report_date", inputs.RUN_DATE)
    return plain(
        window.select("mst_seller", "report_date", "daily_total_sales", "daily_invoice_count"), snapped=set()
    )


@query("flt_issued", q.with_ctes("inv", "SELECT invoice_id, status FROM inv WHERE TRY_CAST(status AS INT) = 1"))
def flt_issued(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_tables.invoices(spark, sf_dir).filter(inv.is_issued()).select("invoice_id", "status")


@query(
    "flt_approved",
    q.with_ctes(
        "inv",
        """SELECT invoice_id, adjust_type, error_code FROM inv
           WHERE TRY_CAST(status AS INT) = 1 AND signed_ts IS NOT NULL AND error_code LIKE '%_CODE_APPROVED%'
             AND adjust_type IN ('1', '3', '7', '9')""",
    ),
)
def flt_approved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_tables.invoices(spark, sf_dir).filter(inv.is_approved()).select("invoice_id", "adjust_type", "error_code")


@query(
    "norm_keys",
    q.with_ctes(
        "inv",
        """SELECT trim(seller) AS mst_seller, trim(buyer) AS mst_buyer, count(*) AS n FROM inv
           WHERE seller IS NOT NULL AND signed_ts IS NOT NULL GROUP BY ALL""",
    ),
)
def norm_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.typed(spark, sf_dir).groupBy("mst_seller", "mst_buyer").agg(F.count(F.lit(1)).alias("n"))


@query(
    "event_time",
    q.with_ctes(
        "inv",
        """SELECT invoice_id, strftime(coalesce(issue_ts, record_ts), '%Y-%m-%d %H:%M:%S') AS issued_at,
                  strftime(signed_ts, '%Y-%m-%d %H:%M:%S') AS signed_at FROM inv""",
    ),
)
def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_tables.invoices(spark, sf_dir)
    return rows.select(
        "invoice_id",
        F.date_format(inv.event_time(rows, inv.SECOND), "yyyy-MM-dd HH:mm:ss").alias("issued_at"),
        F.date_format(inv.event_time(rows, inv.CURRENT), "yyyy-MM-dd HH:mm:ss").alias("signed_at"),
    )


@query(
    "calendar_cols",
    """SELECT event_id, CAST(ts AS DATE) AS report_date, hour(ts) AS hour,
              CAST(date_trunc('month', ts) AS DATE) AS month_start, last_day(ts) AS month_end,
              strftime(ts, '%Y-%m') AS month, year(ts) AS year, month(ts) AS month_of_year,
              day(ts) AS day_of_month FROM events""",
)
def calendar_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = dates.calendar_columns(F.col("ts"))
    return plain(
        star_tables.read(spark, sf_dir, "events").select("event_id", *[e.alias(n) for n, e in calendar.items()])
    )


@query(
    "night_core_flags",
    "SELECT event_id, hour(ts) >= 22 OR hour(ts) < 6 AS is_night, hour(ts) >= 0 AND hour(ts) < 4 AS is_core FROM events",
)
def night_core_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.hour("ts")
    return star_tables.read(spark, sf_dir, "events").select(
        "event_id",
        scalars.in_hours(hour, *scalars.NIGHT_HOURS).alias("is_night"),
        scalars.in_hours(hour, *scalars.CORE_HOURS).alias("is_core"),
    )


@query(
    "tax_band",
    q.with_ctes(
        "inv",
        f"""SELECT invoice_id, {snap_sql('pct', 2)} AS tax_pct,
                   CASE WHEN pct = 10 THEN '10%' WHEN pct = 8 THEN '8%' WHEN pct = 5 THEN '5%' WHEN pct = 0 THEN '0%'
                        ELSE 'others' END AS tax_band
            FROM (SELECT invoice_id, round(tax / (sale + discount + tax) * 100, 2) AS pct FROM inv)""",
    ),
)
def tax_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    percent = scalars.tax_percent(F.col("tax"), F.col("sale"), F.col("discount"))
    rows = star_tables.invoices(spark, sf_dir).select("invoice_id", percent.alias("tax_pct"))
    return plain(rows.withColumn("tax_band", scalars.tax_band(F.col("tax_pct"))), 2)


@query(
    "ratio_guarded",
    q.with_ctes(
        "inv",
        f"""SELECT invoice_id,
                   {snap_sql('CASE WHEN sale - 50000 > 0 THEN tax / (sale - 50000) ELSE 0 END')} AS zero_ratio,
                   {snap_sql('CASE WHEN sale - 50000 > 0 THEN tax / (sale - 50000) END')} AS null_ratio FROM inv""",
    ),
)
def ratio_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("sale") - 50000
    rows = star_tables.invoices(spark, sf_dir).select(
        "invoice_id",
        scalars.ratio(F.col("tax"), base).alias("zero_ratio"),
        scalars.ratio(F.col("tax"), base, None).alias("null_ratio"),
    )
    return plain(rows, 6)


@query(
    "flt_period",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS report_date FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-10-01' AND DATE '1997-12-31'""",
)
def flt_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_tables.read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("report_date"))
    start = dates.trailing_starts(inputs.LAST_DAY)["l3m"]
    return rows.filter(dates.within("report_date", start, inputs.LAST_DAY))


NOW = "2001-01-15 13:30:00"
TRADES = """trades AS (SELECT trim(seller) AS issuer, trim(buyer) AS buyer, signed_ts AS ts, with_vat AS amount
            FROM inv WHERE seller IS NOT NULL AND buyer IS NOT NULL AND trim(seller) <> trim(buyer)
              AND signed_ts >= TIMESTAMP '2000-01-15 00:00:00')"""


def recent_trades(spark: SparkSession, sf_dir: str, include_self: bool = False) -> DataFrame:
    return related.trades(
        star_tables.invoices(spark, sf_dir), ts_col="signed_ts", now=NOW, include_self=include_self
    )


@query(
    "flt_recent_window",
    q.with_ctes(
        "inv",
        """SELECT trim(seller) AS issuer, count(*) AS n, CAST(min(signed_ts) AS DATE) AS first_day FROM inv
           WHERE seller IS NOT NULL AND buyer IS NOT NULL AND signed_ts >= TIMESTAMP '2000-01-15 00:00:00'
           GROUP BY ALL""",
    ),
)
def flt_recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recent_trades(spark, sf_dir, include_self=True)
    return rows.groupBy("issuer").agg(F.count(F.lit(1)).alias("n"), F.to_date(F.min("ts")).alias("first_day"))


@query(
    "flt_not_self",
    q.with_ctes("inv", "").rstrip()
    + f", {TRADES} SELECT issuer, buyer, CAST(ts AS DATE) AS day, amount FROM trades",
)
def flt_not_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recent_trades(spark, sf_dir).select("issuer", "buyer", F.to_date("ts").alias("day"), "amount")
    return plain(rows, snapped=set())


@query(
    "unit_change",
    f"""SELECT c_custkey, {snap_sql('c_acctbal * 1e-6', 8)} AS c_acctbal,
               {snap_sql("TRY_CAST(c_mktsegment AS DOUBLE) * 1e-6", 8)} AS c_mktsegment FROM customer""",
)
def unit_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_tables.read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return plain(scalars.scale_columns(rows, ["c_acctbal", "c_mktsegment"], scalars.BALANCE_UNIT), 8)


@query(
    "null_policy",
    q.with_ctes(
        "inv",
        """SELECT invoice_id, coalesce(discount, 0) AS discount, buyer, payment FROM inv WHERE payment IS NOT NULL""",
    ),
)
def null_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.operators.joins import fill_subset

    rows = star_tables.invoices(spark, sf_dir).select("invoice_id", "discount", "buyer", "payment")
    return plain(fill_subset(rows.filter(F.col("payment").isNotNull()), ["discount"]), snapped=set())


@query(
    "add_run_date",
    f"""SELECT DATE '{q.LAST_DAY}' AS report_date, CAST(l_suppkey AS VARCHAR) AS mst_seller, count(*) AS n
        FROM lineitem GROUP BY ALL""",
)
def add_run_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star_tables.read(spark, sf_dir, "lineitem")
    counts = lines.groupBy(F.col("l_suppkey").cast("string").alias("mst_seller")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.lit(inputs.LAST_DAY).alias("report_date"), "*")


@query(
    "audit_columns",
    """SELECT CAST(NULL AS VARCHAR) AS ds_etl_job_id, CAST(NULL AS VARCHAR) AS ds_source_system,
              CAST(NULL AS VARCHAR) AS ds_key, day AS ds_partition_date, day AS processed_on, true AS loaded, cusid
       FROM (SELECT CAST(o_orderdate AS DATE) AS day, CAST(o_custkey AS VARCHAR) AS cusid FROM orders)""",
)
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_tables.read(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("report_date"), F.col("o_custkey").cast("string").alias("cusid")
    )
    return store.audit_columns(rows, "report_date").select(
        "ds_etl_job_id",
        "ds_source_system",
        "ds_key",
        "ds_partition_date",
        F.to_date("processing_dt").alias("processed_on"),
        F.col("ds_etl_timestamp").isNotNull().alias("loaded"),
        "cusid",
    )


@query(
    "gate_availability",
    """SELECT source, run_date, ok FROM (
         SELECT 'orders' AS source, d AS run_date, EXISTS (SELECT 1 FROM orders
                WHERE CAST(o_orderdate AS DATE) > d AND CAST(o_orderdate AS DATE) <= d + INTERVAL 10 DAY) AS ok
         FROM (VALUES (DATE '1997-12-31'), (DATE '2015-01-01')) v(d)
         UNION ALL
         SELECT 'lineitem', d, EXISTS (SELECT 1 FROM lineitem
                WHERE CAST(l_shipdate AS DATE) > d AND CAST(l_shipdate AS DATE) <= d + INTERVAL 10 DAY)
         FROM (VALUES (DATE '1997-12-31'), (DATE '2015-01-01')) v(d))""",
)
def gate_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    import datetime as dt

    sources = {
        "orders": (star_tables.read(spark, sf_dir, "orders"), "o_orderdate"),
        "lineitem": (star_tables.read(spark, sf_dir, "lineitem"), "l_shipdate"),
    }
    return store.availability(sources, [inputs.LAST_DAY, dt.date(2015, 1, 1)])


@query(
    "profile_partition_alignment",
    q.with_ctes(
        "inv",
        """SELECT partition_month, CAST(min(record_ts) AS DATE) AS min_date, CAST(max(record_ts) AS DATE) AS max_date,
                  count(*) AS row_count, count(*) FILTER (WHERE strftime(record_ts, '%Y%m') <> partition_month)
                  AS misplaced FROM inv GROUP BY ALL""",
    ),
)
def profile_partition_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.partition_alignment(star_tables.invoices(spark, sf_dir), "partition_month", "record_ts")


@query(
    "union_arrays",
    """SELECT c_custkey, array_to_string(list_distinct_in_order, ',') AS merged FROM (
         SELECT c_custkey, list_reduce([[]::VARCHAR[]] || [a] || [b], lambda acc, x:
                acc || list_filter(x, lambda v: NOT list_contains(acc, v))) AS list_distinct_in_order
         FROM (SELECT c_custkey, string_split(c_name, '#') AS a,
                      CASE WHEN c_custkey % 5 <> 0 THEN [c_mktsegment, 'Customer'] END AS b
               FROM customer) WHERE b IS NOT NULL
         UNION ALL SELECT c_custkey, string_split(c_name, '#') FROM customer WHERE c_custkey % 5 = 0)""",
)
def union_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_tables.read(spark, sf_dir, "customer")
    tags = F.when(F.col("c_custkey") % 5 != 0, F.array("c_mktsegment", F.lit("Customer")))
    merged = scalars.union_of_arrays(F.split("c_name", "#"), tags)
    return rows.select("c_custkey", F.array_join(merged, ",").alias("merged"))


STAGED = """target AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS day, o_orderkey AS id, o_totalprice AS v FROM orders
        WHERE o_orderstatus <> 'O'),
    changes AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS day, o_orderkey AS id, -o_totalprice AS v FROM orders
        WHERE o_orderpriority = '1-URGENT')"""


def _table_and_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = star_tables.read(spark, sf_dir, "orders")
    price = F.col("o_totalprice")

    def shaped(df: DataFrame, value: Column) -> DataFrame:
        return df.select(
            F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("id"), value.alias("v")
        )

    return shaped(orders.filter("o_orderstatus <> 'O'"), price), shaped(orders.filter("o_orderpriority = '1-URGENT'"), -price)


@query(
    "sink_upsert",
    f"""WITH {STAGED}, latest AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY k, day ORDER BY id DESC) AS r
            FROM changes) WHERE r = 1)
        SELECT * FROM latest UNION ALL SELECT t.* FROM target t WHERE day IN (SELECT day FROM latest)
            AND NOT EXISTS (SELECT 1 FROM latest l WHERE l.k = t.k AND l.day = t.day)""",
)
def sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the partitions that a merge rewrites."""
    target, changes = _table_and_changes(spark, sf_dir)
    return store.merged_rows(target, store.latest_rows(changes, ["k", "day"], [F.desc("id")]), ["k", "day"], "day")


@query(
    "sink_replace_partitions",
    f"""WITH {STAGED} SELECT * FROM changes UNION ALL
        SELECT * FROM target WHERE day NOT IN (SELECT day FROM changes)""",
)
def sink_replace_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table after a partition replacement."""
    target, changes = _table_and_changes(spark, sf_dir)
    return store.replaced_rows(target, changes, ["day"])
