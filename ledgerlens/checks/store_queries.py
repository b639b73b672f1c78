"""Queries over what the write side leaves: published versions, merges, file statistics, and
the relations in compact form."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.checks import base_sql as q
from ledgerlens.checks import inputs
from ledgerlens.checks.join_queries import CONTACTS
from ledgerlens.checks.registry import plain, query, snap_sql
from ledgerlens.functions import sql_functions
from ledgerlens.plans import relation_classes
from ledgerlens.sources import file_statistics, publish, star_tables, store
from ledgerlens.sources.store import materialize, shared_folder


@contextmanager
def _tables(spark: SparkSession, *endings: str) -> Iterator[list[str]]:
    """Names for tables that go when the block ends."""
    made = [f"ledger_{uuid.uuid4().hex}_{e}" for e in endings]
    try:
        yield made
    finally:
        for name in made:
            if spark.catalog.tableExists(name):
                kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
                spark.sql(f"DROP {kind} {name}")
            for table in (f"{name}__versions", f"{name}__keys"):
                spark.sql(f"DROP TABLE IF EXISTS {table}")


@query("sink_overwrite", "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS v FROM orders WHERE o_orderstatus <> 'O'")
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after its rows, schema and partitions were replaced."""
    orders = star_tables.read(spark, sf_dir, "orders")
    with _tables(spark, "overwritten") as (name,):
        store.overwrite_table(orders.select("o_orderkey", "o_orderpriority"), name)
        rows = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("v"))
        store.overwrite_table(rows.filter("status <> 'O'"), name, ["status"])
        return materialize(spark.table(name), "overwritten")


@query("sink_insert_overwrite", "SELECT o_orderkey AS id, o_totalprice AS v FROM orders WHERE o_orderstatus = 'F'")
def sink_insert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after its rows were replaced, its schema kept."""
    orders = star_tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"), "o_orderstatus")
    with _tables(spark, "inserted") as (name,):
        store.insert_overwrite(orders.filter("o_orderstatus <> 'F'").drop("o_orderstatus"), name)
        # Given in another order; columns are matched by name.
        store.insert_overwrite(orders.filter("o_orderstatus = 'F'").select("v", "id"), name)
        return materialize(spark.table(name), "inserted")


ORDER_MONTHS = "m AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m') AS month, o_totalprice AS v, o_custkey AS c FROM orders)"


@query(
    "sink_upsert_moved",
    f"""WITH {ORDER_MONTHS} SELECT id, CASE WHEN c % 7 = 0 THEN '209901' WHEN c % 11 = 0 THEN '199701' ELSE month END AS month,
            CASE WHEN c % 7 = 0 OR c % 11 = 0 OR c % 13 = 0 THEN -v ELSE v END AS v FROM m
        WHERE month < '199707' OR c % 7 = 0 OR c % 11 = 0 OR c % 13 = 0""",
)
def sink_upsert_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table after a merge whose keys move between partitions: each is there once."""
    orders = star_tables.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"), F.date_format("o_orderdate", "yyyyMM").alias("month"), F.col("o_custkey").alias("c")
    )
    place = F.when(F.col("c") % 7 == 0, "209901").when(F.col("c") % 11 == 0, "199701").otherwise(F.col("month"))
    changed = (F.col("c") % 7 == 0) | (F.col("c") % 11 == 0) | (F.col("c") % 13 == 0)
    changes = orders.filter(changed).select("id", (-F.col("v")).alias("v"), place.alias("month"))
    with _tables(spark, "merged") as (name,):
        store.upsert(orders.filter("month < '199707'").drop("c"), name, ["id"], "month", [F.desc("v")])
        store.upsert(changes, name, ["id"], "month", [F.desc("v")])
        return materialize(spark.table(name), "merged")


AUDITED = """SELECT * FROM (
    SELECT 'rows' AS "check", month AS partition, count(*) AS found, count(*) >= 3 AS ok FROM r GROUP BY month UNION ALL
    SELECT 'misplaced', month, count(*) FILTER (WHERE strftime(day, '%Y%m') <> month), count(*) FILTER (WHERE strftime(day, '%Y%m') <> month) = 0
        FROM r GROUP BY month UNION ALL
    SELECT 'outside', month, CASE WHEN month > '200001' THEN count(*) ELSE 0 END, month <= '200001' FROM r GROUP BY month UNION ALL
    SELECT 'duplicates', partition, CAST(sum(n - 1) AS BIGINT), false FROM (SELECT k, line, min(month) AS partition, count(*) AS n FROM r GROUP BY k, line HAVING count(*) > 1)
        GROUP BY partition)"""


@query(
    "publish_audit",
    f"""WITH r AS (SELECT l_orderkey AS k, l_linenumber AS line, CAST(l_shipdate AS DATE) AS day,
            CASE WHEN l_partkey % 500 = 0 THEN '199601' ELSE strftime(l_shipdate, '%Y%m') END AS month FROM lineitem) {AUDITED}""",
)
def publish_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an audit says of a version that was written but not published."""
    lines = star_tables.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("line"),
        F.to_date("l_shipdate").alias("day"),
        F.when(F.col("l_partkey") % 500 == 0, "199601").otherwise(F.date_format("l_shipdate", "yyyyMM")).alias("month"),
    )
    allowed = [f"{y}{m:02}" for y in range(1990, 2001) for m in range(1, 13) if (y, m) <= (2000, 1)]
    with _tables(spark, "audited") as (name,):
        table = publish.PublishedTable(spark, name, "month", ("k", "line"), "day")
        return materialize(table.audit(table.stage(lines), least_rows=3, scope=allowed), "audit")


@query(
    "publish_rows",
    """SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m') AS month, CAST(o_orderdate AS DATE) AS day,
              CASE WHEN strftime(o_orderdate, '%Y%m') BETWEEN '199703' AND '199706' THEN 2 ELSE 1 END AS round FROM orders
       WHERE strftime(o_orderdate, '%Y%m') < '199801' AND strftime(o_orderdate, '%Y%m') <> '199705'""",
)
def publish_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see after two good versions and one that its audit stopped."""
    orders = star_tables.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("day"), F.date_format("o_orderdate", "yyyyMM").alias("month")
    )
    spring = ["199703", "199704", "199705", "199706"]
    with _tables(spark, "published") as (name,):
        table = publish.PublishedTable(spark, name, "month", ("id",), "day")
        table.replace(orders.filter("month < '199801'").withColumn("round", F.lit(1)))
        again = orders.filter(F.col("month").isin([m for m in spring if m != "199705"])).withColumn("round", F.lit(2))
        table.replace(again, scope=spring)
        try:
            table.replace(orders.filter("month < '199702'").withColumn("month", F.lit("199612")).withColumn("round", F.lit(3)))
        except publish.AuditFailed:
            pass  # rows of other months: nothing of it is seen
        table.vacuum()
        return materialize(spark.table(name), "published")


def _folder(df: DataFrame, partition: str) -> str:
    """A Parquet folder by partition, removed when the process ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    store.remove_at_exit(spark, path)
    df.hint("rebalance", partition).write.partitionBy(partition).parquet(path)
    return path


GATE_DAYS = [dt.date(1997, 12, 31), dt.date(1998, 3, 7), dt.date(2015, 1, 1)]


@query(
    "gate_from_files",
    f"""SELECT source, run_date, ok FROM (SELECT 'lines' AS source, d AS run_date, EXISTS (SELECT 1 FROM lineitem
            WHERE l_linenumber = 1 AND CAST(l_shipdate AS DATE) > d AND CAST(l_shipdate AS DATE) <= d + INTERVAL 10 DAY) AS ok
          FROM (VALUES {', '.join(f"(DATE '{d}')" for d in GATE_DAYS)}) v(d)
        UNION ALL SELECT 'yearly', d, EXISTS (SELECT 1 FROM orders WHERE dayofmonth(o_orderdate) > 20
            AND CAST(o_orderdate AS DATE) > d AND CAST(o_orderdate AS DATE) <= d + INTERVAL 10 DAY)
          FROM (VALUES {', '.join(f"(DATE '{d}')" for d in GATE_DAYS)}) v(d))""",
)
def gate_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate answered by partitions and footers; the second source has partitions that
    reach over the range, so one of them is read."""
    lines = star_tables.read(spark, sf_dir, "lineitem").filter("l_linenumber = 1")
    lines = lines.select(F.to_date("l_shipdate").alias("day"), F.date_format("l_shipdate", "yyyyMM").alias("month"), "l_orderkey")
    orders = star_tables.read(spark, sf_dir, "orders").filter(F.dayofmonth("o_orderdate") > 20)
    orders = orders.select(F.to_date("o_orderdate").alias("day"), F.date_format("o_orderdate", "yyyy").alias("year"), "o_orderkey")
    sources = {"lines": (_folder(lines, "month"), "month", "day"), "yearly": (_folder(orders, "year"), "year", "day")}
    return file_statistics.availability_from_files(spark, sources, GATE_DAYS)


@query(
    "alignment_from_files",
    """WITH r AS (SELECT CAST(l_shipdate AS DATE) AS day, CASE WHEN l_partkey % 300 = 0 AND month(l_shipdate) % 3 = 0
                      THEN strftime(l_shipdate + INTERVAL 1 MONTH, '%Y%m') ELSE strftime(l_shipdate, '%Y%m') END AS month FROM lineitem)
       SELECT month, min(day) AS min_date, max(day) AS max_date, count(*) AS row_count,
              count(*) FILTER (WHERE strftime(day, '%Y%m') <> month) AS misplaced FROM r GROUP BY month""",
)
def alignment_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition profile: only months that footers show to hold other months' days are read."""
    day = F.col("l_shipdate")
    late = (F.col("l_partkey") % 300 == 0) & (F.month(day) % 3 == 0)
    month = F.date_format(F.when(late, F.add_months(F.to_date(day), 1)).otherwise(F.to_date(day)), "yyyyMM")
    lines = star_tables.read(spark, sf_dir, "lineitem").select(F.to_date(day).alias("day"), month.alias("month"))
    return file_statistics.alignment_from_files(spark, _folder(lines, "month"), "month", "day")


LISTED = 40
CLASSES = f"""{CONTACTS}, c AS (SELECT DISTINCT entity, rel, val FROM contacts),
    held AS (SELECT entity, string_agg(rel || chr(1) || val, chr(2) ORDER BY rel, val) AS s FROM c GROUP BY entity),
    nodes AS (SELECT s, min(entity) AS node, count(*) AS size FROM held GROUP BY s),
    nc AS (SELECT DISTINCT node, size, rel, val FROM c JOIN held USING (entity) JOIN nodes USING (s)),
    holders AS (SELECT rel, val, count(*) > {LISTED} AS wide FROM nc GROUP BY ALL),
    wide AS (SELECT node, string_agg(rel || chr(1) || val, chr(2) ORDER BY rel, val) AS h FROM nc JOIN holders USING (rel, val) WHERE wide GROUP BY node),
    hubs AS (SELECT h, min(node) AS hub FROM wide GROUP BY h),
    hub_of AS (SELECT node, hub FROM wide JOIN hubs USING (h)),
    shared AS (SELECT a.node AS a, b.node AS b, a.size AS sa, b.size AS sb, a.rel, a.val, wide FROM nc a JOIN nc b USING (rel, val) JOIN holders USING (rel, val)
        WHERE a.node < b.node OR (a.node = b.node AND a.size > 1)),
    vals AS (SELECT a, b, rel, any_value(sa) AS sa, any_value(sb) AS sb, string_agg(val, ', ' ORDER BY val) AS vals, bool_or(NOT wide) AS narrow
        FROM shared GROUP BY a, b, rel),
    told AS (SELECT a, b, any_value(CASE WHEN a = b THEN sa * (sa - 1) // 2 ELSE sa * sb END) AS n, bool_or(narrow) OR a = b AS listed,
            string_agg(rel, ', ' ORDER BY rel) AS relationship, string_agg('{{' || rel || ': ' || vals || '}}', ', ' ORDER BY rel) AS relationship_detail
        FROM vals GROUP BY a, b)"""


@query(
    "relation_classes",
    f"""WITH {CLASSES} SELECT 'node' AS kind, a, b, CAST(n AS BIGINT) AS n_links, relationship, relationship_detail FROM told WHERE listed
        UNION ALL SELECT 'hub', least(x.hub, y.hub), greatest(x.hub, y.hub), CAST(sum(n) AS BIGINT), min(relationship), max(relationship_detail)
        FROM told JOIN hub_of x ON x.node = a JOIN hub_of y ON y.node = b WHERE NOT listed GROUP BY 2, 3""",
)
def relations_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All relations, also of entities that do not trade, as links between classes."""
    return relation_classes.relation_classes(inputs.contacts(spark, sf_dir), LISTED).links


@query(
    "relation_members",
    f"WITH {CLASSES} SELECT entity, node, hub FROM held JOIN nodes USING (s) LEFT JOIN hub_of USING (node)",
)
def relation_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which classes every entity is in."""
    return relation_classes.relation_classes(inputs.contacts(spark, sf_dir), LISTED).members


@query(
    "sql_tax_bands",
    q.with_ctes(
        "inv",
        f"""SELECT CASE WHEN pct = 10 THEN '10%' WHEN pct = 8 THEN '8%' WHEN pct = 5 THEN '5%' WHEN pct = 0 THEN '0%' ELSE 'others' END AS band,
                   count(*) AS invoices, sum(tax) AS tax, {snap_sql('sum(CASE WHEN sale > 0 THEN tax / sale ELSE 0 END)')} AS shares
            FROM (SELECT *, round(tax / (sale + discount + tax) * 100, 2) AS pct FROM inv) GROUP BY ALL""",
    ),
)
def sql_tax_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tax bands in SQL alone."""
    sql_functions.register(spark)
    star_tables.invoices(spark, sf_dir).createOrReplaceTempView("ledger_invoices")
    return spark.sql(
        """SELECT ledger_tax_band(ledger_tax_percent(tax, sale, discount)) AS band, count(*) AS invoices, sum(tax) AS tax,
                  CAST(floor(sum(ledger_ratio(tax, sale)) * 1000000D + 0.5D) AS DOUBLE) / 1000000D AS shares
           FROM ledger_invoices GROUP BY 1"""
    )


@query(
    "sql_night_flags",
    "SELECT event_id, hour(ts) >= 22 OR hour(ts) < 6 AS is_night, hour(ts) >= 0 AND hour(ts) < 4 AS is_core FROM events",
)
def sql_night_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Night flags in SQL alone."""
    sql_functions.register(spark)
    star_tables.read(spark, sf_dir, "events").createOrReplaceTempView("ledger_events")
    return spark.sql("SELECT event_id, ledger_is_night(hour(ts)) AS is_night, ledger_is_core(hour(ts)) AS is_core FROM ledger_events")


SQL_DAILY = [
    "daily_total_sales", "daily_invoice_count", "daily_buyer_count", "daily_total_tax", "daily_total_discount", "daily_night_invoice_count",
    "daily_core_invoice_count", "daily_night_ratio", "daily_core_ratio", "daily_discount_ratio", "daily_sales_per_buyer", "daily_sales_per_invoice",
]
_DAILY_COUNTS = {c for c in SQL_DAILY if c.endswith("_count")}


@query(
    "sql_daily_sellers",
    q.with_ctes(
        "recent",
        "SELECT mst_seller, report_date, "
        + ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c in _DAILY_COUNTS else f"{snap_sql(c, 4)} AS {c}" for c in SQL_DAILY)
        + " FROM recent",
    ),
)
def sql_daily_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table by a table function."""
    sql_functions.register_sales(spark, inputs.typed(spark, sf_dir))
    return plain(spark.sql(f"SELECT * FROM ledger_daily(DATE '{inputs.FIRST_DAY}', DATE '{inputs.LAST_DAY}')"), 4)


_PERIOD_NAMES = {f: f"sales_{f}" for f in ("sum", "avg", "min", "max", "std", "med")}


def _windows_sql() -> str:
    parts = []
    for window, start in q.PERIODS.items():
        rows = f"(SELECT * FROM recent WHERE report_date >= DATE '{start}')"
        statistics = ", ".join(
            f"{snap_sql('quantile_cont(daily_total_sales, 0.5)' if f == 'med' else q.aggregate_sql(f, 'daily_total_sales'), 4)} AS {name}"
            for f, name in _PERIOD_NAMES.items()
        )
        parts.append(f"SELECT mst_seller, '{window}' AS window_name, count(*) AS days, count(DISTINCT daily_buyer_count) AS buyer_counts, {statistics} FROM {rows} GROUP BY mst_seller")
    return q.with_ctes("recent", " UNION ALL ".join(parts))


@query("sql_period", _windows_sql())
def sql_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of trailing windows by a table function."""
    sql_functions.register_sales(spark, inputs.typed(spark, sf_dir))
    found = spark.sql(f"SELECT mst_seller, window_name, days, buyer_counts, {', '.join(_PERIOD_NAMES.values())} FROM ledger_period(DATE '{inputs.RUN_DATE}')")
    return plain(found, 4)
