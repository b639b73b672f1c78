"""Invoice, contact and balance inputs mapped from the star-schema test tables.

Every mapping keeps all rows of its source table. Amounts are doubles that hold whole
numbers, so sums are exact and do not depend on the order rows are added in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _whole(price: Column) -> Column:
    """Price rounded down to hundreds, so percentages of it are whole numbers."""
    return (F.floor(price / 100) * 100).cast("double")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per line item, in logical columns."""
    gross = _whole(F.col("l_extendedprice"))
    discount = F.round(gross * F.col("l_discount"))
    tax = F.round(gross * F.col("l_tax"))
    sale = gross - discount - tax
    part = F.col("l_partkey")
    signed = F.col("l_shipdate") + _hours(part % 24)
    kind = (
        F.when(part % 19 == 0, "5")
        .when(F.col("l_returnflag") == "N", "1")
        .when(F.col("l_returnflag") == "A", "9")
        .otherwise("3")
    )
    lines = read(spark, sf_dir, "lineitem").join(
        read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("invoice_id"),
        F.col("o_orderdate").alias("record_ts"),
        F.when(F.col("l_linenumber") == 7, "0").otherwise("1").alias("status"),
        kind.alias("adjust_type"),
        F.concat(F.lit(" "), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("seller"),
        F.when(part % 13 != 0, signed).alias("issue_ts"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey").cast("string")).alias("buyer"),
        F.col("l_linestatus").alias("transport"),
        F.concat_ws("-", "o_orderstatus", (F.col("o_custkey") % 7).cast("string")).alias("buyer_address"),
        tax.alias("tax"),
        F.when(part % 23 != 0, discount).alias("discount"),
        (discount * 2).alias("settlement_discount"),
        (sale + tax).alias("with_vat"),
        sale.alias("without_vat"),
        F.when(part % 29 != 0, F.col("o_orderpriority")).alias("payment"),
        F.concat(F.lit('[{"sku": '), part.cast("string"), F.lit("}]")).alias("items"),
        F.date_format(signed, "yyyyMM").alias("partition_month"),
        F.when(part % 211 != 0, signed).alias("signed_ts"),
        F.when(part % 17 == 0, "PENDING").when(part % 17 == 1, "CODE_APPROVED").otherwise("TAX_CODE_APPROVED_1").alias(
            "error_code"
        ),
        sale.alias("sale"),
        F.when(kind == "9", sale).alias("adjusted_with_vat"),
        F.when(kind == "3", tax).alias("adjusted_without_vat"),
    )


def order_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per order; each order may correct the one before it."""
    key = F.col("o_orderkey")
    when = F.col("o_orderdate") + _hours(key % 24)
    code = F.when(key % 5 == 0, "9").when(key % 5 == 1, "3").otherwise("1")
    return read(spark, sf_dir, "orders").select(
        key.cast("string").alias("invoice_id"),
        F.col("o_orderdate").alias("record_ts"),
        F.when(key % 10 == 9, "2").otherwise("1").alias("status"),
        code.alias("adjust_type"),
        F.when(key % 5 == 0, "2").when(key % 5 == 1, "3").otherwise("1").alias("adjust_status"),
        (key % 100).cast("string").alias("seller"),
        F.when(key % 13 != 0, when).alias("issue_ts"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey").cast("string")).alias("buyer"),
        F.col("o_orderstatus").alias("transport"),
        F.concat_ws("/", "o_orderstatus", (key % 3).cast("string")).alias("buyer_address"),
        (F.col("o_custkey") % 50).cast("string").alias("buyer_name"),
        F.lit(0.0).alias("tax"),
        F.when(key % 4 != 0, F.floor("o_totalprice").cast("double")).alias("with_vat_foreign"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("discount"),
        F.floor(F.col("o_totalprice") / 500).cast("double").alias("settlement_discount"),
        F.floor("o_totalprice").cast("double").alias("with_vat"),
        F.floor("o_totalprice").cast("double").alias("without_vat"),
        (key - 1).cast("string").alias("original_invoice"),
        F.col("o_orderpriority").alias("payment"),
        F.concat(F.lit("["), (key % 40).cast("string"), F.lit("]")).alias("items"),
        F.floor(key / 100).cast("string").alias("partition_month"),
    )


def event_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-of-day rows of one month: timestamp and seller."""
    return read(spark, sf_dir, "events").select("ts", F.col("user_id").cast("string").alias("seller"))


def contact_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text contacts per customer. Neighbours share values in small groups, and
    every third customer shares one switchboard number."""
    key = F.col("c_custkey")

    def shared(size: int) -> Column:
        return F.floor(key / size).cast("string")

    return read(spark, sf_dir, "customer").select(
        F.concat(F.lit(" "), key.cast("string")).alias("entity"),
        F.concat(F.lit("+849"), F.lpad(shared(3), 8, "0"), F.lit("; tel 12")).alias("phone_1"),
        F.concat(
            F.lit("0091"),
            F.lpad(shared(5), 7, "0"),
            F.when(key % 3 == 0, "/0281111222").otherwise(""),
        ).alias("phone_2"),
        F.when(
            key % 7 != 0,
            F.concat(F.lit("U"), shared(4), F.lit("@Example.com, not-an-address;u"), shared(4), F.lit("@example.com")),
        ).alias("email_1"),
        F.concat(F.lit("id "), shared(6), F.lit("-x, doc."), shared(6)).alias("rep_id"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date of the orders with weekends off."""
    span = read(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    days = span.select(F.explode(F.sequence("first", "last")).alias("date_code"))
    return days.withColumn("off_date", F.dayofweek("date_code").isin(1, 7))


def balance_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Current-account balances, deposit balances, and cash flows per customer and day."""
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("cusid"),
        F.to_date("o_orderdate").alias("report_date"),
        F.floor(F.col("o_totalprice") / 100).cast("double").alias("amount"),
        F.col("o_orderkey").alias("k"),
    )

    def balance(remainder: int, name: str) -> DataFrame:
        return orders.filter(F.col("k") % 3 == remainder).groupBy("cusid", "report_date").agg(F.sum("amount").alias(name))

    flows = orders.filter(F.col("k") % 3 != 1).select(
        F.col("cusid").alias("customer_code"),
        F.col("report_date").alias("ds_partition_date"),
        F.when(F.col("k") % 2 == 0, "IN").otherwise("OUT").alias("cash_flow_lv1"),
        F.col("amount").alias("txn_amt"),
    )
    return balance(0, "atxca_bal"), balance(1, "asvtd_bal"), flows


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product holdings: one row per order line's account and day."""
    return (
        read(spark, sf_dir, "lineitem")
        .select(
            F.col("l_orderkey").alias("unq_id_src_stm"),
            F.to_date("l_shipdate").alias("ds_partition_date"),
            F.col("l_suppkey").cast("string").alias("cst_code"),
            F.when(F.col("l_linenumber") == 7, 0).otherwise(1).alias("ds_rec_st"),
            F.when(F.col("l_linenumber") == 6, "RETAIL").otherwise("CORPORATE").alias("ar_bsn_line"),
            F.when(F.col("l_returnflag") == "N", "Valuable papers issued to customers")
            .when(F.col("l_returnflag") == "A", "CORP_Valuable papers issued to customers")
            .otherwise("Loans")
            .alias("pd_lvl_2_nm"),
        )
    )


def account_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account balances by type; some are negative."""
    number = F.col("l_linenumber")
    amount = _whole(F.col("l_extendedprice"))
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("unq_id_src_stm"),
        F.to_date("l_shipdate").alias("ppn_dt"),
        F.when(number % 4 == 0, "INDUE_PRIN_BAL")
        .when(number % 4 == 1, "INDUE_PRIN_BAL_DEBIT")
        .when(number % 4 == 2, "PST_DUE_PRIN")
        .otherwise("FEE")
        .alias("au_tp_code"),
        F.when(F.col("l_partkey") % 7 == 0, -amount).otherwise(amount).alias("net_amt_lcy"),
    )
