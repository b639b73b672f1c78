"""What the plans of the named queries must and must not contain."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgerlens.checks import inputs
from ledgerlens.operators import joins
from ledgerlens.operators.skew import heavy_keys, spread_join
from ledgerlens.plans import grains, seller_features
from ledgerlens.sources import star_tables
from ledgerlens.sources.store import bucketed, materialize

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["win_topn_buyers", "agg_top_buyers_cond", "win_top5_days_per_seller"])
def test_top_rows_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(queries()[name](spark, SF_DIR))


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(queries()["topk_global"](spark, SF_DIR))


def test_filters_and_columns_reach_the_scan(spark):
    orders = star_tables.read(spark, SF_DIR, "orders").filter("o_orderstatus = 'P'")
    text = plan(joins.days_without(orders.select(F.to_date("o_orderdate").alias("day")), "day"))
    assert "EqualTo(o_orderstatus,P)" in text
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in text


def test_month_slice_prunes_partitions(spark, tmp_path):
    from ledgerlens.sources.invoices import month_slice

    path = str(tmp_path / "inv")
    star_tables.invoices(spark, SF_DIR).write.partitionBy("partition_month").parquet(path)
    schema = "partition_month string, invoice_id string, sale double"
    text = plan(month_slice(spark.read.schema(schema).parquet(path), inputs.RUN_DATE).select("sale"))
    assert "PartitionFilters: [isnotnull(partition_month" in text and "199712" in text


def test_feature_groups_share_one_layout(spark, tmp_path):
    grain_path, partner_path = str(tmp_path / "g"), str(tmp_path / "p")
    inputs.day_grain(spark, SF_DIR).write.parquet(grain_path)
    inputs.partners(spark, SF_DIR).write.parquet(partner_path)
    table = seller_features.direct_features(
        inputs.dates.trailing_frame(
            grains.daily_sellers(spark.read.parquet(grain_path)).repartition("mst_seller"),
            "report_date",
            [inputs.LAST_DAY],
        )
    )
    assert plan(table).count("Exchange hashpartitioning") == 1


def test_a_bucketed_grain_needs_no_exchange(spark):
    """Windows, ranks, monthly roll-up and both wide aggregates work in the files' layout."""
    days = bucketed(inputs.day_grain(spark, SF_DIR), "plan_days", "mst_seller", ["mst_seller", "report_date"])
    daily = grains.daily_sellers(days)
    direct = seller_features.pack_direct(inputs.dates.trailing_frame(daily, "report_date", [inputs.LAST_DAY]))
    monthly = seller_features.pack_monthly(inputs.dates.trailing_frame(grains.month_grain(daily), "report_date", [inputs.LAST_DAY]))
    for made in (direct, monthly, grains.silent_days(days)):
        assert "Exchange" not in plan(made) and made.count() > 0


def test_one_ranking_of_partners(spark):
    partners = materialize(inputs.partners(spark, SF_DIR), "plan-partners")
    text = plan(grains.partner_extremes(partners))
    assert text.count("FileScan") == 2 and text.count("Window [") == 1 and "WindowGroupLimit" in text


def test_spread_join_is_the_plain_join(spark):
    big = spark.range(2000).select((F.col("id") % 7).alias("k"), "id").withColumn("k", F.when(F.col("id") % 3 != 0, F.col("k")).otherwise(0))
    small = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        salted = spread_join(big, small, ["k"], ["id"], how, rows_per_task=100)
        want = big.join(small, ["k"], how)
        assert sorted(map(str, salted.collect())) == sorted(map(str, want.collect()))
    assert {r["k"]: r["_parts"] for r in heavy_keys(big, ["k"], 500).collect()} == {0: 2}


def test_only_heavy_keys_are_copied(spark):
    """The spread of a key follows its count; light keys stay single."""
    big = spark.range(4000).select(F.when(F.col("id") % 4 != 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    small = big.select("k").distinct().withColumn("v", F.lit(1))
    copies = small.join(heavy_keys(big, ["k"], 100), "k", "left").select(F.coalesce("_parts", F.lit(1)).alias("n"))
    assert copies.agg(F.sum("n")).first()[0] == small.count() - 1 + 30
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        joined = spread_join(big, small, ["k"], ["id"], "inner", rows_per_task=100)
        tasks = joined.filter("k = -1").select(F.spark_partition_id()).distinct().count()
        assert joined.count() == 4000 and tasks > 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("name", ["agg_argmax_ties", "agg_argmax_ties_frequent", "agg_argmin_ties", "agg_discount_top_buyers"])
def test_tied_rows_stay_where_they_are(spark, name):
    """No window, and what is broadcast is the one extreme."""
    text = plan(queries()[name](spark, SF_DIR))
    assert "Window" not in text and "BroadcastHashJoin" in text


def test_modes_do_not_sort(spark):
    assert "SortAggregate" not in plan(queries()["agg_attribute_mode"](spark, SF_DIR))


@pytest.mark.parametrize(
    "name, scans",
    [("related_pairs", 3), ("related_detail_text", 3), ("pair_generation", 3), ("revenue_links", 5), ("join_adjusted_sales", 2), ("agg_daily_seller", 2)],
)
def test_tables_are_read_once(spark, name, scans):
    assert plan(queries()[name](spark, SF_DIR)).count("FileScan") <= scans


def test_a_dominant_key_is_spread(spark):
    """A third of all rows correct one original; no task may get them all."""
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("invoice_id"),
        F.lit("s").alias("seller"),
        F.lit("b").alias("buyer"),
        F.lit("1").alias("partition_month"),
        F.when(F.col("id") % 3 == 1, "0").alias("original_invoice"),
        F.when(F.col("id") % 3 == 1, "9").otherwise("1").alias("adjust_type"),
        F.lit(1.0).alias("with_vat_foreign"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        adjusted = joins.adjusted_amount(rows, rows, rows_per_task=100)
        sizes = [r["count"] for r in adjusted.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 3000 and max(sizes) < 1000
        assert adjusted.agg(F.sum("adjusted_sale")).first()[0] == 4000.0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
