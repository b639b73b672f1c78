"""Edge cases on small frames: nulls, ties, single rows, negative totals, empty input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import aggregates, dates, scalars
from ledgerlens.operators import joins, trailing, windows
from ledgerlens.plans import balances, buyer_profile, concentration, grains, night, sales_reports, seller_features
from ledgerlens.sources import invoices as inv
from ledgerlens.sources.schema import NAMED_LAYOUT, POSITIONAL_LAYOUT, to_logical

DAY = dt.date


def one(df):
    return df.first().asDict()


def test_run_date_arithmetic():
    assert dates.last_closed_day(DAY(2025, 3, 15)) == DAY(2025, 2, 28)
    assert dates.closed_month_key(DAY(2025, 1, 1)) == "202412"
    assert dates.month_start(DAY(2025, 2, 28), 11) == DAY(2024, 3, 1)
    assert dates.trailing_starts(DAY(2024, 12, 31)) == {
        "l1m": DAY(2024, 12, 1),
        "l3m": DAY(2024, 10, 1),
        "l6m": DAY(2024, 7, 1),
        "l12m": DAY(2024, 1, 1),
    }
    assert dates.month_anchor_weeks(DAY(2024, 12, 31), 1) == DAY(2024, 11, 24)


def test_month_slice(spark):
    df = spark.createDataFrame([("202411",), ("202412",), ("202501",), (None,)], "partition_month string")
    assert [r[0] for r in inv.month_slice(df, DAY(2025, 1, 15)).collect()] == ["202412"]


def test_hours_wrap_midnight(spark):
    hours = spark.range(24).select("id", scalars.in_hours(F.col("id"), 22, 6).alias("n"))
    assert {r.id for r in hours.collect() if r.n} == {22, 23, 0, 1, 2, 3, 4, 5}
    core = spark.range(24).select("id", scalars.in_hours(F.col("id"), 0, 4).alias("n"))
    assert {r.id for r in core.collect() if r.n} == {0, 1, 2, 3}


@pytest.mark.parametrize(
    ("tax", "sales", "discount", "band"),
    [
        (10.0, 90.0, 0.0, "10%"),
        (8.0, 82.0, 10.0, "8%"),
        (5.0, 95.0, 0.0, "5%"),
        (0.0, 95.0, 0.0, "0%"),
        (7.0, 93.0, 0.0, "others"),
        (10.0, 90.0, None, "others"),
        (0.0, 0.0, 0.0, "others"),
    ],
)
def test_tax_band(spark, tax, sales, discount, band):
    df = spark.createDataFrame([(tax, sales, discount)], "t double, s double, d double")
    found = df.select(scalars.tax_band(scalars.tax_percent(F.col("t"), F.col("s"), F.col("d"))).alias("b"))
    assert found.first().b == band


def test_ratio_guard(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0), (1.0, 2.0), (1.0, None)], "a double, b double")
    zero = [r[0] for r in df.select(scalars.ratio(F.col("a"), F.col("b"))).collect()]
    none = [r[0] for r in df.select(scalars.ratio(F.col("a"), F.col("b"), None)).collect()]
    assert zero == [0.0, 0.0, 0.5, 0.0]
    assert none == [None, None, 0.5, None]


INVOICE = "status string, signed_ts string, error_code string, adjust_type string, seller string, buyer string, sale string, tax string, discount string, payment string"


def raw_invoices(spark, rows):
    df = spark.createDataFrame(rows, INVOICE)
    physical = {NAMED_LAYOUT[c]: F.col(c) for c in df.columns}
    return to_logical(df.select(*[e.alias(n) for n, e in physical.items()]))


OK_CODE = "TAX_CODE_APPROVED"


def test_daily_table_counts_only_approved_invoices(spark):
    rows = [
        ("1", "2024-12-01 23:30:00", OK_CODE, "1", " s ", "b1", "90", "10", "0", "cash"),
        ("1", "2024-12-01 03:00:00", OK_CODE, "7", "s", None, "-30", "x", None, None),
        ("1", "2024-12-01 03:00:00", "CODE_APPROVED", "1", "s", "b2", "500", "0", "0", "card"),
        ("1", "2024-12-01 03:00:00", OK_CODE, "5", "s", "b3", "500", "0", "0", "card"),
        ("0", "2024-12-01 03:00:00", OK_CODE, "1", "s", "b4", "500", "0", "0", "card"),
        ("bad", "2024-12-02 03:00:00", OK_CODE, "1", "s", "b4", "700", "0", "0", "card"),
        ("1", "not a time", OK_CODE, "1", "s", "b5", "500", "0", "0", "card"),
        ("1", "2024-12-01 03:00:00", OK_CODE, "1", None, "b5", "500", "0", "0", "card"),
    ]
    typed = inv.analysis_rows(raw_invoices(spark, rows))
    grain = grains.day_grain(typed)
    daily = grains.daily_sellers(grain).collect()
    assert len(daily) == 1
    d = daily[0]
    assert (d.mst_seller, d.report_date) == ("s", DAY(2024, 12, 1))
    assert (d.daily_total_sales, d.daily_invoice_count, d.daily_buyer_count) == (60.0, 2, 1)
    assert (d.daily_night_invoice_count, d.daily_core_invoice_count) == (2, 1)
    assert (d.daily_invoice_count_tax10, d.daily_invoice_count_taxOthers) == (1, 1)
    assert (d.daily_total_sales_tax10, d.daily_total_sales_taxOthers) == (90.0, -30.0)
    assert (d.daily_distinct_payment_methods, d.daily_distinct_transport) == (1, 0)
    assert d.daily_sales_per_buyer == 60.0 and d.daily_night_ratio == 1.0
    # unfiltered side: the uncounted day is known to the gap features
    gaps = {r.report_date: r for r in grains.silent_days(grain).collect()}
    assert gaps[DAY(2024, 12, 31)].day_cnt_no_sales == 1
    assert gaps[DAY(2024, 12, 31)].monthly_sales_amt_highest_inv == 700.0


def test_single_invoice_day_has_no_deviation(spark):
    rows = [("1", "2024-12-01 12:00:00", OK_CODE, "1", "s", "b", "5", "0", "0", "cash")]
    d = grains.daily_sellers(grains.day_grain(inv.analysis_rows(raw_invoices(spark, rows)))).first()
    assert d.daily_std_invoice_value is None and d.daily_avg_invoice_value == 5.0


def test_empty_input_everywhere(spark):
    typed = inv.analysis_rows(raw_invoices(spark, [("1",) + ("",) * 9]).filter("false"))
    table = seller_features.seller_features(
        grains.day_grain(typed), grains.partner_month(typed), [DAY(2025, 1, 1)]
    )
    assert len(table.columns) == 969
    assert table.count() == 0


def test_layouts_name_the_same_columns():
    assert set(POSITIONAL_LAYOUT) <= set(NAMED_LAYOUT)


def adjusted(spark, rows, **codes):
    schema = "invoice_id string, seller string, buyer string, partition_month string, original_invoice string, adjust_type string, with_vat_foreign string"
    df = spark.createDataFrame(rows, schema)
    return {r.invoice_id: r.adjusted_sale for r in joins.adjusted_amount(df, df, **codes).collect()}


def test_adjusted_amount(spark):
    rows = [
        ("a", "s", "b", "1", None, "1", "100"),
        ("b", "s", "b", "1", "a", "9", "-30"),
        ("c", "s", "b", "1", "a", "3", "80"),
        ("d", "s", "b", "2", "a", "9", "5"),
        ("e", "s", "b", "1", "missing", "3", "80"),
        ("f", "s", "b", "1", None, "9", "7"),
        ("g", "s", "b", "1", "a", "x", None),
        ("h", "s", "b", None, "a", "9", "1"),
    ]
    assert adjusted(spark, rows) == {
        "a": 100.0, "b": 70.0, "c": 100.0, "d": 5.0, "e": 0.0, "f": 7.0, "g": 0.0, "h": 1.0,
    }


def test_adjusted_amount_does_not_multiply_rows(spark):
    rows = [("a", "s", "b", "1", None, "1", "100")] * 2 + [("b", "s", "b", "1", "a", "9", "1")]
    df = spark.createDataFrame(
        rows,
        "invoice_id string, seller string, buyer string, partition_month string, original_invoice string, adjust_type string, with_vat_foreign string",
    )
    assert joins.adjusted_amount(df, df).count() == 3


def test_unknown_aggregate_is_an_error():
    with pytest.raises(ValueError, match="mode"):
        aggregates.aggregate(F.col("x"), "mode")


def test_windows_match_conditional_aggregates(spark):
    rows = [(DAY(2024, m, d), float(m * d), "s" if d % 2 else "t") for m in range(1, 13) for d in (1, 2, 9, 28)]
    df = spark.createDataFrame(rows, "report_date date, v double, k string")
    framed = dates.trailing_frame(df, "report_date", [DAY(2024, 12, 31)])
    functions = ["sum", "avg", "min", "max", "std", "kurt", "skew", "count", "countDistinct", "med"]
    packed = trailing.pack(framed, ["k"], trailing.statistics({"v": functions}), "w")
    wide = packed.selectExpr("k", *trailing.unpack("w", [f"v_{f}" for f in functions]))
    starts = dates.trailing_starts(DAY(2024, 12, 31))
    plain = df.groupBy("k").agg(
        *aggregates.over_windows(["v"], functions, dates.since_conditions("report_date", starts))
    )
    got = {r.k: r.asDict() for r in wide.collect()}
    for want in plain.collect():
        for name, value in want.asDict().items():
            assert got[want.k][name] == pytest.approx(value) if isinstance(value, float) else value == got[want.k][name]


def test_trailing_frame_serves_several_report_dates(spark):
    ends = [DAY(2024, 11, 30), DAY(2024, 12, 31)]
    rows = [(DAY(2023, 12, 1),), (DAY(2024, 1, 5),), (DAY(2024, 12, 1),), (DAY(2025, 1, 1),), (DAY(2023, 11, 30),)]
    df = spark.createDataFrame(rows, "d date")
    both = {(r.d, r.as_of, r.months_back) for r in dates.trailing_frame(df, "d", ends).collect()}
    each = {(r.d, r.as_of, r.months_back) for e in ends for r in dates.trailing_frame(df, "d", [e]).collect()}
    assert both == each and len(both) == 4


def test_month_change_against_previous_present_month(spark):
    rows = [("s", DAY(2024, 1, 31), 0.0, 2), ("s", DAY(2024, 3, 31), 50.0, 3), ("s", DAY(2024, 4, 30), 75.0, 6)]
    df = spark.createDataFrame(rows, "mst_seller string, report_date date, monthly_total_sales double, monthly_invoice_count long")
    found = {r.report_date.month: r for r in grains.with_monthly_change(df).collect()}
    assert found[1].sales_amt_perc_change is None
    assert found[3].sales_amt_perc_change is None and found[3].invoice_cnt_perc_change_self == 50.0
    assert found[4].sales_amt_perc_change == 50.0 and found[4].invoice_cnt_perc_change_self == 100.0


def test_frequent_buyer_ties_go_to_the_smaller_id(spark):
    rows = [
        ("1", f"2024-12-0{d} 10:00:00", OK_CODE, "1", "s", b, v, "0", "1", "p")
        for d, b, v in [(1, "b2", "5"), (2, "b1", "7"), (3, "b3", "-9"), (4, None, "99"), (5, "b4", "1"), (6, "b4", "1")]
    ]
    r = grains.partner_extremes(grains.partner_month(inv.analysis_rows(raw_invoices(spark, rows)))).first()
    assert r.monthly_distinct_buyer_count == 4
    assert (r.inv_cnt_freq_buyer_taxcode, r.sales_amt_most_freq_buyer_taxcode) == (2, 2.0)
    assert (r.inv_cnt_least_freq_buyer_taxcode, r.sales_amt_least_freq_buyer_taxcode) == (1, 7.0)
    assert (r.sales_amt_top1_big_buyer_taxcode, r.sales_amt_top3_big_buyer_taxcode) == (7.0, 14.0)
    assert r.monthly_total_sales_buyer_taxcode == 5.0 and r.monthly_sales_amt == 14.0


def test_densify(spark):
    df = spark.createDataFrame([("a", DAY(2024, 1, 1), 5.0), ("b", DAY(2024, 1, 2), None)], "k string, d date, v double")
    rows = {(r.k, r.d.day): r.v for r in joins.densify(df, ["k", "d"]).collect()}
    assert rows == {("a", 1): 5.0, ("a", 2): 0.0, ("b", 1): 0.0, ("b", 2): 0.0}
    who = spark.createDataFrame([("z",), ("a",)], "k string")
    rows = {(r.k, r.d.day): r.v for r in joins.densify(df, ["k", "d"], entities=who).collect()}
    assert rows == {("a", 1): 5.0, ("a", 2): 0.0, ("z", 1): 0.0, ("z", 2): 0.0}
    with pytest.raises(TypeError, match="only dates"):
        joins.densify(df, ["d", "k"])


def test_a_repeated_calendar_date_is_one_date(spark):
    days = [(DAY(2024, 1, 1), False), (DAY(2024, 1, 2), True), (DAY(2024, 1, 2), True), (DAY(2024, 1, 3), True), (DAY(2024, 1, 3), False)]
    frame = spark.createDataFrame(days, "date_code date, off_date boolean")
    got = [(r.date_code.day, r.latest.day) for r in joins.latest_business_day(frame).collect()]
    assert sorted(got) == [(1, 1), (2, 1), (3, 3)]


def test_merging_reports_a_repeated_key(spark):
    one = spark.createDataFrame([("a", 1.0)], "k string, x double")
    two = spark.createDataFrame([("a", 2.0), ("b", None)], "k string, y double")
    assert sorted(map(tuple, joins.merge_on_key([one, two], ["k"]).collect())) == [("a", 1.0, 2.0), ("b", None, None)]
    with pytest.raises(Exception, match="held twice"):
        joins.merge_on_key([one.union(one), two], ["k"]).collect()


def test_extremes_of_fractional_sums(spark):
    rows = spark.createDataFrame([(k, 0.1 * (i % 7) + 0.01) for i in range(700) for k in ("a", "b")], "k string, v double")
    best = windows.at_extreme(rows.repartition(5).groupBy("k").agg(F.sum("v").alias("v")), "v").collect()
    assert len(best) >= 1
    some = spark.createDataFrame([("a", 1.5), ("b", None), ("c", 1.5), ("d", 3.25)], "k string, v double")
    assert {r.k for r in windows.at_extreme(some, "v").collect()} == {"d"}
    assert {r.k for r in windows.at_extreme(some, "v", largest=False).collect()} == {"a", "c"}


def test_days_without_per_key(spark):
    rows = spark.createDataFrame([("a", DAY(2024, 1, 1)), ("a", DAY(2024, 1, 4)), ("b", DAY(2024, 1, 2)), (None, None)], "k string, d date")
    got = sorted((r.k, r.d.day) for r in joins.days_without(rows, "d", ["k"]).collect())
    assert got == [("a", 2), ("a", 3)]


def test_days_without_and_gaps(spark):
    df = spark.createDataFrame([(DAY(2024, 1, d), b) for d, b in [(1, "x"), (4, "x"), (4, "y"), (5, None)]], "day date, buyer string")
    assert {r.day.day for r in joins.days_without(df, "day").collect()} == {2, 3}
    assert windows.largest_gap(df, "day").first().max_days_gap == 3
    assert {r.buyer: r.max_days_gap for r in windows.largest_gap(df, "day", ["buyer"]).collect()} == {
        "x": 3, "y": None, None: None,
    }
    assert joins.days_without(df.filter("false"), "day").count() == 0


def sales(spark):
    rows = [
        ("s", DAY(2024, 1, 1), 10.0, "b1", 1.0),
        ("s", DAY(2024, 1, 2), 20.0, "b1", None),
        ("t", DAY(2024, 2, 1), 30.0, "b2", 2.0),
        ("t", DAY(2024, 2, 9), 0.0, "b2", 2.0),
        ("t", DAY(2024, 2, 9), -5.0, "b3", 3.0),
        ("t", DAY(2024, 3, 9), 5.0, None, 3.0),
    ]
    return spark.createDataFrame(rows, "seller string, day date, sales double, buyer string, discount double")


def test_sales_questions(spark):
    rows = sales(spark)
    assert {(r.month, r.total_sales) for r in sales_reports.months_with_most_sales(rows).collect()} == {(1, 30.0)}
    assert {r.buyer for r in sales_reports.most_frequent_buyers(rows).collect()} == {"b1", "b2"}
    assert {(r.month, r.num_buyers) for r in sales_reports.months_with_most_buyers(rows).collect()} == {(2, 2)}
    assert one(sales_reports.transactions_of_least_frequent_buyers(rows)) == {"num_transactions": 1}
    assert {r.buyer: r.total_discount for r in sales_reports.discount_of_most_frequent_buyers(rows).collect()} == {
        "b1": 1.0,
        "b2": 4.0,
    }
    assert one(sales_reports.sales_with_top_buyers(rows)) == {"total_sales_with_top3_buyers": 60.0}
    assert one(sales_reports.days_without_sales(rows)) == {"num_days_without_sales": 64}
    assert one(sales_reports.longest_gap(rows)) == {"max_days_gap": 30}


def test_buyer_profile(spark):
    schema = "invoice_id string, partition_month string, seller string, buyer string, status string, adjust_status string, original_invoice string, with_vat_foreign double, settlement_discount double, buyer_name string, items string, transport string, payment string, buyer_address string"
    rows = [
        ("1", "p", "s", " b ", "1", "1", None, 10.0, 1.0, "n", "i", "road", "card", "x"),
        ("2", "p", "s", "b", "1", "2", "1", 5.0, None, "n", "j", "rail", "card", None),
        ("3", "p", "s", "b", "1", "3", "1", 99.0, 2.0, "m", "j", "rail", "cash", None),
        ("4", "p", "s", "b", "2", "1", None, 1000.0, 2.0, "m", "j", "sea", "cash", None),
    ]
    r = buyer_profile.buyer_profile(spark.createDataFrame(rows, schema)).first()
    assert (r.total_sales, r.number_of_buyer, r.number_of_invoice, r.number_of_sold_item) == (35.0, 2, 3, 2)
    assert (r.most_freq_transport, r.count_transport) == ("rail", 2)
    assert (r.most_freq_payment, r.most_freq_buyer_address, r.count_buyer_address) == ("card", "x", 1)
    assert r.discount_per_sales == pytest.approx(3 / 35)


def concentrated(spark, amounts, **options):
    rows = [("c", f"2024-01-{d:02d} 10:00:00", a) for d, a in amounts]
    df = spark.createDataFrame(rows, "ID_KH string, invoice_date string, amount double")
    return one(concentration.revenue_concentration(df, **options))


def test_revenue_concentration(spark):
    r = concentrated(spark, [(1, 50.0), (2, 10.0), (3, 30.0), (4, 10.0), (4, None)])
    assert (r["days_needed_for_threshold"], r["selected_days"], r["covered_pct"]) == (2, [1, 3], 0.8)
    assert (r["total_days_in_month_in_data"], r["share_of_days"], r["net_month_total"]) == (4, 0.5, 100.0)


def test_revenue_concentration_of_a_negative_month(spark):
    r = concentrated(spark, [(1, 50.0), (2, -80.0)])
    assert (r["days_needed_for_threshold"], r["selected_days"], r["covered_pct"], r["share_of_days"]) == (None,) * 4
    assert r["net_month_total"] == -30.0


def test_revenue_concentration_of_positive_days(spark):
    r = concentrated(spark, [(1, 50.0), (2, -80.0), (3, 50.0)], positive_only=True)
    assert (r["net_month_total"], r["month_total"], r["days_needed_for_threshold"]) == (20.0, 100.0, 2)
    assert r["total_days_in_month_in_data"] == 3


def test_night_report(spark):
    rows = []
    for month in (1, 2):
        rows += [(f"2024-0{month}-05 23:00:00", "n")] * 3 + [(f"2024-0{month}-05 12:00:00", "n")] * 1
    rows += [("2024-01-05 12:00:00", "d")] * 9 + [("2022-01-05 23:00:00", "old")]
    df = spark.createDataFrame(rows, "record_ts string, seller string")
    rule = night.NightRule(min_invoices_per_day=4.0, min_night_ratio=0.75)
    verdict, months = night.night_sales(df, now="2024-03-01 00:00:00", rule=rule)
    found = {r.issuer: r for r in verdict.collect()}
    assert set(found) == {"n", "d"}
    assert found["n"].is_flagged and found["n"].qualified_months == ["2024-01", "2024-02"]
    assert found["n"].notes == "2 tháng đạt: TB>= 4 HĐ/ngày & TB>= 75 % HĐ ban đêm"
    assert not found["d"].is_flagged and found["d"].qualified_months == []
    assert months.count() == 3
    calendar, _ = night.night_sales(df, now="2024-03-01 00:00:00", calendar_days=True, rule=rule)
    assert not any(r.is_flagged for r in calendar.collect())
    none, detail = night.night_sales(df.filter("false"))
    assert none.columns == verdict.columns and none.count() == 0 and detail.count() == 0


def test_business_days_look_back_over_a_long_holiday(spark):
    days = [(DAY(2024, 1, 1) + dt.timedelta(days=n), n != 0) for n in range(45)]
    df = spark.createDataFrame(days, "date_code date, off_date boolean")
    found = balances.business_days(df, DAY(2024, 2, 1), DAY(2024, 2, 5)).collect()
    assert len(found) == 5 and {r.latest for r in found} == {DAY(2024, 1, 1)}
    none = balances.business_days(df.filter("off_date"), DAY(2024, 2, 1), DAY(2024, 2, 5))
    assert none.count() == 0


def test_inflow_ratio(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 10.0), (None, 10.0), (5.0, -10.0)], "i double, b double")
    assert [r[0] for r in df.select(balances.inflow_ratio(F.col("i"), F.col("b"))).collect()] == [0.0, 0.5, 0.0, -0.5]
