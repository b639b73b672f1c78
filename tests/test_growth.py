"""What a step holds or moves must not grow faster than what it is asked for."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.checks import inputs, state_queries
from ledgerlens.checks.registry import QUERIES
from ledgerlens.operators import joins, month_states
from ledgerlens.plans import buyer_sets, grains, related, seller_features
from ledgerlens.sources import store
from ledgerlens.sources.store import bucketed, materialize

SF_DIR = "/root/testdata/sf0.001"


def test_states_are_made_of_merged_months_alone(spark, monkeypatch):
    seen = []
    made = seller_features.states_of_days
    monkeypatch.setattr(seller_features, "states_of_days", lambda days: seen.append(days) or made(days))
    state_queries._wide(spark, SF_DIR, [inputs.RUN_DATE])
    first, last = seen[0].agg(F.min("report_date"), F.max("report_date")).first()
    assert dt.date(1997, 1, 1) <= first and last <= dt.date(1997, 12, 31)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_are_made_and_merged_where_they_lie(spark):
    """A bitmap in the making is a page of 4 KB: none is shuffled."""
    rows = inputs.typed(spark, SF_DIR).filter("counts")
    sets = buyer_sets.day_sets(rows, "mst_seller", "mst_buyer", "report_date")
    assert plan(buyer_sets.month_sets(sets, "mst_seller", "report_date", laid_out=True)).count("Exchange") == 1
    stored = materialize(sets, "growth-sets")
    merged = plan(buyer_sets.month_sets(stored, "mst_seller", "report_date"))
    assert merged.count("Exchange") == 1 and "REPARTITION_BY_COL" in merged
    with_dictionary = buyer_sets.day_sets(rows, "mst_seller", "mst_buyer", "report_date", buyer_sets.numbered(rows, "mst_seller", "mst_buyer"))
    count = lambda df: sorted(map(tuple, buyer_sets.counts(df, ["mst_seller", "report_date"], "n").collect()))
    assert count(sets) == count(with_dictionary)


def test_partners_are_not_repeated_for_their_rankings(spark):
    partners = spark.createDataFrame(
        [("s", b, dt.date(2024, 1, 1), float(n), n, 1.0, n, float(n) if n else None, 2.0 if n else None) for b, n in (("b", 2), ("a", 2), ("c", 1), ("d", 0), ("e", 3))]
        + [("t", "x", dt.date(2024, 1, 1), -5.0, 1, None, 0, None, None)],
        "mst_seller string, mst_buyer string, month_start date, buyer_monthly_sales double, buyer_monthly_invoice_count long,"
        " buyer_monthly_discount double, inv_cnt long, sales_amt double, disc_amt double",
    )
    found = grains.partner_extremes(partners)
    assert "Generate" not in plan(found)
    rows = {r["mst_seller"]: r for r in found.collect()}
    s, t = rows["s"], rows["t"]
    assert (s["inv_cnt_freq_buyer_taxcode"], s["sales_amt_most_freq_buyer_taxcode"], s["inv_cnt_least_freq_buyer_taxcode"]) == (3, 3.0, 1)
    assert [s[f"sales_amt_top{k}_big_buyer_taxcode"] for k in (1, 2, 3)] == [3.0, 5.0, 7.0] and s["monthly_distinct_buyer_count"] == 5
    assert t["inv_cnt_freq_buyer_taxcode"] is None and t["sales_amt_top3_big_buyer_taxcode"] is None and t["monthly_total_sales_buyer_taxcode"] == -5.0


def test_raw_months_read_typed_rows_that_are_written(spark):
    text = plan(QUERIES["raw_monthly_features"](spark, SF_DIR))
    assert "lineitem.parquet" not in text and "o_orderkey" not in text


def test_contacts_are_taken_from_cards_once_and_by_many_tasks(spark):
    text = plan(inputs.contacts(spark, SF_DIR))
    assert "REPARTITION_BY_COL" in text.split("Generate", 1)[1]
    found = QUERIES["join_entities_on_value"](spark, SF_DIR)
    assert "Generate" not in plan(found) and "customer.parquet" not in plan(found)


def written(monkeypatch, module):
    names, made = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: names.append(name) or made(df, name))
    return names


def test_what_first_parties_hold_is_written_for_heavy_parties_alone(spark, monkeypatch):
    pairs = spark.createDataFrame([("a", "h"), ("b", "h"), ("c", "h"), ("a", "c")], "a string, b string")
    contacts = spark.createDataFrame([(e, "r", v) for e, v in (("a", "1"), ("b", "1"), ("h", "1"), ("c", "2"), ("h", "2"), ("a", "2"))], "entity string, rel string, val string")
    want = [("a", "c", "r", "2"), ("a", "h", "r", "1"), ("a", "h", "r", "2"), ("b", "h", "r", "1"), ("c", "h", "r", "2")]
    names = written(monkeypatch, related)
    assert sorted(map(tuple, related.evidence(pairs, contacts).collect())) == want and names == ["pairs", "contacts"]
    known = related.known_heavy
    monkeypatch.setattr(related, "known_heavy", lambda df, on, *_: known(df, on, 1))
    assert sorted(map(tuple, related.evidence(pairs, contacts).collect())) == want and "held" in names


def test_densify_makes_its_input_once(spark, monkeypatch):
    names = written(monkeypatch, joins)
    found = QUERIES["densify_cross"](spark, SF_DIR)
    assert names == ["dense"] and "lineitem.parquet" not in plan(found)


def test_grains_are_written_slice_by_slice_and_rows_go(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(store, "shared_folder", lambda spark: str(tmp_path))
    used, made = [], grains.day_grain
    monkeypatch.setattr(grains, "day_grain", lambda rows: used.append(rows.count()) or made(rows))
    typed = inputs.typed(spark, SF_DIR)
    found = {}
    for size in (1 << 40, 50_000):
        monkeypatch.setattr(store, "BYTES_PER_SLICE", size)
        used.clear()
        found[size] = [sorted(map(str, df.collect())) for df in seller_features.written_grains(typed)]
        assert (len(used) == 1) == (size == 1 << 40) and len(used) <= store.MOST_SLICES and sum(used) == typed.count()
        assert sorted({f.name.split("-")[0] for f in tmp_path.iterdir()}) == ["days", "partners"]
    assert found[50_000] == found[1 << 40] and all(found[50_000])
    none = seller_features.written_grains(typed.filter("mst_seller = 'nobody'"))
    assert [df.count() for df in none] == [0, 0]


def test_windows_are_merged_and_laid_side_by_side_where_states_lie(spark):
    days = bucketed(inputs.day_grain(spark, SF_DIR), "growth_days", "mst_seller", ["mst_seller", "report_date"])
    states = bucketed(seller_features.states_of_days(days), "growth_states", "mst_seller", ["mst_seller", "report_date", "metric"])
    months = grains.month_grain(grains.daily_sellers(days))
    last_days = [inputs.LAST_DAY, dt.date(1997, 11, 30)]
    windows = month_states.window_states(states, ["mst_seller"], last_days)
    beside = seller_features._beside(windows, seller_features.pack_monthly(inputs.dates.trailing_frame(months, "report_date", last_days)))
    assert "Exchange" not in plan(windows) and "Exchange hashpartitioning" not in plan(beside)
    rows = [(r.as_of, r.mst_seller, r.monthly is None) for r in beside.select("as_of", "mst_seller", "monthly").collect()]
    assert len(rows) == len(set(rows)) == windows.count() > 0 and not any(r[2] for r in rows)
