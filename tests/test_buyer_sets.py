"""Bitmaps count exactly what a distinct count over the rows counts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.plans import buyer_sets

LASTS = [dt.date(2024, 12, 31), dt.date(2024, 10, 31)]


def rows_of(spark, n=4000):
    draw = random.Random(2)
    rows = []
    for _ in range(n):
        seller = draw.choice(["s1", "s1", "s1", "s2", "s3", None])
        day = dt.date(2024, 1, 1) + dt.timedelta(days=draw.randrange(366))
        rows.append((seller, draw.choice([None, f"b{draw.randrange(600)}"]), draw.choice([day, day, day, None])))
    return spark.createDataFrame([*rows, *rows[:50]], "seller string, buyer string, day date")


def expected(frame):
    out = {}
    for r in frame.filter("seller is not null and buyer is not null and day is not null").collect():
        for last in LASTS:
            for window, start in dates.trailing_starts(last).items():
                if start <= r["day"] <= last:
                    out.setdefault((last, r["seller"]), {}).setdefault(window, set()).add(r["buyer"])
    return {k: [len(v.get(w, ())) for w in dates.TRAILING_MONTHS] for k, v in out.items()}


def test_window_counts(spark):
    frame = rows_of(spark)
    days = buyer_sets.day_sets(frame, "seller", "buyer", "day")
    months = buyer_sets.month_sets(days, "seller", "day")
    got = buyer_sets.window_counts(months, "seller", LASTS, "n", "day").collect()
    assert {(r["as_of"], r["seller"]): [r[f"n_{w}"] for w in dates.TRAILING_MONTHS] for r in got} == expected(frame)
    daily = {(r["seller"], r["day"]): r["n"] for r in buyer_sets.counts(days, ["seller", "day"], "n").collect()}
    known = frame.filter("seller is not null and buyer is not null and day is not null")
    assert daily == {(r[0], r[1]): r[2] for r in known.groupBy("seller", "day").agg(F.count_distinct("buyer")).collect()}


def test_no_member_is_read_again_and_rows_are_not_expanded(spark):
    months = buyer_sets.month_sets(buyer_sets.day_sets(rows_of(spark), "seller", "buyer", "day"), "seller", "day")
    text = buyer_sets.window_counts(months, "seller", LASTS, "n", "day")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and "count(distinct" not in text


def test_numbers_stay_when_members_are_added(spark):
    frame = rows_of(spark)
    early, late = frame.filter("day < '2024-06-01'"), frame.filter("day >= '2024-06-01'")
    first = buyer_sets.numbered(early, "seller", "buyer")
    both = buyer_sets.numbered(late, "seller", "buyer", first)
    of = lambda df: {(r["seller"], r["buyer"]): (r["bucket"], r["number"]) for r in df.collect()}
    known, grown = of(first), of(both)
    assert {k: grown[k] for k in known} == known and len({(k[0], *v) for k, v in grown.items()}) == len(grown)
    # Sets of the early months stay valid beside later ones.
    sets = buyer_sets.day_sets(early, "seller", "buyer", "day", first).unionByName(buyer_sets.day_sets(late, "seller", "buyer", "day", both))
    got = buyer_sets.window_counts(buyer_sets.month_sets(sets, "seller", "day"), "seller", LASTS, "n", "day").collect()
    assert {(r["as_of"], r["seller"]): [r[f"n_{w}"] for w in dates.TRAILING_MONTHS] for r in got} == expected(frame)


def test_more_members_than_a_page_holds(spark, monkeypatch):
    monkeypatch.setattr(buyer_sets, "BUCKETS", 1)
    frame = spark.range(70_000).select(F.lit("s").alias("seller"), F.col("id").cast("string").alias("buyer"), F.lit(LASTS[0]).alias("day"))
    days = buyer_sets.day_sets(frame.union(frame.limit(10)), "seller", "buyer", "day")
    assert days.count() == 3 and buyer_sets.counts(days, ["seller"], "n").first()["n"] == 70_000


def test_no_rows(spark):
    days = buyer_sets.day_sets(rows_of(spark).filter("false"), "seller", "buyer", "day")
    assert buyer_sets.window_counts(buyer_sets.month_sets(days, "seller", "day"), "seller", LASTS, "n", "day").count() == 0
