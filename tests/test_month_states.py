"""Windows merged from month states equal windows over the days themselves."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.functions.aggregates import over_windows
from ledgerlens.operators import month_states

LAST = dt.date(2024, 12, 31)
FUNCTIONS = ["sum", "avg", "min", "max", "std", "kurt", "skew", "count", "countDistinct", "med", "pct25", "pct75"]
RANKS = ["pct5", "pct10", "pct25", "med", "pct75", "pct90", "pct95"]


def days(spark, rows):
    return spark.createDataFrame(rows, "k string, day date, v double")


def mixed():
    draw = random.Random(6)
    rows = [("one", dt.date(2024, 12, 5), 7.0), ("none", dt.date(2024, 12, 6), None), ("none", dt.date(2024, 11, 6), None)]
    for n in range(365):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=n)
        rows += [("ties", day, float(n % 3)), ("same", day, 1e6 + 0.1), ("big", day, 1e9 + draw.random())]
        if draw.random() < 0.2:
            rows.append(("few", day, draw.choice([-5.0, 0.0, -0.0, 3.5, None])))
    rows += [("old", dt.date(2023, 12, 31), 5.0), ("half", dt.date(2024, 5, 1), 2.0), ("half", dt.date(2024, 8, 1), 4.0)]
    return rows


def same(got, want, columns):
    for column in columns:
        a, b = got[column], want[column]
        if a is None or b is None:
            assert a == b, column
        else:
            np.testing.assert_allclose(float(a), float(b), rtol=1e-6, atol=1e-6, err_msg=column)


@pytest.mark.parametrize("exact", [False, True])
def test_windows_equal_direct_aggregates(spark, exact):
    functions = [*FUNCTIONS[:-3], *RANKS] if exact else FUNCTIONS
    frame = days(spark, mixed())
    states = month_states.month_states(month_states.with_gap(frame, ["k"], "day"), ["k"], "day", ["v", "days_gap"], runs=["v"])
    merged = month_states.window_states(states, ["k"], [LAST])
    got = {r["k"]: r for r in merged.selectExpr("k", *month_states.unpack_states({"v": functions}, exact=exact)).collect()}
    first = dates.month_start(LAST, 11)
    conditions = dates.since_conditions("day", dates.trailing_starts(LAST))
    direct = frame.filter(dates.within("day", first, LAST)).groupBy("k").agg(*over_windows(["v"], functions, conditions, exact))
    want = {r["k"]: r for r in direct.collect()}
    assert set(got) == set(want) and "old" not in got
    for key, row in got.items():
        # The direct moments of large values that hardly differ, or not at all, are rounding.
        shaky = ("kurt", "skew") if key in ("big", "same") else ()
        same(row, want[key], [c for c in row.asDict() if c != "k" and c.split("_")[1] not in shaky])
    # Values of which each is alike have no spread at all, however large they are.
    assert got["same"]["v_std_l12m"] == 0.0 and got["same"]["v_skew_l12m"] is None and got["one"]["v_std_l12m"] is None


def test_gaps_reach_over_months(spark):
    rows = [("a", d, 1.0) for d in (dt.date(2024, 1, 30), dt.date(2024, 3, 2), dt.date(2024, 3, 5), dt.date(2024, 12, 1))]
    states = month_states.month_states(month_states.with_gap(days(spark, rows), ["k"], "day"), ["k"], "day", ["days_gap"])
    found = month_states.window_states(states, ["k"], [LAST, dt.date(2024, 11, 30)])
    columns = month_states.unpack_states({"days_gap": ["sum", "count", "max"]}, whole=["days_gap"])
    got = {str(r["as_of"]): r for r in found.selectExpr("as_of", *columns).collect()}
    year = got["2024-12-31"]
    assert (year["days_gap_sum_l12m"], year["days_gap_count_l12m"], year["days_gap_max_l1m"]) == (32 + 3 + 271, 3, 271)
    assert got["2024-11-30"]["days_gap_sum_l12m"] == 35 and got["2024-11-30"]["days_gap_sum_l1m"] is None


def test_a_state_is_bounded_by_the_calendar(spark):
    states = month_states.month_states(days(spark, mixed()), ["k"], "day", ["v"], runs=["v"], best=["v"])
    sizes = states.select(F.size("runs").alias("r"), F.size("best").alias("b")).agg(F.max("r"), F.max("b")).first()
    assert sizes[0] <= 31 and sizes[1] == month_states.BEST


def test_unknown_statistic():
    with pytest.raises(ValueError, match="mode"):
        month_states.statistic("s", "mode")
