"""Mergeable states of daily measures, one row per entity, month and measure.

A state holds what any trailing window needs from a month: count, sum, central moments,
extremes, the largest values, and the values themselves as sorted (value, count) runs,
which the calendar bounds. A window over 1, 3, 6 or 12 months merges at most twelve states,
so no day is read again when a month is added, and percentiles stay exact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.functions.aggregates import PERCENTILES
from ledgerlens.functions.dates import TRAILING_MONTHS

#: Largest values a state keeps of the measures it keeps them for.
BEST = 10
GAP = "days_gap"

# One statistic of a merged state ``{0}`` as a select expression.
SIMPLE = {
    "sum": "{0}.total",
    "avg": "{0}.mean",
    "min": "{0}.low",
    "max": "{0}.high",
    "count": "coalesce({0}.n, 0L)",
    "std": "IF({0}.n > 1, sqrt({0}.m2 / ({0}.n - 1)), NULL)",
    "skew": "IF({0}.m2 > 0, sqrt({0}.n) * {0}.m3 / power({0}.m2, 1.5D), NULL)",
    "kurt": "IF({0}.m2 > 0, {0}.n * {0}.m4 / ({0}.m2 * {0}.m2) - 3, NULL)",
    "countDistinct": "coalesce(size(array_distinct(transform({0}.runs, r -> r.v))), 0)",
}


def month_states(
    daily: DataFrame,
    keys: Sequence[str],
    date_col: str,
    metrics: Sequence[str],
    runs: Sequence[str] = (),
    best: Sequence[str] = (),
) -> DataFrame:
    """keys, report_date (month end), metric and its state. ``daily`` has a row per key and
    date. Values are kept as runs for the measures in ``runs``, the largest for those in
    ``best``. ``first_day`` and ``last_day`` are those of the rows, whatever the measure."""
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), (F.col(m).cast("double") + 0.0).alias("v")) for m in metrics])
    long = daily.select(*keys, F.col(date_col).alias("_day"), F.explode(entries).alias("e")).select(
        *keys, "_day", F.last_day("_day").alias("report_date"), "e.metric", "e.v"
    )

    def only(names: Sequence[str]) -> str:
        listed = ", ".join(f"'{n}'" for n in names) or "''"
        return f"collect_list(IF(metric IN ({listed}), v, NULL))"

    grouped = long.groupBy(*keys, "report_date", "metric").agg(
        F.count("v").alias("n"),
        F.sum("v").alias("total"),
        F.var_pop("v").alias("var"),
        F.skewness("v").alias("skew"),
        F.kurtosis("v").alias("kurt"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.min("_day").alias("first_day"),
        F.max("_day").alias("last_day"),
        F.expr(f"array_sort({only(runs)})").alias("listed"),
        F.expr(f"slice(sort_array({only(best)}, false), 1, {BEST})").alias("best"),
    )
    spread = grouped.withColumn("m2", F.expr("IF(n = 0 OR low = high, 0D, var * n)"))
    return spread.selectExpr(
        *keys,
        "report_date",
        "metric",
        "n",
        "total",
        "m2",
        "IF(m2 > 0, skew * power(m2, 1.5D) / sqrt(n), 0D) AS m3",
        "IF(m2 > 0, (kurt + 3) * m2 * m2 / n, 0D) AS m4",
        "low",
        "high",
        "first_day",
        "last_day",
        "transform(array_distinct(listed), x -> named_struct('v', x, 'c', CAST(size(filter(listed, y -> y = x)) AS BIGINT))) AS runs",
        "best",
    )


STATE = ("n", "total", "m2", "m3", "m4", "low", "high", "runs", "best")


def with_gap(daily: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Add the days since the previous date of the same key and month."""
    order = Window.partitionBy(*keys, F.last_day(date_col)).orderBy(date_col)
    return daily.withColumn(GAP, F.datediff(F.col(date_col), F.lag(date_col).over(order)))


def with_crossing_gaps(framed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a state of one value for every gap between two present months of a frame. It
    belongs to the later month. ``framed`` holds a row of the gap measure per month. The added
    rows come from the rows beside them, so a layout by key outlasts them."""
    order = Window.partitionBy("as_of", *keys, "metric").orderBy("report_date")
    width = F.datediff(F.col("first_day"), F.lag("last_day").over(order)).cast("double")
    gap = F.col("_gap")
    one = {"n": F.lit(1).cast("long"), "total": gap, "low": gap, "high": gap}
    one |= {m: F.lit(0.0) for m in ("m2", "m3", "m4")}
    one["runs"] = F.array(F.struct(gap.alias("v"), F.lit(1).cast("long").alias("c")))
    own = F.struct(*STATE)
    added = F.struct(*[one.get(m, F.col(m)).alias(m) for m in STATE])
    both = F.when((F.col("metric") == GAP) & gap.isNotNull(), F.array(own, added)).otherwise(F.array(own))
    others = [c for c in framed.columns if c not in STATE]
    found = framed.withColumn("_gap", width).select(*others, F.explode(both).alias("_state"))
    return found.select(*[F.col(f"_state.{c}") if c in STATE else F.col(c) for c in framed.columns])


def merged(framed: DataFrame, keys: Sequence[str], months: Mapping[str, int] = TRAILING_MONTHS) -> DataFrame:
    """as_of, keys, metric and ``stats``: a merged state per window, in the order of
    ``months``. ``framed`` is a trailing frame of states.

    Moments are merged about the common mean, so nothing cancels; equal values have
    exactly no spread. Months are added in their order, not in that of arrival.
    """
    sizes = ", ".join(str(n) for n in months.values())
    parts = framed.groupBy("as_of", *keys, "metric").agg(
        F.array_sort(F.collect_list(F.struct("months_back", *STATE))).alias("parts")
    )
    inside = parts.selectExpr(
        "as_of", *keys, "metric", f"transform(array({sizes}), k -> filter(parts, p -> p.months_back < k AND p.n > 0)) AS parts"
    )
    sums = inside.selectExpr(
        "as_of",
        *keys,
        "metric",
        """transform(parts, q -> named_struct(
            'q', q,
            'n', aggregate(q, 0L, (a, p) -> a + p.n),
            'total', IF(size(q) > 0, aggregate(q, 0D, (a, p) -> a + p.total), NULL),
            'low', array_min(transform(q, p -> p.low)),
            'high', array_max(transform(q, p -> p.high)))) AS sums""",
    )
    centred = sums.selectExpr(
        "as_of",
        *keys,
        "metric",
        """transform(sums, s -> named_struct(
            's', s,
            'mean', IF(s.n > 0, s.total / s.n, NULL),
            'q', transform(s.q, p -> named_struct(
                'n', p.n, 'd', p.total / p.n - s.total / s.n, 'm2', p.m2, 'm3', p.m3, 'm4', p.m4)))) AS centred""",
    )
    return centred.selectExpr(
        "as_of",
        *keys,
        "metric",
        """transform(centred, c -> named_struct(
            'n', c.s.n, 'total', c.s.total, 'mean', c.mean, 'low', c.s.low, 'high', c.s.high,
            'm2', IF(c.s.low = c.s.high, 0D, aggregate(c.q, 0D, (a, p) -> a + p.m2 + p.n * p.d * p.d)),
            'm3', aggregate(c.q, 0D, (a, p) -> a + p.m3 + 3 * p.d * p.m2 + p.n * p.d * p.d * p.d),
            'm4', aggregate(c.q, 0D, (a, p) -> a + p.m4 + 4 * p.d * p.m3 + 6 * p.d * p.d * p.m2 + p.n * p.d * p.d * p.d * p.d),
            'runs', array_sort(flatten(transform(c.s.q, p -> coalesce(p.runs, array())))),
            'best', slice(sort_array(flatten(transform(c.s.q, p -> coalesce(p.best, array()))), false), 1, %d))) AS stats"""
        % BEST,
    )


def window_states(
    states: DataFrame, keys: Sequence[str], last_days: Sequence[dt.date], months: Mapping[str, int] = TRAILING_MONTHS
) -> DataFrame:
    """as_of, keys and ``states``: a map from measure to its merged states, for every report
    date. At most as many states are read per measure as the longest window has months."""
    framed = dates.trailing_frame(states, "report_date", last_days, max(months.values()))
    found = merged(with_crossing_gaps(framed, keys), keys, months)
    return found.groupBy("as_of", *keys).agg(F.map_from_entries(F.collect_list(F.struct("metric", "stats"))).alias("states"))


def _at_rank(runs: str, rank: str) -> str:
    """The value at a rank (from 1) of sorted runs."""
    step = f"(a, r) -> IF(a.seen >= {rank}, a, named_struct('seen', a.seen + r.c, 'v', r.v))"
    return f"aggregate({runs}, named_struct('seen', 0L, 'v', CAST(NULL AS DOUBLE)), {step}).v"


def quantile(state: str, rank: float, exact: bool) -> str:
    """A quantile of a merged state: interpolated between neighbours if ``exact``, else the
    smallest value that the share reaches."""
    if not exact:
        return _at_rank(f"{state}.runs", f"greatest(1L, ceil({rank}D * {state}.n))")
    place = f"({rank}D * ({state}.n - 1))"
    low, high = (_at_rank(f"{state}.runs", f"CAST({f}({place}) AS BIGINT) + 1") for f in ("floor", "ceil"))
    return f"({low} + ({place} - floor({place})) * ({high} - {low}))"


def statistic(state: str, function: str, exact: bool = False) -> str:
    """Select expression of one statistic of a merged state."""
    if function in PERCENTILES:
        return f"IF({state}.n > 0, {quantile(state, PERCENTILES[function], exact)}, NULL)"
    if function not in SIMPLE:
        raise ValueError(f"unknown aggregate {function!r}")
    return SIMPLE[function].format(state)


def unpack_states(
    spec: Mapping[str, Sequence[str]],
    months: Mapping[str, int] = TRAILING_MONTHS,
    exact: bool = False,
    whole: Sequence[str] = (),
) -> list[str]:
    """Select expressions ``{measure}_{function}_{window}`` over the map of
    :func:`window_states`; sums and extremes of measures in ``whole`` are whole numbers."""
    out = []
    for measure, functions in spec.items():
        for function in functions:
            for i, window in enumerate(months):
                value = statistic(f"states['{measure}'][{i}]", function, exact)
                if measure in whole and function in ("sum", "min", "max"):
                    value = f"CAST({value} AS BIGINT)"
                out.append(f"{value} AS `{measure}_{function}_{window}`")
    return out
