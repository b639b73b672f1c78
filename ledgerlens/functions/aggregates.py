"""Conditional aggregates over trailing windows, built as one list of expressions.

Everything a caller asks for at one grain goes into a single ``groupBy().agg``:
one pass over the rows, one shuffle with map-side combine, and no joins between
partial results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Condition = tuple[Column, str]

# Percentile ranks by feature-name part.
PERCENTILES: dict[str, float] = {
    "pct5": 0.05,
    "pct10": 0.10,
    "pct25": 0.25,
    "med": 0.50,
    "pct75": 0.75,
    "pct90": 0.90,
    "pct95": 0.95,
}


def mean(value: Column) -> Column:
    """Mean as exact sum over count.

    Shares its two buffers with any sum or count of the same value, and keeps the
    sum of decimal amounts exact whatever order rows arrive in.
    """
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


SIMPLE: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "avg": mean,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "kurt": F.kurtosis,
    "skew": F.skewness,
    "count": F.count,
    "countDistinct": F.count_distinct,
}

# The same aggregates as text. A wide table has hundreds, and parsing one string each
# is far cheaper than building them call by call.
TEXT: dict[str, str] = {
    "sum": "sum({0})",
    "avg": "try_divide(CAST(sum({0}) AS DOUBLE), CAST(count({0}) AS DOUBLE))",
    "min": "min({0})",
    "max": "max({0})",
    "std": "stddev_samp({0})",
    "kurt": "kurtosis({0})",
    "skew": "skewness({0})",
    "count": "count({0})",
    "countDistinct": "count(DISTINCT {0})",
} | {name: f"percentile_approx(CAST({{0}} AS DOUBLE), {rank}D)" for name, rank in PERCENTILES.items()}


def aggregate_text(column: str, function: str) -> str:
    """:func:`aggregate` of a column as a select expression."""
    return TEXT[function].format(f"`{column}`")


REGRESSION: dict[str, Callable[[Column, Column], Column]] = {
    "regr_slope": F.regr_slope,
    "regr_intercept": F.regr_intercept,
    "regr_r2": F.regr_r2,
}


def aggregate(value: Column, function: str, exact: bool = False) -> Column:
    """Aggregate by name. Percentiles are discrete sketches unless ``exact``."""
    if function in SIMPLE:
        return SIMPLE[function](value)
    if function in PERCENTILES:
        rank = F.lit(PERCENTILES[function])
        return F.percentile(value, rank) if exact else F.percentile_approx(value.cast("double"), rank)
    raise ValueError(f"unknown aggregate {function!r}")


def over_windows(
    columns: Iterable[str],
    functions: Sequence[str],
    conditions: Sequence[Condition],
    exact: bool = False,
) -> list[Column]:
    """``{column}_{function}{suffix}`` for every combination."""
    return [
        aggregate(F.when(condition, F.col(column)), function, exact).alias(f"{column}_{function}{suffix}")
        for column in columns
        for function in functions
        for condition, suffix in conditions
    ]


def regression_over_windows(
    columns: Iterable[str], x: str, functions: Sequence[str], conditions: Sequence[Condition]
) -> list[Column]:
    """Linear regression of each column on ``x`` within each window."""
    return [
        REGRESSION[function](F.when(condition, F.col(column)), F.when(condition, F.col(x))).alias(
            f"{column}_{function}{suffix}"
        )
        for column in columns
        for function in functions
        for condition, suffix in conditions
    ]


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_if(condition: Column, value: Column) -> Column:
    """Sum over matching rows, where a row that does not match counts as zero."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def distinct_counts(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Exact distinct counts of several columns per key, from slim (kind, value) rows.

    Asking for several distinct counts beside ordinary aggregates makes Spark copy
    the whole aggregate row once per distinct column. Here only key, kind and value
    travel, deduplicated before each shuffle, so a dominant key is spread by value.
    """
    names = list(values)
    entries = [F.struct(F.lit(i).alias("kind"), values[n].cast("string").alias("value")) for i, n in enumerate(names)]
    return (
        df.select(*keys, F.explode(F.array(*entries)).alias("e"))
        .filter(F.col("e.value").isNotNull())
        .select(*keys, "e.kind", "e.value")
        .distinct()
        .groupBy(*keys)
        .agg(*[count_if(F.col("kind") == i).alias(n) for i, n in enumerate(names)])
    )
