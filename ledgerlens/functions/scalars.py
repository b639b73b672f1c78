"""Row-level expressions. Safe under ANSI mode: bad input gives null, never an error."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hours that count as night (wrapping midnight) and as core night.
NIGHT_HOURS = (22, 6)
CORE_HOURS = (0, 4)

# Tax rates in percent that have a band of their own, and the rest.
TAX_BANDS: dict[str, float] = {"10%": 10.0, "8%": 8.0, "5%": 5.0, "0%": 0.0}
OTHER_BAND = "others"

# Fixed value: stored balances are divided by one million.
BALANCE_UNIT = 1 / 1.0e6


def clean_key(col: Column) -> Column:
    """Identifier as trimmed text. Blank text stays; only null means missing."""
    return F.trim(col.cast("string"))


def to_int(col: Column) -> Column:
    return col.try_cast("int")


def to_timestamp(df: DataFrame, name: str) -> Column:
    """Timestamp of a column; text that does not parse becomes null."""
    kind = dict(df.dtypes)[name]
    col = F.col(name)
    if kind in ("timestamp", "timestamp_ntz"):
        return col
    return col.cast("timestamp") if kind == "date" else F.try_to_timestamp(col.cast("string"))


def in_hours(hour: Column, start: int, end: int) -> Column:
    """Whether ``hour`` is in ``[start, end)``; a start after the end wraps midnight."""
    if start <= end:
        return (hour >= start) & (hour < end)
    return (hour >= start) | (hour < end)


def ratio(numerator: Column, denominator: Column, otherwise: float | None = 0.0) -> Column:
    """``numerator / denominator`` where the denominator is positive, else a default."""
    value = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, value).otherwise(F.lit(otherwise).cast("double"))


# A mean of ratios that equals its threshold on paper may miss it by rounding.
SLACK = 1e-9


def at_least(value: Column, minimum: float) -> Column:
    """``value >= minimum``, decided alike whatever order the value was summed in."""
    return value >= minimum - SLACK


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def tax_percent(tax: Column, sales: Column, discount: Column) -> Column:
    return F.round(safe_divide(tax, sales + discount + tax) * 100, 2)


def tax_band(percent: Column) -> Column:
    """Band label of a tax percentage; null and unlisted rates are ``others``."""
    bands = iter(TAX_BANDS.items())
    label, rate = next(bands)
    chain = F.when(percent == rate, label)
    for label, rate in bands:
        chain = chain.when(percent == rate, label)
    return chain.otherwise(OTHER_BAND)


def scale_columns(df: DataFrame, columns: Iterable[str], unit: float) -> DataFrame:
    """Multiply columns by a unit after a safe cast to double."""
    return df.withColumns({c: F.col(c).try_cast("double") * F.lit(unit) for c in columns})


def union_of_arrays(*arrays: Column) -> Column:
    """Distinct elements of all arrays in order of first appearance; null counts as empty."""
    empty = F.array().cast("array<string>")
    return reduce(F.array_union, [F.coalesce(a, empty) for a in arrays], empty)
