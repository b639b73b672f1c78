"""Many statistics over nested trailing windows.

A row of a trailing frame belongs to every window longer than its age. Instead of one
conditional aggregate per statistic and window, rows are repeated once per window
they are in (under two copies on average for 1, 3, 6 and 12 months), aggregated
unconditionally per window, and the windows are then laid side by side. Each row is
only added where it counts, and the aggregate stays narrow enough to be compiled.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.aggregates import aggregate_text
from ledgerlens.functions.dates import TRAILING_MONTHS

WINDOW = "window_name"


def statistics(spec: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """``{column}_{function}`` for each column's own functions."""
    return {f"{c}_{f}": F.expr(aggregate_text(c, f)) for c, functions in spec.items() for f in functions}


def repeat_per_window(df: DataFrame, months: Mapping[str, int] = TRAILING_MONTHS) -> DataFrame:
    """One copy of each row per window it falls in."""
    windows = F.array(*[F.struct(F.lit(w).alias("name"), F.lit(n).alias("months")) for w, n in months.items()])
    inside = F.filter(windows, lambda w: w["months"] > F.col("months_back"))
    return df.withColumn(WINDOW, F.explode(F.transform(inside, lambda w: w["name"])))


def pack(
    df: DataFrame,
    keys: Sequence[str],
    statistics_by_name: Mapping[str, Column],
    name: str,
    months: Mapping[str, int] = TRAILING_MONTHS,
) -> DataFrame:
    """One row per key with all statistics of all windows in the map column ``name``."""
    per_window = (
        repeat_per_window(df, months)
        .groupBy(*keys, WINDOW)
        .agg(*[e.alias(n) for n, e in statistics_by_name.items()])
    )
    entry = F.struct(WINDOW, F.struct(*statistics_by_name))
    return per_window.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias(name))


def unpack(
    name: str,
    statistics_names: Iterable[str],
    windows: Iterable[str] = tuple(TRAILING_MONTHS),
    zero: Iterable[str] = (),
) -> list[str]:
    """Select expressions ``{statistic}_{window}``; ``zero`` ones are 0 for an empty window.

    Text expressions: a wide table has hundreds, and one parse each is far cheaper
    than building them call by call.
    """
    zero = set(zero)
    out = []
    for statistic in statistics_names:
        for window in windows:
            value = f"`{name}`['{window}'].`{statistic}`"
            value = f"coalesce({value}, 0)" if statistic in zero else value
            out.append(f"{value} AS `{statistic}_{window}`")
    return out
