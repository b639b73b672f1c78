"""Exact distinct counts that merge: sets of members as bitmaps, by owner and bucket.

A count of distinct buyers cannot be added up over days. A set can: each owner's members are
numbered once, in a dictionary that only ever grows, and a day's set is a bitmap over these
numbers. Days merge to months and months to windows by OR; the counts then fall out of the
bitmaps without reading a member again. Rows are laid out by owner and bucket before a
bitmap is made or merged, which is then done in place: while they are aggregated, bitmaps are
whole pages of 4 KB, which must neither be shuffled nor sorted. A member's bucket follows from its hash, so that an
owner with very many members is spread, and numbers are dense within a bucket. Trailing zero
bytes are cut, so a set of one member is a byte or little more.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.functions.dates import TRAILING_MONTHS
from ledgerlens.operators import trailing
from ledgerlens.operators.skew import parts
from ledgerlens.sources.store import materialize

#: Hash buckets of each owner. Stored sets depend on it.
BUCKETS = 64
NUMBERED = ("bucket", "number")


def _bucket(member: str) -> Column:
    return F.pmod(F.xxhash64(member), F.lit(BUCKETS)).cast("int").alias("bucket")


def numbered(pairs: DataFrame, owner: str, member: str, known: DataFrame | None = None) -> DataFrame:
    """owner, member, bucket and number of all members seen: those of ``known`` as they
    were, new ones behind them. Numbers start at 0 in each bucket of an owner."""
    found = pairs.select(owner, member).filter(F.col(owner).isNotNull() & F.col(member).isNotNull()).distinct()
    found = found.select(owner, member, _bucket(member))
    if known is not None:
        found = found.join(known.select(owner, member), [owner, member], "left_anti")
    number = F.row_number().over(Window.partitionBy(owner, "bucket").orderBy(member)) - 1
    fresh = found.withColumn("number", number.cast("long"))
    if known is None:
        return fresh
    ends = known.groupBy(owner, "bucket").agg((F.max("number") + 1).alias("_next"))
    moved = fresh.join(ends, [owner, "bucket"], "left").withColumn("number", F.col("number") + F.coalesce("_next", F.lit(0)))
    return known.select(owner, member, *NUMBERED).unionByName(moved.select(owner, member, *NUMBERED))


def _trimmed(bitmap: Column, last: Column) -> Column:
    """Without the bytes behind the one that holds bit ``last``."""
    return F.substring(bitmap, F.lit(1), (F.floor(last / 8) + 1).cast("int"))


def _sets(keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    place = F.bitmap_bit_position(F.col("number"))
    page = F.bitmap_bucket_number(F.col("number")).alias("page")
    # Numbers start at 1 for these two functions.
    made = keyed.withColumn("number", F.col("number") + 1).select(*keys, "bucket", page, place.alias("place"))
    sets = made.groupBy(*keys, "bucket", "page").agg(F.bitmap_construct_agg("place").alias("bits"), F.max("place").alias("last"))
    return sets.select(*keys, "bucket", "page", _trimmed(F.col("bits"), F.col("last")).alias("bits"))


def day_sets(rows: DataFrame, owner: str, member: str, date_col: str, known: DataFrame | None = None) -> DataFrame:
    """owner, date, bucket, page and bits of the members of every owner's day.

    Rows are reduced to one per owner, member and day before they meet the dictionary, so a
    pair that trades very often is no heavier than its days. Rows without owner, member or
    date count nowhere. ``known`` is an earlier dictionary; the sets then use its numbers. Without
    one the numbers are those of :func:`numbered`, given in the layout of the sets.
    """
    slim = materialize(
        rows.select(owner, member, date_col).filter(F.col(owner).isNotNull() & F.col(member).isNotNull() & F.col(date_col).isNotNull()).distinct(),
        "members",
    )
    if known is None:
        rank = F.dense_rank().over(Window.partitionBy(owner, "bucket").orderBy(member)) - 1
        laid = slim.withColumn("bucket", _bucket(member)).repartition(parts(slim), owner, "bucket")
        found = laid.withColumn("number", rank.cast("long"))
    else:
        dictionary = numbered(slim, owner, member, known)
        found = slim.join(dictionary, [owner, member]).repartition(parts(slim), owner, "bucket")
    return _sets(found.select(owner, date_col, *NUMBERED), [owner, date_col])


def merged(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets of the same key, bucket and page as one. ``sets`` should lie by their owner and bucket."""
    size = F.max(F.octet_length("bits"))
    found = sets.groupBy(*keys, "bucket", "page").agg(F.bitmap_or_agg("bits").alias("bits"), size.alias("size"))
    return found.select(*keys, "bucket", "page", F.substring(F.col("bits"), F.lit(1), F.col("size")).alias("bits"))


def month_sets(days: DataFrame, owner: str, date_col: str, laid_out: bool = False) -> DataFrame:
    """The sets of days as sets of months, keyed by month end. ``laid_out`` says that ``days``
    come from :func:`day_sets` as they are, by owner and bucket; stored ones are dealt first."""
    days = days if laid_out else days.repartition(owner, "bucket")
    return merged(days.withColumn(date_col, F.last_day(date_col)), [owner, date_col])


def counts(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Members per key. Each bucket and page of a key must be there once."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def window_counts(
    months: DataFrame,
    owner: str,
    last_days: Sequence[dt.date],
    name: str,
    date_col: str = "report_date",
    windows: Mapping[str, int] = TRAILING_MONTHS,
) -> DataFrame:
    """as_of, owner and ``{name}_{window}``: distinct members per trailing window.

    A set is repeated for each window it is in and merged there; members never meet again.
    """
    framed = dates.trailing_frame(months, date_col, last_days, max(windows.values())).repartition(owner, "bucket")
    repeated = trailing.repeat_per_window(framed, windows).select("as_of", owner, trailing.WINDOW, "bucket", "page", "bits")
    found = counts(merged(repeated, ["as_of", owner, trailing.WINDOW]), ["as_of", owner, trailing.WINDOW], "n")
    each = [F.coalesce(F.sum(F.when(F.col(trailing.WINDOW) == w, F.col("n"))), F.lit(0)).alias(f"{name}_{w}") for w in windows]
    return found.groupBy("as_of", owner).agg(*each)
