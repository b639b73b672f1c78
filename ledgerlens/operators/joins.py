"""Join-shaped operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ledgerlens.operators.skew import ROWS_PER_TASK, known_heavy, salted_join
from ledgerlens.sources.store import materialize

# Adjustment codes that change what an invoice is worth.
MONEY_ADJUSTMENT = 9
REPLACEMENT = 3

SPREAD = 4096  # how many artificial keys rows without a lookup are spread over


def adjusted_amount(
    invoices: DataFrame,
    originals: DataFrame,
    amount: str = "double",
    code_col: str = "adjust_type",
    money_code: int = MONEY_ADJUSTMENT,
    replacement_code: int = REPLACEMENT,
    value_col: str = "with_vat_foreign",
    rows_per_task: int = ROWS_PER_TASK,
    original_if: Column | None = None,
) -> DataFrame:
    """Add ``adjusted_sale``: own amount plus the original's for a money adjustment,
    the original's for a replacement, else the own amount. Missing amounts are zero.

    Only correcting invoices need their original, and most invoices have none. The
    others get one of ``SPREAD`` artificial keys instead of a shared null, so they
    never pile up in one task. The lookup holds only originals that are asked for,
    one row per id and month, so the join cannot fan out. It is written by one pass in
    which amounts and demands meet, which also tells the originals that very many invoices
    correct; those are spread over tasks, the others are not copied. ``originals`` may be
    ``invoices`` itself, of which ``original_if`` may rule out some.
    """
    code = F.col(code_col).try_cast("int")
    needs = F.coalesce(code.isin(money_code, replacement_code), F.lit(False)) & F.col("original_invoice").isNotNull()
    filler = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("invoice_id", "seller", "buyer"), F.lit(SPREAD)).cast("string"))
    own = F.coalesce(F.col(value_col).try_cast(amount), F.lit(0).cast(amount))
    original = F.coalesce(F.col("_original_value"), F.lit(0).cast(amount))

    keys = ["_lookup", "partition_month"]
    valid = F.lit(True) if original_if is None else F.coalesce(original_if, F.lit(False))
    value = F.when(valid, F.col(value_col).try_cast(amount))

    def entry(of: str, worth_of: Column, asked: int) -> Column:
        return F.struct(F.col(of).cast("string").alias("_lookup"), worth_of.alias("_value"), F.lit(asked).cast("long").alias("_asked"))

    offer, demand = entry("invoice_id", value, 0), entry("original_invoice", F.lit(None).cast(amount), 1)
    both = F.when(needs, F.array(offer, demand)).otherwise(F.array(offer))
    if originals is invoices:
        entries = invoices.select("partition_month", F.explode(both).alias("e"))
    else:
        entries = originals.select("partition_month", offer.alias("e")).unionByName(invoices.filter(needs).select("partition_month", demand.alias("e")))
    lookup = entries.select("partition_month", "e.*").groupBy(*keys).agg(F.max("_value").alias("_original_value"), F.sum("_asked").alias("_asked"))
    lookup = materialize(lookup.filter((F.col("_asked") > 0) & F.col("_lookup").isNotNull()), "originals")
    keyed = invoices.withColumn("_lookup", F.when(needs, F.col("original_invoice").cast("string")).otherwise(filler))
    heavy = known_heavy(lookup, keys, rows_per_task, F.col("_asked"))
    joined = salted_join(keyed, lookup.drop("_asked"), keys, ["invoice_id", "seller", "buyer"], "left", heavy)
    worth = F.when(code == money_code, own + original).when(code == replacement_code, original).otherwise(own)
    return joined.withColumn("adjusted_sale", worth.cast(amount)).drop("_lookup", "_original_value")


def merge_on_key(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of frames that are each unique on ``keys``, with one shuffle.

    Stacking the frames and regrouping replaces a chain of outer joins; every value
    column comes from one frame, so its only non-null value is the maximum. A frame that
    holds a key twice makes the query fail with the key, as one value would be lost.
    """
    marks = [f"_in_{i}" for i in range(len(frames))]
    marked = [frame.withColumn(mark, F.lit(1)) for frame, mark in zip(frames, marks, strict=True)]
    stacked = marked[0]
    for frame in marked[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in keys and c not in marks]
    merged = stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values], *[F.sum(m).alias(m) for m in marks])
    most = F.greatest(*[F.coalesce(m, F.lit(0)) for m in marks], F.lit(0))
    which = F.concat(F.lit("key held twice: "), F.to_json(F.struct(*keys)))
    checked = F.when(most > 1, F.raise_error(which)).otherwise(F.col(keys[0]))
    return merged.withColumn(keys[0], checked.cast(merged.schema[keys[0]].dataType)).drop(*marks)


def recent_months(df: DataFrame, month_col: str, count: int) -> DataFrame:
    """Keep the last ``count`` months that occur in the data (not on the calendar)."""
    kept = df.select(month_col).distinct().orderBy(F.desc(month_col)).limit(count)
    return df.join(F.broadcast(kept), month_col, "left_semi")  # at most `count` rows


def days_without(df: DataFrame, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Dates between the first and last date in the data, per key, that have no row."""
    days = df.select(*keys, date_col).distinct()
    span = days.groupBy(*keys).agg(F.min(date_col).alias("first"), F.max(date_col).alias("last"))
    spine = span.filter(F.col("first").isNotNull()).select(*keys, F.explode(F.sequence("first", "last")).alias(date_col))
    return spine.join(days, [*keys, date_col], "left_anti")


def latest_business_day(calendar: DataFrame, date_col: str = "date_code", off_col: str = "off_date") -> DataFrame:
    """``latest``: for every calendar date, the last working day on or before it.

    A date that the calendar lists twice is one date, a working day if one of its rows
    says so. The window has no partition key because the calendar is the whole data: one
    row per date of a bounded range.
    """
    dated = calendar.groupBy(date_col).agg(F.min(off_col).alias(off_col))
    working = F.when(~F.col(off_col), F.col(date_col))
    so_far = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dated.select(date_col, F.last(working, ignorenulls=True).over(so_far).alias("latest"))


def canonical_pair(left: Column, right: Column, names: tuple[str, str] = ("a", "b")) -> list[Column]:
    """The two ids in order, so an undirected pair has one spelling."""
    return [F.least(left, right).alias(names[0]), F.greatest(left, right).alias(names[1])]


def _dates(df: DataFrame, column: str) -> Column:
    """All distinct dates of a column as one array, which the calendar bounds."""
    kind = df.schema[column].dataType
    if not isinstance(kind, DateType):
        raise TypeError(f"{column} is {kind.simpleString()}; only dates are attached to every entity")
    values = df.filter(F.col(column).isNotNull()).select(column).distinct()
    return values.agg(F.array_sort(F.collect_list(column)).alias("v")).scalar()


def densify(df: DataFrame, columns: Sequence[str], fill: float = 0, entities: DataFrame | None = None) -> DataFrame:
    """One row per combination of the distinct values of ``columns``; gaps are filled.

    The first column is the entity and may be of any size. The others are dates, whose
    number the calendar bounds: each is packed into one array that entities expand
    locally, so no cross join runs. With ``entities`` the entity side is taken from there. ``df``
    is written once, as its entities, its dates and its values are read from it.
    """
    df = materialize(df, "dense")
    heads = columns[:1] if entities is None else entities.columns
    full = (df if entities is None else entities).select(*heads).distinct()
    for column in columns[len(heads) :]:
        full = full.withColumn(column, F.explode(_dates(df, column)))
    return full.join(df, list(columns), "left").na.fill(fill)


def fill_subset(df: DataFrame, columns: Iterable[str], value: float = 0) -> DataFrame:
    """Fill nulls in the named columns only."""
    return df.na.fill(value, subset=list(columns))


def fold_groups(df: DataFrame, keys: Sequence[str], groups: Mapping[str, Sequence[Column]]) -> DataFrame:
    """Several feature groups at the same grain as one aggregate instead of a join each."""
    return df.groupBy(*keys).agg(*[e for expressions in groups.values() for e in expressions])
