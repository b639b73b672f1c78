"""Keeping a dominant key from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a task takes before the key is spread over several.
ROWS_PER_TASK = 1_000_000
#: Heavy keys that are looked up at most. Beyond, keys are joined plainly.
HEAVY_KEYS = 10_000
_SALT, _PARTS = "_salt", "_parts"
#: Rows that a task sorts or joins when the number of tasks follows from the data.
ROWS_PER_PART = 500_000
#: Members of a block, whose every copy gives half as many pairs; pairs that a task lists about.
MEMBERS_PER_BLOCK = 2_000
PAIRS_PER_TASK = 50_000_000
_ROW, _COLUMN = "_row", "_column"


def parts(written: DataFrame, rows_per_part: int = ROWS_PER_PART) -> int:
    """How many tasks to deal the rows of a written table to, so that a task's share stays the
    same when the table grows. The count reads file footers."""
    return max(written.sparkSession.sparkContext.defaultParallelism, -(-written.count() // rows_per_part))


def heavy_keys(
    df: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK, weight: Column | None = None
) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, and over how many parts to spread them.

    Counts combine before the shuffle, and at most ``HEAVY_KEYS`` of them, the largest,
    are returned, so the table may be broadcast whatever the size of the data. ``weight``
    tells how many rows a row of ``df`` stands for.
    """
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(*on).agg(size.alias("_n")).filter(F.col("_n") > rows_per_task)
    largest = counts.orderBy(F.desc("_n"), *on).limit(HEAVY_KEYS)
    return largest.select(*on, F.ceil(F.col("_n") / rows_per_task).cast("int").alias(_PARTS))


def known_heavy(
    df: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK, weight: Column | None = None
) -> DataFrame | None:
    """:func:`heavy_keys`, counted now and once: None if there are none, as mostly. For
    written tables, whose count is cheap and then not repeated in every join."""
    found = heavy_keys(df, on, rows_per_task, weight)
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Equi join whose left side may have dominant keys.

    Only the rows of a heavy key get salts, as many as its count asks for, from
    ``spread_by`` (columns that differ between them), and only its right rows are
    repeated. All other keys join as they are. The result is that of the plain join for
    inner, left, semi and anti joins.
    """
    return salted_join(big, small, on, spread_by, how, heavy_keys(big, on, rows_per_task))


def salted_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str, heavy: DataFrame | None
) -> DataFrame:
    """:func:`spread_join` for heavy keys that are known (None: there are none)."""
    if heavy is None:
        return big.join(small, list(on), how)
    heavy = F.broadcast(heavy)  # at most HEAVY_KEYS rows
    salt = F.when(F.col(_PARTS).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*spread_by), F.col(_PARTS)).cast("int"))
    salted = big.join(heavy, list(on), "left").withColumn(_SALT, salt).drop(_PARTS)
    parts = F.sequence(F.lit(0), F.coalesce(_PARTS, F.lit(1)) - 1)
    repeated = small.join(heavy, list(on), "left").withColumn(_SALT, F.explode(parts)).drop(_PARTS)
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)


def every_pair(
    rows: DataFrame, on: Sequence[str], member: str, tasks: int, heavy: DataFrame | None, names: tuple[str, str] = ("a", "b")
) -> DataFrame:
    """Every unordered pair of the members of a key, without any cap. ``rows`` has a row per key and
    member; its other columns come from the row of one of the two.

    Pairs of a large key are the square of its members, so the members of a ``heavy`` key are dealt
    to as many blocks as it says, and each two blocks meet in a cell of their own: a task never
    holds more than a block, and the cells of one key are spread over all tasks.
    """
    a, b = names
    left = rows.filter(F.col(member).isNotNull()).withColumnRenamed(member, a)
    right = left.select(*on, F.col(a).alias(b))
    keys, ordered = list(on), F.col(a) < F.col(b)
    if heavy is not None:
        heavy = F.broadcast(heavy)  # at most HEAVY_KEYS rows
        last = F.coalesce(F.col(_PARTS), F.lit(1)) - 1

        def block(of: str) -> Column:
            return F.pmod(F.xxhash64(of), last + 1).cast("int")

        left = left.join(heavy, keys, "left").withColumn(_ROW, block(a)).withColumn(_COLUMN, F.explode(F.sequence(_ROW, last)))
        right = right.join(heavy, keys, "left").withColumn(_COLUMN, block(b)).withColumn(_ROW, F.explode(F.sequence(F.lit(0), _COLUMN)))
        left, right = left.drop(_PARTS), right.drop(_PARTS)
        keys = [*keys, _ROW, _COLUMN]
        ordered = (F.col(_ROW) < F.col(_COLUMN)) | ordered
    # Sorted, as a hash table of the copies may be far larger than the files it is estimated by.
    met = left.repartition(tasks, *keys).join(right.repartition(tasks, *keys).hint("merge"), keys).filter(ordered)
    return met.withColumns({a: F.least(a, b), b: F.greatest(a, b)}).drop(_ROW, _COLUMN)
