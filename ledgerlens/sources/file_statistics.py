"""Answers from the partition listing and the statistics in file footers.

Whether a date range holds a row, or a partition only rows of its month, is mostly settled by
a partition's smallest and largest date and its row count, which Parquet keeps per file.
Spark's aggregate pushdown reads these from the footers. Only partitions that they leave open
are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.store import AVAILABILITY_DAYS, partition_alignment

#: Footers answer aggregates of the newer reader alone; partition values stay texts.
_FOOTERS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


@contextmanager
def _settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@dataclass(frozen=True)
class PartitionFacts:
    """A partition's value, rows, and first and last date (None if all dates are null)."""

    value: str
    rows: int
    first: dt.date | None
    last: dt.date | None


def footer_query(spark: SparkSession, path: str, partition: str, date_col: str, values: Sequence[str]) -> DataFrame:
    """First and last date of the given partitions, answered by footers under :func:`facts`."""
    rows = spark.read.parquet(path).filter(F.col(partition).isin(list(values)))
    return rows.groupBy(partition).agg(F.min(date_col).alias("first"), F.max(date_col).alias("last"))


def facts(spark: SparkSession, path: str, partition: str, date_col: str) -> list[PartitionFacts]:
    """Facts of every partition of the Parquet folder ``path``; bounded by the partitions.

    A file without a single date has no extremes, so partitions that hold null dates are
    asked for theirs by reading that column; so are all, if files lack statistics.
    """
    kind = dict(spark.read.parquet(path).dtypes)[date_col]
    if kind != "date":
        raise TypeError(f"{date_col} is {kind}; footers are asked for dates")
    with _settings(spark, _FOOTERS):
        try:
            counts = spark.read.parquet(path).groupBy(partition).agg(F.count(F.lit(1)).alias("rows"), F.count(date_col).alias("dated")).collect()
            told = [r[partition] for r in counts if r["rows"] == r["dated"]]
            spans = {r[partition]: (r["first"], r["last"]) for r in footer_query(spark, path, partition, date_col, told).collect()}
        except Py4JJavaError as error:
            if "aggregatePushdown" not in str(error.java_exception):
                raise
            counts, spans = [], {}
    if not counts:
        counts = _read(spark, path, partition).groupBy(partition).agg(F.count(F.lit(1)).alias("rows")).collect()
    others = [r[partition] for r in counts if r[partition] not in spans]
    if others:
        dated = _read(spark, path, partition, others).groupBy(partition).agg(F.min(date_col).alias("first"), F.max(date_col).alias("last"))
        spans |= {r[partition]: (r["first"], r["last"]) for r in dated.collect()}
    return [PartitionFacts(r[partition], r["rows"], *spans[r[partition]]) for r in sorted(counts, key=lambda r: str(r[partition]))]


def _read(spark: SparkSession, path: str, partition: str, values: Sequence[str] | None = None) -> DataFrame:
    """Rows of the given partitions alone (or of all), with the partition as text."""
    with _settings(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        rows = spark.read.parquet(path)
    return rows if values is None else rows.filter(F.col(partition).isin(list(values)))


def _holds(found: PartitionFacts, after: dt.date, upto: dt.date) -> bool | None:
    """Whether a partition has a date in (after, upto]; None if its extremes leave it open."""
    if found.first is None or found.last <= after or found.first > upto:
        return False
    if found.first > after or found.last <= upto:
        return True
    return None


def availability_from_files(
    spark: SparkSession,
    sources: Mapping[str, tuple[str, str, str]],
    run_dates: Sequence[dt.date],
    days: int = AVAILABILITY_DAYS,
) -> DataFrame:
    """``(source, run_date, ok)`` as :func:`store.availability`, for sources given as
    (path, partition column, date column). A partition is read only if no other one settles
    the question and its own first and last dates lie on both sides of the range."""
    settled, open_ = [], []
    for name, (path, partition, date_col) in sources.items():
        known = facts(spark, path, partition, date_col)
        for run_date in run_dates:
            upto = run_date + dt.timedelta(days=days)
            answers = {f.value: _holds(f, run_date, upto) for f in known}
            unsure = [v for v, held in answers.items() if held is None]
            if any(answers.values()) or not unsure:
                settled.append((name, run_date, any(answers.values())))
                continue
            found = _read(spark, path, partition, unsure).filter((F.col(date_col) > F.lit(run_date)) & (F.col(date_col) <= F.lit(upto)))
            first = found.limit(1).agg((F.count(F.lit(1)) > 0).alias("ok"))
            open_.append(first.select(F.lit(name).alias("source"), F.lit(run_date).alias("run_date"), "ok"))
    status = spark.createDataFrame(settled, "source string, run_date date, ok boolean")
    for check in open_:
        status = status.unionByName(check)
    return status


def alignment_from_files(spark: SparkSession, path: str, partition: str, date_col: str) -> DataFrame:
    """As :func:`store.partition_alignment` for the Parquet folder ``path``, partitioned by
    ``yyyyMM``. A partition whose first and last dates are in its month is not read."""
    settled, unsure = [], []
    for found in facts(spark, path, partition, date_col):
        inside = found.first is not None and {found.first.strftime("%Y%m"), found.last.strftime("%Y%m")} == {found.value}
        if inside or found.first is None:
            settled.append((found.value, found.first, found.last, found.rows, 0))
        else:
            unsure.append(found.value)
    columns = f"{partition} string, min_date date, max_date date, row_count long, misplaced long"
    status = spark.createDataFrame(settled, columns)
    return status.unionByName(partition_alignment(_read(spark, path, partition, unsure), partition, date_col)) if unsure else status
