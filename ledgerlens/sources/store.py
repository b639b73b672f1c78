"""Table reads and writes that can be repeated safely."""

from __future__ import annotations

import atexit
import datetime as dt
import gc
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.util import inheritable_thread_target

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

#: Of intermediate tables.
COMPRESSION = ("compression", "zstd")
#: Input of a slice, and slices at most, of work that is done slice by slice.
BYTES_PER_SLICE = 16 << 20
MOST_SLICES = 8
_SLICE = "_slice"
#: Sizes from here on are Spark's word for not known.
UNKNOWN_SIZE = 1 << 60

# Fixed value: how many days after a run date its sources must reach into.
AVAILABILITY_DAYS = 10


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate results survive the loss of an executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without
    one gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder or tempfile.mkdtemp(prefix="ledgerlens-")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several branches read, and read it back.

    The branches then scan a pruned columnar file instead of repeating the work. The
    folder goes when the process that made it ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    df.write.option(*COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Size of the files a frame is made from; what is in memory counts as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(n for n in sizes if n < UNKNOWN_SIZE)


def in_slices(df: DataFrame, name: str, by: Sequence[Column], use: Callable[[DataFrame], None]) -> None:
    """Write a frame once and hand it to ``use`` slice by slice, all rows that are equal in ``by`` in
    one slice. A slice that was used is deleted, and so are the shuffles of its use: these take a
    share of the disk that they would take for the whole frame, as more slices are made of more
    input, up to ``MOST_SLICES``.
    """
    spark = df.sparkSession
    n = max(1, min(MOST_SLICES, -(-input_bytes(df) // BYTES_PER_SLICE)))
    path, schema = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", df.schema
    remove_at_exit(spark, path)
    part = F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    df.withColumn(_SLICE, part).write.partitionBy(_SLICE).option(*COMPRESSION).parquet(path)
    del df
    for i in range(n):
        release(spark)
        # A slice without rows has no folder, which the filter does not mind.
        found = spark.read.schema(StructType([*schema.fields, StructField(_SLICE, IntegerType())])).parquet(path)
        use(found.filter(F.col(_SLICE) == i).drop(_SLICE))
        _delete(spark, f"{path}/{_SLICE}={i}")
        del found
    _delete(spark, path)
    release(spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs that nothing refers to any more. It
    does so when the driver collects its garbage, which may be long after."""
    gc.collect()
    spark._jvm.System.gc()


class Growing:
    """:func:`materialize` of a table that is written piece by piece."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.path = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.schema: StructType | None = None
        remove_at_exit(spark, self.path)

    def add(self, df: DataFrame) -> None:
        self.schema = df.schema
        df.write.mode("append").option(*COMPRESSION).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


class GrowingBuckets:
    """:func:`bucketed` of a table that is written piece by piece: a bucket has a file of each."""

    def __init__(self, spark: SparkSession, name: str, key: str, order: Sequence[str]) -> None:
        self.spark, self.key, self.order = spark, key, list(order)
        self.n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table, self.path = f"ledgerlens_{name}_{uuid.uuid4().hex}", f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        remove_at_exit(spark, self.path, self.table)

    def add(self, df: DataFrame) -> None:
        writer = df.repartition(self.n, self.key).write.mode("append").bucketBy(self.n, self.key).sortBy(*self.order)
        writer.option("path", self.path).option(*COMPRESSION).saveAsTable(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)


def bucketed(df: DataFrame, name: str, key: str, order: Sequence[str]) -> DataFrame:
    """:func:`materialize` as a table that is hashed on ``key`` into files and sorted by
    ``order`` in each, for what is read by key again and again: windows and aggregates by the
    key need no exchange over it. Only for rows whose number per key is bounded, as a file is
    one task. The table leaves the catalog, and its files go, when the process ends.
    """
    written = GrowingBuckets(df.sparkSession, name, key, order)
    written.add(df)
    return written.read()


def together(spark: SparkSession, *writes: Callable[[], object]) -> list[object]:
    """Results of writes that do not need each other, run side by side: what one leaves idle,
    the other uses."""
    with ThreadPoolExecutor(len(writes)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
        return [each.result() for each in started]


def remove_at_exit(spark: SparkSession, path: str, table: str | None = None) -> None:
    """Delete a folder, and drop the table over it, when the process ends."""
    atexit.register(_remove, weakref.ref(spark), path, table)


def _remove(session: weakref.ref, path: str, table: str | None = None) -> None:
    spark = session()
    if spark is not None and spark.sparkContext._jsc is not None:
        if table is not None:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def overwrite_table(df: DataFrame, table: str, partition_cols: Sequence[str] = ()) -> None:
    """Replace a managed table and its schema."""
    df.write.mode("overwrite").partitionBy(*partition_cols).saveAsTable(table)


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Replace a table's rows, keeping its schema; creates it empty when missing."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.limit(0).write.saveAsTable(table)
    columns = spark.table(table).columns
    df.select(*columns).write.insertInto(table, overwrite=True)


def replace_partitions(
    df: DataFrame,
    table: str,
    partition_cols: Sequence[str],
    scope: Mapping[str, Sequence[object]] | None = None,
) -> None:
    """Replace exactly the partitions present in ``df``; others are not touched.

    Spark swaps the new files in at commit, so a failed or repeated job never leaves
    half a partition. Rows are rebalanced on the partition columns first, which keeps
    file counts low and splits an oversized partition over several tasks.

    ``scope`` names partition values the job is responsible for: those without rows
    in ``df`` are dropped after the write, so a day that vanished does not go stale.
    Which values were written is observed during the write itself.
    """
    spark = df.sparkSession
    balanced = df.hint("rebalance", *partition_cols)
    if not spark.catalog.tableExists(table):
        balanced.write.mode("append").partitionBy(*partition_cols).saveAsTable(table)
        return
    if scope:
        (column,) = scope
        written = Observation()
        balanced = balanced.observe(written, F.collect_set(F.col(column).cast("string")).alias("values"))
    columns = spark.table(table).columns
    with _dynamic_overwrite(spark):
        balanced.select(*columns).write.insertInto(table, overwrite=True)
    if scope:
        stale = {str(v) for v in scope[column]} - set(written.get["values"])
        for value in sorted(stale):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{value}')")
    spark.catalog.refreshTable(table)


def audit_columns(df: DataFrame, partition: str, job_columns: bool = True) -> DataFrame:
    """Prepend load time, empty job columns, and the partition as date and timestamp."""
    empty = F.lit(None).cast("string")
    return df.select(
        F.current_timestamp().alias("ds_etl_timestamp"),
        *([empty.alias(c) for c in ("ds_etl_job_id", "ds_source_system", "ds_key")] if job_columns else []),
        F.col(partition).cast("date").alias("ds_partition_date"),
        F.col(partition).cast("timestamp").alias("processing_dt"),
        "*",
    )


def latest_rows(df: DataFrame, keys: Sequence[str], latest: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the order of ``latest``, which should settle ties.

    A null in a key makes the query fail, as such a row could never be found again.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    message = F.lit(f"null in a key of {', '.join(keys)}")
    checked = F.when(missing, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.filter(checked).withColumn("_first", first).filter("_first = 1").drop("_first")


def merged_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """What the partitions that ``source`` falls in hold after a merge.

    ``source`` is unique on its keys. Rows of the target without a new version stay.
    """
    touched = source.select(partition).distinct()
    kept = target.join(touched, partition, "left_semi").join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source).select(*target.columns)


def replaced_rows(target: DataFrame, source: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """What a table holds after the partitions present in ``source`` were replaced by it."""
    touched = source.select(*partition_cols).distinct()
    return target.join(touched, list(partition_cols), "left_anti").select(*target.columns).unionByName(source)


#: Parts a key index is divided in. Stored indexes depend on it.
INDEX_PARTS = 64
INDEX_PART = "_part"


class KeyIndex:
    """Which partition of a table each key is in, as a slim table beside it.

    A key may be listed with more partitions than it is in, never with fewer: the new
    places are added before the table is written, old ones removed after it, so a merge that
    was lost in between is repaired by the next. Its own partitions are parts of the keys'
    hashes, of which a merge rewrites those its keys fall in.
    """

    def __init__(self, spark: SparkSession, table: str, keys: Sequence[str], partition: str, anew: bool = False) -> None:
        """``anew`` makes the index from the table again, as is needed after other writers."""
        self.spark, self.name, self.keys, self.partition = spark, f"{table}__keys", list(keys), partition
        if anew:
            spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if not spark.catalog.tableExists(self.name):
            self._write(spark.table(table).select(*self.keys, partition), new=True)

    def _entries(self, rows: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64(*self.keys), F.lit(INDEX_PARTS)).cast("int")
        return rows.select(*self.keys, F.col(self.partition).alias("_place")).distinct().withColumn(INDEX_PART, part)

    def _write(self, rows: DataFrame, new: bool = False) -> None:
        entries = self._entries(rows) if new else rows
        entries = entries.hint("rebalance", INDEX_PART)
        if new:
            entries.write.partitionBy(INDEX_PART).saveAsTable(self.name)
            return
        with _dynamic_overwrite(self.spark):
            entries.select(*self.keys, "_place", INDEX_PART).write.insertInto(self.name, overwrite=True)
        self.spark.catalog.refreshTable(self.name)

    def _touched(self, entries: DataFrame) -> DataFrame:
        parts = [r[0] for r in entries.select(INDEX_PART).distinct().collect()]  # at most INDEX_PARTS
        return self.spark.table(self.name).filter(F.col(INDEX_PART).isin(parts))

    def places(self, source: DataFrame) -> list[object]:
        """Partitions that hold a key of ``source``; bounded by the partitions."""
        entries = self._entries(source)
        return [r[0] for r in self._touched(entries).join(entries.select(*self.keys), self.keys, "left_semi").select("_place").distinct().collect()]

    def add(self, source: DataFrame) -> None:
        """Every key of ``source`` is in its partition too."""
        entries = self._entries(source)
        self._write(self._touched(entries).select(*self.keys, "_place", INDEX_PART).union(entries).distinct())

    def settle(self, source: DataFrame) -> None:
        """Every key of ``source`` is in its partition alone."""
        entries = self._entries(source)
        others = self._touched(entries).join(entries.select(*self.keys), self.keys, "left_anti")
        self._write(others.select(*self.keys, "_place", INDEX_PART).union(entries))


def _partition_text(value: object) -> str:
    return str(value).replace("'", "\\'")


def upsert(df: DataFrame, table: str, keys: Sequence[str], partition: str, latest: Sequence[Column]) -> None:
    """Merge rows into a partitioned table: matching keys are replaced, new ones added.

    Source rows with equal keys are reduced to the first by ``latest``; that is written once
    and read by all uses of it. A key that was in another partition leaves it: the
    :class:`KeyIndex` beside the table names the partitions to look in. Only these and the
    source's own are read and rewritten; those that lost their last row are dropped. The
    partition column holds no nulls.
    """
    spark = df.sparkSession
    unique = materialize(latest_rows(df, keys, latest), "upsert")
    if not spark.catalog.tableExists(table):
        unique.hint("rebalance", partition).write.partitionBy(partition).saveAsTable(table)
        KeyIndex(spark, table, keys, partition, anew=True)
        return
    index = KeyIndex(spark, table, keys, partition)
    left = index.places(unique)
    gaining = [r[0] for r in unique.select(partition).distinct().collect()]  # bounded by the partitions
    index.add(unique)
    here = spark.table(table).filter(F.col(partition).isin(sorted({*left, *gaining}, key=str)))
    written = Observation()
    merged = moved_rows(here, unique, keys).observe(written, F.collect_set(F.col(partition).cast("string")).alias("values"))
    with _dynamic_overwrite(spark):
        merged.hint("rebalance", partition).write.insertInto(table, overwrite=True)
    for value in sorted({str(v) for v in left} - set(written.get["values"])):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{partition}` = '{_partition_text(value)}')")
    spark.catalog.refreshTable(table)
    index.settle(unique)


def moved_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` instead of its own of the same keys, wherever
    these were. ``source`` is unique on its keys."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source).select(*target.columns)


def upsert_features(
    df: DataFrame,
    table: str,
    latest: Sequence[Column],
    partition: str = "report_date",
    entity: str = "cusid",
    job_columns: bool = True,
) -> None:
    """Feature-table merge on entity and processing time, with audit columns."""
    upsert(audit_columns(df, partition, job_columns), table, [entity, "processing_dt"], partition, latest)


def availability(
    sources: Mapping[str, tuple[DataFrame, str]], run_dates: Sequence[dt.date], days: int = AVAILABILITY_DAYS
) -> DataFrame:
    """``(source, run_date, ok)``: whether each source has rows in the days after each date.

    Every check stops at the first matching row.
    """
    checks = []
    for name, (df, date_col) in sources.items():
        day = F.col(date_col).cast("date")
        for run_date in run_dates:
            after = (day > F.lit(run_date)) & (day <= F.lit(run_date + dt.timedelta(days=days)))
            found = df.filter(after).limit(1).agg((F.count(F.lit(1)) > 0).alias("ok"))
            checks.append(found.select(F.lit(name).alias("source"), F.lit(run_date).alias("run_date"), "ok"))
    status = checks[0]
    for check in checks[1:]:
        status = status.unionByName(check)
    return status


def require_available(
    sources: Mapping[str, tuple[DataFrame, str]], run_dates: Sequence[dt.date], days: int = AVAILABILITY_DAYS
) -> None:
    """Stop with the names of the sources that are not ready."""
    missing = availability(sources, run_dates, days).filter(~F.col("ok")).select("source").distinct().collect()
    if missing:
        raise RuntimeError("not available: " + ", ".join(sorted(r.source for r in missing)))


def partition_alignment(df: DataFrame, partition: str, ts_col: str) -> DataFrame:
    """Per partition month: rows, first and last date, and rows dated in another month."""
    day = F.col(ts_col).cast("date")
    elsewhere = F.date_format(day, "yyyyMM") != F.col(partition)
    return df.groupBy(partition).agg(
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(elsewhere, F.lit(1))).alias("misplaced"),
    )
