"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCRATCH = "ledgerlens-llm"


def ship(spark: SparkSession) -> None:
    """Hands this subpackage to the executors, once per context, as --py-files would."""
    context = spark.sparkContext
    if any(name.startswith(f"{SCRATCH}-code") for name in map(os.path.basename, context._python_includes)):
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix=f"{SCRATCH}-")) / f"{SCRATCH}-code-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(target, "w") as packed:
        packed.writestr("ledgerlens/__init__.py", "")
        for source in sorted(here.glob("*.py")):
            packed.write(source, f"ledgerlens/{here.name}/{source.name}")
    context.addPyFile(str(target))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared ``spark.checkpoint.dir``, removed when the process ends.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix=f"{SCRATCH}-")
    path = f"{root}/{SCRATCH}-{uuid.uuid4().hex}"
    _scopes[-1].folders.append(path)
    atexit.register(_remove, weakref.ref(spark), path)
    return path


def _remove(session: weakref.ref, path: str) -> None:
    spark = session()
    if spark is not None and spark.sparkContext._jsc is not None:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@dataclass
class Scratch:
    """Folders and tables that a piece of work left in the shared folder."""

    folders: list[str] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)


#: What is there, by the work in hand; the last one owns what is written now.
_scopes: list[Scratch] = [Scratch()]


@contextmanager
def scope() -> Iterator[Scratch]:
    """Owns what is written inside, for :func:`clear` once its result is elsewhere."""
    own = Scratch()
    _scopes.append(own)
    try:
        yield own
    finally:
        _scopes.remove(own)


def clear(spark: SparkSession, own: Scratch) -> None:
    """Drop the tables and delete the folders of a scope."""
    for table in own.tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    for path in own.folders:
        _delete(spark, path)
    own.tables.clear()
    own.folders.clear()


Batches = Iterator[pa.RecordBatch]

#: Rows of an Arrow batch at most while a table is written: a batch of texts is held several
#: times over, by the JVM and by Python.
BATCH_ROWS = 2_000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """At most ``BATCH_ROWS`` rows in an Arrow batch of jobs that run inside."""
    given = spark.conf.get(_BATCH_ROWS)
    if 0 < int(given) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(_BATCH_ROWS, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, given)


#: How to empty the caches of the operator that a Python worker ran last.
_last: list[Callable[[], None]] = []


def _begin(forget: Callable[[], None] | None) -> None:
    while _last and _last[-1] is not forget:
        _last.pop()()
    if forget is not None and not _last:
        _last.append(forget)


def _give_back() -> None:
    """Hands free memory to the system, where its allocators know how to."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Batches], Batches], forget: Callable[[], None] | None = None) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, with its memory given back at the end of a task.

    A Python worker serves the tasks of all operators in turn and would otherwise hold the
    most that any of them took. ``forget`` empties the caches that ``run`` fills: they last
    from task to task until the worker runs another operator.
    """

    def task(batches: Batches) -> Batches:
        _begin(forget)
        yield from run(batches)
        _give_back()

    return task


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder."""
    path = f"{scratch_folder(df.sparkSession)}/{name}"
    with short_batches(df.sparkSession):
        df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._ledger_path = path
    return found


def discard(written: DataFrame) -> None:
    """Delete a table of :func:`write_and_read` that nothing will read again."""
    _delete(written.sparkSession, written._ledger_path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs that nothing refers to any more.

    Spark does so when the driver collects its garbage, which may be long after.
    """
    gc.collect()
    spark._jvm.System.gc()


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator reads, under its own names; a null text is empty."""
    return docs.select("doc_id", *more, F.coalesce(F.col("text"), F.lit("")).alias("text"))


#: Rows without an id count as documents behind all numbered ones.
UNNUMBERED = 1 << 62


@dataclass(frozen=True)
class DistinctTexts:
    """Documents with equal texts taken together.

    ``rows`` has a row per document: doc_id, id, n_bytes, tag, key, owner and copies. ``id``
    is the doc_id, or from ``UNNUMBERED`` on a number derived from the text where that is
    null. ``nodes`` has a row per distinct text: key, id and text. ``id`` is the smallest
    one with that text, which rows call ``owner``; ``key`` is the id too, but for all texts
    of a repeated id after its first. ``copies`` counts the rows with the text. Texts are
    told apart by 96 bits. ``nodes`` is hashed on the key into buckets, so that joins on
    the key leave the texts where they are.
    """

    rows: DataFrame
    nodes: DataFrame


def distinct_texts(docs: DataFrame) -> DistinctTexts:
    """Writes both tables to the shared folder. Null texts are empty."""
    spark, n = docs.sparkSession, shuffle_partitions(docs.sparkSession)
    ship(spark)
    tag, given = F.xxhash64("text"), F.col("doc_id").cast("long")
    marked = texts(docs).select(
        given.alias("doc_id"),
        F.coalesce(given, F.shiftrightunsigned(tag, 2) + UNNUMBERED).alias("id"),
        tag.alias("tag"),
        F.hash("text").alias("check"),
        "text",
    )
    slim = write_and_read(marked.select("doc_id", "id", "tag", "check", F.octet_length("text").cast("long").alias("n_bytes")), "marks")
    later = F.row_number().over(Window.partitionBy("id").orderBy("tag", "check")) > 1
    texts_of_id = slim.groupBy("id", "tag", "check").agg(F.count("*").alias("n"))
    keyed = texts_of_id.select(
        "id", "tag", "check", "n", F.when(later, F.shiftrightunsigned("tag", 2) + UNNUMBERED).otherwise(F.col("id")).alias("key")
    )
    owners = keyed.groupBy("tag", "check").agg(F.min(F.struct("id", "key")).alias("first"), F.sum("n").alias("copies"))
    owners = write_and_read(owners.select("tag", "check", F.col("first.id").alias("owner"), F.col("first.key").alias("key"), "copies"), "owners")
    rows = write_and_read(slim.join(owners, ["tag", "check"]), "rows")

    # Of repeated rows with one id and text, one is the node.
    nodes = (
        marked.select("id", "tag", "check", "text")
        .repartition(n, "id")
        .join(owners.select(F.col("owner").alias("id"), "tag", "check", "key"), ["id", "tag", "check"])
        .select("key", "id", "text", F.row_number().over(Window.partitionBy("id", "key").orderBy("tag")).alias("_copy"))
        .filter("_copy = 1")
        .drop("_copy")
    )
    name = f"ledgerlens_nodes_{uuid.uuid4().hex}"
    path = f"{scratch_folder(spark)}/nodes"
    nodes.repartition(n, "key").write.bucketBy(n, "key").option("path", path).option("compression", "zstd").saveAsTable(name)
    _scopes[-1].tables.append(name)
    del nodes
    discard(slim)
    discard(owners)
    release(spark)
    return DistinctTexts(rows, spark.table(name))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
