"""Benchmark passages in documents.

Every run of ``window`` consecutive words of a benchmark item is a pattern; an item of
fewer words is one pattern. All patterns go into one Aho-Corasick automaton, which scans
each normalised document once. Matches are mapped back to word numbers and to byte offsets
of the original text.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common

#: Bytes of item text that one automaton is built from, about. A larger benchmark is
#: scanned for in several passes.
BLOCK_BYTES = 8 << 20

# Words are runs of ASCII letters and digits and of all bytes from 128; A-Z become a-z.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_AUTOMATA: dict = {}


def normalised(text: str) -> bytes:
    """UTF-8 bytes of the text, lower-cased, with a blank for each byte outside words."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS)


def patterns(items: list[tuple[str, str]], window: int) -> dict[str, tuple[list[str], int]]:
    """Pattern, one byte a character, to the ids of its items and its number of words."""
    found: dict[str, set[str]] = defaultdict(set)
    sizes = {}
    for item, text in items:
        words = normalised(text).decode("latin-1").split(" ")
        words = [w for w in words if w]
        for at in range(max(1, len(words) - window + 1) if words else 0):
            part = words[at : at + window]
            pattern = f" {' '.join(part)} "
            found[pattern].add(item)
            sizes[pattern] = len(part)
    return {p: (sorted(ids), sizes[p]) for p, ids in found.items()}


def _automaton(items: list[tuple[str, str]], window: int):
    key = hashlib.sha256(repr((items, window)).encode("utf-8", "surrogatepass")).digest()
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        automaton = ahocorasick.Automaton()
        for pattern, (ids, size) in patterns(items, window).items():
            automaton.add_word(pattern, (ids, size))
        if len(automaton):
            automaton.make_automaton()
        _AUTOMATA[key] = automaton
    return _AUTOMATA[key]


def scan(text: str, automaton) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]], list[str]]:
    """Number of words, hit runs of words, their byte offsets in the text, item ids."""
    raw = normalised(text)
    words = raw.split()
    if not words or not len(automaton):
        return len(words), [], [], []
    line = f" {b' '.join(words).decode('latin-1')} "
    runs: list[list[int]] = []
    items: set[str] = set()
    ends = None
    for end, (ids, size) in automaton.iter(line):
        if ends is None:  # only texts with a match need word numbers
            ends = np.cumsum([len(w) + 1 for w in words])
        last = int(np.searchsorted(ends, end)) + 1
        items.update(ids)
        runs.append([last - size, last])
    merged: list[list[int]] = []
    for a, b in sorted(runs):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    offsets = []
    if merged:
        held = np.r_[0, np.frombuffer(raw, dtype=np.uint8) != 32, 0]
        edges = np.diff(held.astype(np.int8))
        starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        offsets = [(int(starts[a]), int(stops[b - 1])) for a, b in merged]
    return len(words), [(a, b) for a, b in merged], offsets, sorted(items)




def _scan(shared, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared.value, window)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in batch.column("text").to_pylist():
                n, runs, spans, items = scan(text, automaton)
                for column, value in zip(
                    out,
                    (n, [{"first": a, "last": b} for a, b in runs], [{"start": a, "end": b} for a, b in spans], items),
                    strict=True,
                ):
                    column.append(value)
            pair = lambda a, b: pa.list_(pa.struct([(a, pa.int64()), (b, pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pair("first", "last")),
                    pa.array(out[2], pair("start", "end")),
                    pa.array(out[3], pa.list_(pa.string())),
                ],
                ["doc_id", "n_words", "runs", "spans", "items"],
            )

    return run


def _holds(shared, window: int):
    def run(text: pd.Series) -> pd.Series:
        automaton = _automaton(shared.value, window)
        return text.map(lambda t: bool(scan(t, automaton)[3]))

    return run


def hit_flag(docs: DataFrame, benchmark: DataFrame, column: str, window: int = 10) -> DataFrame:
    """``docs`` with a flag: whether the text holds a pattern of the benchmark. All columns,
    repeated rows and null texts (which hold none) pass through."""
    flag = F.lit(False)
    for items in item_blocks(benchmark):
        has = _holds(docs.sparkSession.sparkContext.broadcast(items), window)
        flag = flag | F.pandas_udf(has, "boolean")(F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumn(column, flag)


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """(id, text) of distinct items, in blocks of about ``BLOCK_BYTES``; one at least."""
    items = (
        benchmark.filter(F.col("text").isNotNull())
        .select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
        .distinct()
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        taken = items.filter(block == b).orderBy("item_id", "text").collect()  # about BLOCK_BYTES
        yield [(r["item_id"], r["text"]) for r in taken]


FOUND = "doc_id long, n_words long, runs array<struct<first:long,last:long>>, spans array<struct<start:long,end:long>>, items array<string>"


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, hit runs of words, their byte spans, item ids.

    Items are compared by their id as text; repeated items are one, a null id is the text
    ``null``. Null or empty texts have no words, as items they match nothing. Repeated
    documents give a row each. An empty benchmark leaves all documents clean. Other columns
    are ignored. A benchmark beyond ``BLOCK_BYTES`` is scanned for in blocks. The rows are
    numbered in a written table then, and the blocks' hits are joined per row.
    """
    spark = docs.sparkSession
    rows = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    blocks = item_blocks(benchmark)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return rows.mapInArrow(_scan(spark.sparkContext.broadcast(first), window), FOUND)
    # Each block reads the rows anew, so their numbers must be fixed.
    ids = F.struct(F.monotonically_increasing_id().alias("row"), "doc_id").alias("doc_id")
    numbered = common.write_and_read(rows.select(ids, "text"), "rows")
    found = FOUND.replace("doc_id long", "doc_id struct<row:long,doc_id:long>")
    parts = [numbered.mapInArrow(_scan(spark.sparkContext.broadcast(items), window), found) for items in chain((first, second), blocks)]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    hits = everything.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"),
        _maximal(F.array_sort(F.flatten(F.collect_list(F.arrays_zip("runs", "spans"))))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return hits.select("doc_id.doc_id", "n_words", F.col("hits.runs").alias("runs"), F.col("hits.spans").alias("spans"), "items")


def _maximal(hits):
    """Sorted runs of words and their spans, with those that overlap or touch as one."""

    def add(held, hit):
        last = F.get(held, F.size(held) - 1)
        joined = F.struct(
            F.struct(last["runs"]["first"].alias("first"), F.greatest(last["runs"]["last"], hit["runs"]["last"]).alias("last")).alias("runs"),
            F.struct(last["spans"]["start"].alias("start"), F.greatest(last["spans"]["end"], hit["spans"]["end"]).alias("end")).alias("spans"),
        )
        apart = F.concat(held, F.array(hit))
        return F.when(hit["runs"]["first"] <= last["runs"]["last"], F.concat(F.slice(held, 1, F.size(held) - 1), F.array(joined))).otherwise(apart)

    empty = F.array().cast("array<struct<runs:struct<first:long,last:long>,spans:struct<start:long,end:long>>>")
    return F.aggregate(hits, empty, add)


def hit_words(runs: str):
    """Words inside runs that may overlap, counted once; ``runs`` must be sorted."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    return F.aggregate(
        runs,
        start,
        lambda s, r: F.struct(
            (s["n"] + F.greatest(F.lit(0), r["last"] - F.greatest(r["first"], s["to"]))).cast("long").alias("n"),
            F.greatest(s["to"], r["last"]).alias("to"),
        ),
    )["n"]
