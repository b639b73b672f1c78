"""Exact top-k inner products by norm buckets.

Candidates of a task are ordered by length and cut into buckets of similar length. For a
query, the k-th best score so far divided by the lengths of the query and of the longest
vector of a bucket is the cosine that a vector there must reach. Above 1 the bucket and
all shorter ones are skipped. A high cosine selects coordinate pruning: the query's largest
coordinates give a partial product, the lengths of the rests bound what is missing. A low
cosine selects length pruning: vectors too short for the cosine 1 are left out. What
remains is verified by its exact product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import common

BUCKET_ROWS = 512
#: Queries that are broadcast at once, about.
QUERY_BLOCK = 4_096
#: Coordinates of a query that coordinate pruning looks at, and the cosine that selects it.
FOCUS, COSINE = 8, 0.5
_EXACT = 2.0**52


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null if the vector or a component is null or
    not finite. Beyond the range of long, values are held at its ends."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(9.2e18)), F.lit(-9.2e18)))))


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer products, held at the ends of long where they exceed it."""
    bound = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)) * np.sqrt((query.astype(np.float64) ** 2).sum())
    if bound < _EXACT:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(r, query, strict=True)) for r in rows]
    return np.array([max(-(2**63), min(2**63 - 1, x)) for x in exact], dtype=np.int64)


class Best:
    """The k best (score, id) of one query: higher scores first, ties to smaller ids."""

    def __init__(self, k: int) -> None:
        self.k, self.score, self.id = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def threshold(self) -> float:
        return float(self.score[-1]) if len(self.score) == self.k else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.r_[self.score, score], np.r_[self.id, ids]
        order = np.lexsort((ids, ~score))[: self.k]  # ~ reverses the order without overflow
        self.score, self.id = score[order], ids[order]


def _padded(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v[:width]
    return out


def search_bucket(ids: np.ndarray, rows: np.ndarray, queries: list[tuple[int, np.ndarray, float, np.ndarray]], best: dict[int, Best]) -> None:
    """Offer one bucket to every query."""
    exact = rows.astype(np.float64)
    norms = np.sqrt((exact**2).sum(axis=1))
    longest = norms.max(initial=0.0)
    for at, (query_id, query, length, focus) in enumerate(queries):
        found = best[at]
        need = found.threshold()
        alive = ids != query_id
        if need > -np.inf:
            slack = need - 1e-9 * (1.0 + abs(need) + length * longest)
            if slack > length * longest:
                continue
            cosine = slack / max(length * longest, 1e-300)
            if cosine >= COSINE:  # coordinate pruning
                part = exact[:, focus] @ query[focus].astype(np.float64)
                rest_q = np.sqrt(max(length**2 - float((query[focus].astype(np.float64) ** 2).sum()), 0.0))
                rest = np.sqrt(np.maximum(norms**2 - (exact[:, focus] ** 2).sum(axis=1), 0.0))
                alive &= part + rest_q * rest * (1 + 1e-9) + 1e-6 >= slack
            else:  # length pruning
                alive &= norms * length * (1 + 1e-9) + 1e-6 >= slack
        kept = np.flatnonzero(alive)
        if len(kept):
            found.add(products(rows[kept], query), ids[kept])


def _search(queries_of, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = queries_of.value
        width = max((len(v) for _, v in raw), default=0)
        queries = []
        for query_id, vector in raw:
            q = _padded([vector], width)[0]
            queries.append((query_id, q, float(np.sqrt((q.astype(np.float64) ** 2).sum())), np.argsort(-np.abs(q.astype(np.float64)), kind="stable")[:FOCUS]))
        best = {at: Best(k) for at in range(len(queries))}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            rows = _padded(batch.column("vector").to_pylist(), width)
            for a in range(0, len(ids), BUCKET_ROWS):
                search_bucket(ids[a : a + BUCKET_ROWS], rows[a : a + BUCKET_ROWS], queries, best)
        sizes = [len(b.score) for b in best.values()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(queries)), sizes), pa.int32()),
                pa.array(np.repeat(np.array([q[0] for q in queries], np.int64), sizes), pa.int64()),
                pa.array(np.concatenate([np.empty(0, np.int64), *(b.id for b in best.values())]), pa.int64()),
                pa.array(np.concatenate([np.empty(0, np.int64), *(b.score for b in best.values())]), pa.int64()),
            ],
            ["number", "query_id", "vec_id", "score"],
        )

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best candidates, itself left out.

    ``vectors`` holds vec_id and embedding. Vectors that are null or hold null or
    non-finite components, and rows without an id, take no part. Vectors of different
    sizes are compared as if the shorter ended in zeros; an empty vector scores 0. A
    repeated id gives as many candidates, and as a query one result per distinct vector
    of it, each leaving all rows of its id out. Without vectors or queries the result is
    empty. Other columns are ignored.

    Queries are broadcast in blocks of a bounded size, and each block scans the vectors.
    """
    spark = vectors.sparkSession
    common.ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("vector"), is_query.alias("asks")).filter(
        "vec_id is not null and vector is not null"
    )
    asked = rows.filter("asks").select("vec_id", "vector").distinct()
    blocks = -(-asked.count() // QUERY_BLOCK)
    block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(max(blocks, 1)))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    by_length = rows.select("vec_id", "vector", square.alias("square")).sortWithinPartitions(F.desc("square")).select("vec_id", "vector")
    parts = []
    for b in range(blocks):
        taken = asked.filter(block == b).orderBy("vec_id", "vector").collect()  # about QUERY_BLOCK rows
        shared = spark.sparkContext.broadcast([(r["vec_id"], r["vector"]) for r in taken])
        found = by_length.mapInArrow(_search(shared, k), "number int, query_id long, vec_id long, score long")
        parts.append(found.withColumn("block", F.lit(b)))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    # A query is one vector of an id, so two vectors of one id have a list each.
    order = Window.partitionBy("block", "number").orderBy(F.desc("score"), "vec_id")
    return (
        everything.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
