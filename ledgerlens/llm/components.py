"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common


def components(edges: DataFrame) -> DataFrame:
    """id and component (the smallest id) of every vertex of ``edges`` (a, b).

    Alternates two rewrites that keep the components: every vertex hands its larger
    neighbours, then its smaller ones, to the smallest vertex it knows. Each round is
    written to the shared folder; rounds grow with the logarithm of the size.
    """
    pairs = (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct()
    )
    pairs, seen = common.write_and_read(pairs, "edges"), None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        smallest = larger.groupBy("a").agg(F.min("b").alias("m"))
        star = larger.join(smallest, "a")
        smaller = star.select(F.col("b").alias("a"), F.col("m").alias("b")).union(star.select("a", F.col("m").alias("b")))
        before, pairs = pairs, common.write_and_read(smaller.filter("a > b").distinct(), "edges")
        common.discard(before)
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return pairs.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component").union(
        pairs.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
