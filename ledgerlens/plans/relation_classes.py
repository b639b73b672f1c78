"""All relations between entities in a compact form: classes, links between them, members.

Listing every related pair is quadratic in the holders of a shared value. Two things make
the list short without losing a pair. Entities with equal contacts form a node, as they have
the same relations. And values that more nodes hold than can be listed in pairs ("wide"
values, such as a switchboard) relate whole hubs, a hub being the nodes with the same wide
values: two hubs that share one are a single link, whose text names their common wide values.
Pairs that share a narrower value as well are listed node by node, with all they share, and
are not counted in the hubs' link again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.skew import known_heavy, salted_join
from ledgerlens.plans.related import PAIR, VALUE, describe
from ledgerlens.sources.store import materialize

#: Nodes that may share a value before it is wide.
LISTED = 200


@dataclass(frozen=True)
class RelationClasses:
    """``members``: entity, node, hub (null without a wide value). ``links``: kind ('node' or
    'hub'), a, b (a <= b, named after their smallest entities), n_links (related pairs of
    entities), relationship, relationship_detail. A link of a class with itself is about the
    pairs within it."""

    members: DataFrame
    links: DataFrame


def _nodes(contacts: DataFrame) -> DataFrame:
    """node, size and contacts (sorted) of every distinct set of contacts."""
    held = contacts.groupBy("entity").agg(F.array_sort(F.collect_set(F.struct(*VALUE))).alias("contacts"))
    return materialize(held, "held")


def _spread(big: DataFrame, small: DataFrame, on: list[str], spread_by: str) -> DataFrame:
    """Inner join of a written table whose keys may be dominant."""
    return salted_join(big, small, on, [spread_by], "inner", known_heavy(big, on))


def _pairs_of(size: Column) -> Column:
    return (size * (size - 1) / 2).cast("long")


def relation_classes(contacts: DataFrame, listed: int = LISTED) -> RelationClasses:
    """The classes of ``contacts`` (entity, rel, val).

    Repeated contacts are one. Entities whose contacts nobody shares are members of a node
    of their own without links. Rows grow with the contacts, with ``listed`` for each of
    them at most, and with the pairs of hubs that share a wide value.
    """
    held = _nodes(contacts)
    classes = held.groupBy("contacts").agg(F.min("entity").alias("node"), F.count("*").alias("size"))
    nodes = materialize(classes.select("node", "size", "contacts"), "nodes")
    # A class may hold most entities: its one row is repeated, its members are spread.
    member_of = _spread(held, nodes.select("contacts", "node"), ["contacts"], "entity").select("entity", "node")
    member_of = materialize(member_of, "members")

    values = materialize(nodes.select("node", "size", F.explode("contacts").alias("c")).select("node", "size", "c.rel", "c.val"), "values")
    holders = materialize(values.groupBy(*VALUE).agg(F.count("*").alias("holders")), "holders")
    wide = materialize(_spread(values, holders.filter(F.col("holders") > listed), VALUE, "node").select("node", "size", *VALUE), "wide")
    hub_sets = materialize(wide.groupBy("node", "size").agg(F.array_sort(F.collect_set(F.struct(*VALUE))).alias("wide")), "hub-sets")
    hubs = hub_sets.groupBy("wide").agg(F.min("node").alias("hub"), F.sum("size").alias("hub_size"))
    hubs = materialize(hubs, "hubs")
    hub_of = materialize(_spread(hub_sets, hubs, ["wide"], "node").select("node", "hub", "wide"), "hub-of")

    # Nodes that share a narrow value, and all they share.
    narrow = materialize(values.join(holders.filter(F.col("holders").between(2, listed)), VALUE).select("node", *VALUE), "narrow")
    left, right = narrow.withColumnRenamed("node", "a"), narrow.withColumnRenamed("node", "b")
    near = materialize(left.join(right, VALUE).filter("a < b").select(*PAIR, *VALUE), "near")
    of_a, of_b = (hub_of.select(F.col("node").alias(c), F.col("wide").alias(f"wide_{c}")) for c in PAIR)
    both = near.select(*PAIR).distinct().join(of_a, "a").join(of_b, "b")
    common = both.select(*PAIR, F.explode(F.array_intersect("wide_a", "wide_b")).alias("c")).select(*PAIR, "c.rel", "c.val")
    alike = nodes.filter("size > 1").select(F.col("node").alias("a"), F.col("node").alias("b"), F.explode("contacts").alias("c"))
    evidence = near.unionByName(common).unionByName(alike.select(*PAIR, "c.rel", "c.val"))
    size_a, size_b = (nodes.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}")) for c in PAIR)
    links = describe(evidence).join(size_a, "a").join(size_b, "b")
    n_links = F.when(F.col("a") == F.col("b"), _pairs_of(F.col("size_a"))).otherwise(F.col("size_a") * F.col("size_b"))
    node_links = materialize(links.withColumn("n_links", n_links), "links")

    # Hubs that share a wide value; what is listed above is taken off their count.
    in_hub = hubs.select("hub", "hub_size", F.explode("wide").alias("c")).select("hub", "hub_size", "c.rel", "c.val")
    one, other = (in_hub.select(F.col("hub").alias(c), F.col("hub_size").alias(f"size_{c}"), *VALUE) for c in PAIR)
    hub_pairs = materialize(one.join(other, VALUE).filter("a <= b"), "hub-pairs")
    hub_a, hub_b = (hub_of.select(F.col("node").alias(c), F.col("hub").alias(f"hub_{c}")) for c in PAIR)
    listed_in = (
        node_links.join(hub_a, "a")
        .join(hub_b, "b")
        .groupBy(F.least("hub_a", "hub_b").alias("a"), F.greatest("hub_a", "hub_b").alias("b"))
        .agg(F.sum("n_links").alias("listed"))
    )
    sizes = hub_pairs.select(*PAIR, "size_a", "size_b").distinct()
    all_pairs = F.when(F.col("a") == F.col("b"), _pairs_of(F.col("size_a"))).otherwise(F.col("size_a") * F.col("size_b"))
    hub_links = (
        describe(hub_pairs.select(*PAIR, *VALUE))
        .join(sizes, PAIR)
        .join(listed_in, PAIR, "left")
        .withColumn("n_links", all_pairs - F.coalesce("listed", F.lit(0)))
        .filter("n_links > 0")
    )
    columns = [*PAIR, "n_links", "relationship", "relationship_detail"]
    links = node_links.select(F.lit("node").alias("kind"), *columns).unionByName(hub_links.select(F.lit("hub").alias("kind"), *columns))
    members = member_of.join(hub_of.select("node", "hub"), "node", "left").select("entity", "node", "hub")
    return RelationClasses(members, links)


def expanded(classes: RelationClasses) -> DataFrame:
    """Every related pair of entities with its texts: quadratic where a value is widely
    shared, so for small data or a few asked classes."""
    of = [classes.members.select(F.col("entity").alias(f"entity_{c}"), F.col("node").alias(f"node_{c}"), F.col("hub").alias(f"hub_{c}")) for c in PAIR]
    texts = ["relationship", "relationship_detail"]

    def pairs(kind: str) -> DataFrame:
        links = classes.links.filter(F.col("kind") == kind).select(F.col("a").alias(f"{kind}_a"), F.col("b").alias(f"{kind}_b"), *texts)
        met = links.join(of[0], f"{kind}_a").join(of[1], f"{kind}_b")
        once = (F.col(f"{kind}_a") != F.col(f"{kind}_b")) | (F.col("entity_a") < F.col("entity_b"))
        ordered = [F.least("entity_a", "entity_b").alias("a"), F.greatest("entity_a", "entity_b").alias("b")]
        return met.filter(once).select(*ordered, *texts)

    listed = pairs("node")
    return listed.unionByName(pairs("hub").join(listed.select(*PAIR), PAIR, "left_anti"))
