"""The tree of conversations' common beginnings, as double arrays by prefix shard.

Conversations are sorted by their turns over all partitions, so that a shard holds
neighbours and only nodes on its first and its last path can go on in other shards. A shard
numbers its distinct turns densely and packs its tree into two arrays: the child of slot s
by turn t is slot BASE[s] + t, and it is one if CHECK there is s. Walking the conversations
through the arrays gives the members of every node, walking CHECK back gives the sums over
subtrees. Nodes inside a shard are finished there. The others leave partial sums, which are
merged over all shards by the identity of the path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import common

#: Turns of a shard; it ends with the conversation that reaches them.
SHARD_TURNS = 1 << 18
#: Empty slots that are tried at once for a node of several children.
TRIED = 64

FREE, ROOT = -2, -1
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """BASE and CHECK of a tree whose nodes are given as (parent, turn) in breadth-first
    order, the root being node 0. ``slot`` tells where a node went."""

    def __init__(self, parent: np.ndarray, turn: np.ndarray) -> None:
        n, turns = len(parent), int(turn.max()) + 1 if len(turn) > 1 else 1
        size = 2 * (n + turns) + TRIED + 2
        self.base = np.zeros(size, dtype=np.int64)
        self.check = np.full(size, FREE, dtype=np.int64)
        self.check[0] = ROOT
        self.slot = np.zeros(n, dtype=np.int64)
        children = np.bincount(parent[1:], minlength=n) if n > 1 else np.zeros(n, dtype=np.int64)
        by_parent = 1 + np.argsort(parent[1:], kind="stable")
        begin = np.r_[0, np.cumsum(children)[:-1]]
        base_of = np.zeros(n, dtype=np.int64)
        used = np.zeros(size, dtype=bool)
        used[0] = True
        # Nodes of several children first, while the arrays are empty.
        several = np.flatnonzero(children > 1)
        for node in several[np.argsort(-children[several], kind="stable")].tolist():
            kids = by_parent[begin[node] : begin[node] + children[node]]
            codes = turn[kids]
            base_of[node] = self._fit(used, codes)
            used[base_of[node] + codes] = True
            self.slot[kids] = base_of[node] + codes
        single = np.flatnonzero(children == 1)
        if len(single):
            kids = by_parent[begin[single]]
            places = np.flatnonzero(~used)[: len(single)]
            base_of[single] = places - turn[kids]
            self.slot[kids] = places
        self.base[self.slot] = base_of
        self.check[self.slot[1:]] = self.slot[parent[1:]]

    @staticmethod
    def _fit(used: np.ndarray, codes: np.ndarray) -> int:
        free = np.flatnonzero(~used[: len(used) - int(codes.max() - codes.min()) - 1])
        low = int(codes.min())
        for at in range(0, len(free), TRIED):
            bases = free[at : at + TRIED] - low
            fits = ~used[bases[:, None] + codes[None, :]].any(axis=1)
            if fits.any():
                return int(bases[np.argmax(fits)])
        raise AssertionError("the arrays are long enough for every node")

    def step(self, slots: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The children's slots; -1 where there is no such child."""
        found = self.base[slots] + turns
        inside = (found >= 0) & (found < len(self.check))
        found = np.where(inside, found, 0)
        return np.where(inside & (self.check[found] == slots) & (found > 0), found, -1)


def _tree(codes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and turn of each node of sorted conversations, breadth first."""
    at = np.zeros(len(length), dtype=np.int64)
    parents, turns, made = [np.array([-1])], [np.array([0])], 1
    active, depth = np.flatnonzero(length > 0), 0
    while len(active):
        parent, turn = at[active], codes[begin[active] + depth]
        new = np.r_[True, (parent[1:] != parent[:-1]) | (turn[1:] != turn[:-1])]
        at[active] = made + np.cumsum(new) - 1
        parents.append(parent[new])
        turns.append(turn[new])
        made += int(new.sum())
        depth += 1
        active = active[length[active] > depth]
    return np.concatenate(parents), np.concatenate(turns)


def _path_keys(digests: list[bytes]) -> list[bytes]:
    """A key of each beginning of a path, the empty one first."""
    keys = [hashlib.blake2b(b"", digest_size=16).digest()]
    for digest in digests:
        keys.append(hashlib.blake2b(keys[-1] + digest, digest_size=16).digest())
    return keys


PARTS = (
    "part int, shard int, side int, edge boolean, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends string"
)
_KINDS = [
    pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(),
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
]
_NAMES = [field.split()[0] for field in PARTS.split(", ")]


def shard_nodes(part: int, shard: int, conv: np.ndarray, length: np.ndarray, digests: pa.Array, words: np.ndarray) -> pa.RecordBatch:
    """Rows of all nodes of a shard: finished ones, and parts of those on its two edges.

    The conversations are sorted by path and number. Of an edge node, counts of children,
    leaves and savings hold what lies inside the shard; ``ends`` lists its own last members.
    """
    coded = digests.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    begin = np.cumsum(length) - length
    trie = DoubleArray(*_tree(codes, begin, length))
    size = len(trie.check)
    n_convs, n_children, n_leaves, saved, weight = (np.zeros(size, dtype=np.int64) for _ in range(5))
    depth_of = np.full(size, -1, dtype=np.int64)
    least = np.full(size, np.iinfo(np.int64).max)

    # Down: the members of every node.
    at = np.zeros(len(conv), dtype=np.int64)
    n_convs[0], least[0], depth_of[0] = len(conv), conv.min(), 0
    levels = [np.array([0])]
    active, depth = np.flatnonzero(length > 0), 0
    while len(active):
        place = begin[active] + depth
        at[active] = slot = trie.step(at[active], codes[place])
        depth += 1
        np.add.at(n_convs, slot, 1)
        np.minimum.at(least, slot, conv[active])
        weight[slot] = words[place]
        depth_of[slot] = depth
        levels.append(slot[np.r_[True, slot[1:] != slot[:-1]]])
        active = active[length[active] > depth]

    # The two edges.
    edge = np.zeros(size, dtype=bool)
    sides, chains = [], []
    for row in {0: None, len(conv) - 1: None}:
        turns = codes[begin[row] : begin[row] + length[row]]
        slots = [0]
        for turn in turns.tolist():
            slots.append(int(trie.step(np.array(slots[-1:]), np.array([turn]))[0]))
        edge[slots] = True
        chains.append(_path_keys(coded.dictionary.take(pa.array(turns)).to_pylist()))
        sides.append(slots)

    # Back up: sums over subtrees, in which edge nodes do not count themselves.
    for slots in reversed(levels):
        inner = slots[~edge[slots]]
        n_leaves[inner] += n_children[inner] == 0
        saved[inner] += (n_convs[inner] - 1) * weight[inner]
        np.add.at(n_children, trie.check[inner], 1)
        below = slots[slots > 0]
        np.add.at(n_leaves, trie.check[below], n_leaves[below])
        np.add.at(saved, trie.check[below], saved[below])

    # Members that end at a node are neighbours, by rising number.
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    names = list(map(str, conv.tolist()))
    ends = {s: ",".join(names[a:b]) for s, a, b in zip(at[first].tolist(), first.tolist(), [*first[1:].tolist(), len(conv)], strict=True)}

    rows: list[tuple] = []
    key_of = {s: k for slots, keys in zip(sides, chains, strict=True) for s, k in zip(slots, keys, strict=True)}
    for s in np.flatnonzero((depth_of >= 0) & ~edge).tolist():
        parent = int(trie.check[s])
        listed = ends.get(s)
        rows.append((
            part, shard, 0, False, None, key_of.get(parent), int(depth_of[s]), int(least[s]), None if edge[parent] else int(least[parent]),
            int(n_convs[s]), int(n_children[s]), int(n_leaves[s]), int(saved[s]), int(weight[s]),
            hashlib.sha256(listed.encode()).hexdigest() if listed else EMPTY_HASH,
        ))
    told: set[int] = set()
    for side, (slots, keys) in enumerate(zip(sides, chains, strict=True)):
        for d, (s, key) in enumerate(zip(slots, keys, strict=True)):
            sums = (0, 0, 0, 0) if s in told else (int(n_convs[s]), int(n_children[s]), int(n_leaves[s]), int(saved[s]))
            rows.append((part, shard, side, True, key, keys[d - 1] if d else None, d, int(least[s]), None, *sums, int(weight[s]), None if s in told else ends.get(s)))
            told.add(s)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], _NAMES)


def _shards(turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        conv: list[np.ndarray] = []
        length: list[np.ndarray] = []
        digests: list[pa.Array] = []
        words: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            return shard_nodes(part, shard, np.concatenate(conv), np.concatenate(length), pa.concat_arrays(digests), np.concatenate(words))

        for batch in batches:
            sizes = batch.column("path").value_lengths().to_numpy().astype(np.int64)
            ends = np.r_[0, np.cumsum(sizes)]
            cost = np.cumsum(np.maximum(sizes, 1))
            flat, weights = batch.column("path").flatten(), batch.column("words").flatten().to_numpy().astype(np.int64)
            number = batch.column("conv_id").to_numpy()
            at = 0
            while at < len(sizes):
                done = int(cost[at - 1]) if at else 0
                to = min(len(sizes), int(np.searchsorted(cost, done + turns - held)) + 1)
                conv.append(number[at:to])
                length.append(sizes[at:to])
                digests.append(flat.slice(ends[at], ends[to] - ends[at]))
                words.append(weights[ends[at] : ends[to]])
                held += int(cost[to - 1]) - done
                at = to
                if held >= turns:
                    yield flush()
                    shard, held = shard + 1, 0
                    for kept in (conv, length, digests, words):
                        kept.clear()
        if conv:
            yield flush()

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per key over its lists, which follow each other in order."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, listed in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if k == key:
                state.update(b",")
            else:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(listed.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.binary(), pa.string()), strict=True)], ["key", "hash"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "hash"])


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: ``path`` (a digest of role and text each) and
    ``words`` (of each text). Nulls are empty texts; a null turn comes first; turns of one
    number are ordered by their digests. Rows without conv_id are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("given"),
            F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"),
            F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ).alias("turn"),
    )
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return ordered.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.words").alias("words"))


def rebuilt(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """As :func:`paths`, each conversation beginning like the first of its family of ids:
    its first crc32(conv_id) modulo ``most`` turns are those of that one, if any."""
    own = common.write_and_read(paths(conversations), "paths")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    heads = own.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head"), F.slice("path", 1, max(1, most - 1)).alias("head_path"), F.slice("words", 1, max(1, most - 1)).alias("head_words")
    )
    joined = own.withColumn("h", h).withColumn("head", F.col("conv_id") - F.col("conv_id") % family).join(heads, "head", "left")

    def spliced(column: str) -> Column:
        after = F.slice(column, F.col("h") + 1, F.greatest(F.size(column), F.lit(1)))
        return F.when(F.col(f"head_{column}").isNull(), after).otherwise(F.concat(F.slice(f"head_{column}", F.lit(1), F.col("h")), after))

    return joined.select("conv_id", spliced("path").alias("path"), spliced("words").alias("words"))


def prefix_nodes(found: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the tree of ``found`` (conv_id, distinct; path; words): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Every conversation is a member of the nodes it begins with, of the root even if it has no
    turn. Without conversations there is no node. A conversation travels whole, as 16 bytes
    a turn; shards end at ``shard_turns`` turns, wherever partitions end.
    """
    spark = found.sparkSession
    common.ship(spark)
    n = common.shuffle_partitions(spark)
    order = ["path", "conv_id"]
    found = common.write_and_read(found.select("conv_id", "path", "words"), "rebuilt")
    dealt = found.repartitionByRange(n, *order).sortWithinPartitions(*order)
    parts = common.write_and_read(dealt.mapInArrow(_shards(shard_turns), PARTS), "nodes")

    edges = parts.filter("edge")
    listed = edges.filter("ends is not null").select("key", "part", "shard", "ends")
    hashes = listed.repartition(n, "key").sortWithinPartitions("key", "part", "shard").mapInArrow(_ends, "key binary, hash string")
    merged = edges.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.min(F.struct("part", "shard", "side")).alias("home"),
    )
    merged = common.write_and_read(merged, "merged")
    kin = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more")).filter("key is not null")
    merged = common.write_and_read(
        merged.join(kin, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more").join(hashes, "key", "left"),
        "counted",
    )
    # What an edge node adds itself goes to its ancestors along one of the edges it is on.
    here = F.struct("part", "shard", "side") == F.col("home")
    chain = edges.select("key", "part", "shard", "side").join(merged.select("key", "depth", "home", "conv_id", "n_children", "n_convs", "words"), "key")
    below = Window.partitionBy("part", "shard", "side").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    own_leaf = F.when(here & (F.col("n_children") == 0), 1).otherwise(0)
    own_saved = F.when(here, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)
    sums = (
        chain.select("key", F.sum(own_leaf).over(below).alias("leaves"), F.sum(own_saved).over(below).alias("saved"))
        .groupBy("key")
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    outer = (
        merged.join(sums, "key")
        .join(parents, "parent_key", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.col("n_leaves") + F.col("leaves")).alias("n_leaves"),
            (F.col("saved_tokens") + F.col("saved")).alias("saved_tokens"),
            F.coalesce("hash", F.lit(EMPTY_HASH)).alias("ends_sha256"),
        )
    )
    # Children of edge nodes look up the parent's number within their own shard.
    known = chain.select("part", "shard", F.col("key").alias("parent_key"), F.col("conv_id").alias("edge_conv")).distinct()
    inner = parts.filter("not edge").join(known, ["part", "shard", "parent_key"], "left").select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "edge_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.col("ends").alias("ends_sha256"),
    )
    return outer.unionByName(inner)


def conversation_trie(conversations: DataFrame, family: int = 20, most: int = 4, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the rebuilt ``conversations`` (conv_id, turn, role, text); see
    :func:`rebuilt` and :func:`prefix_nodes`. Rows may repeat: each is a turn."""
    return prefix_nodes(rebuilt(conversations, family, most), shard_turns)
