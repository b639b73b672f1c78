import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerlens.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth int, key int"


def frame(spark, rows):
    """Conversations with further columns that are named like the operator's own."""
    return spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA)


def words(text):
    return len(text.translate({c: " " for c in range(9, 14)}).split(" ")) - text.translate({c: " " for c in range(9, 14)}).split(" ").count("")


def plain_nodes(rows, family=20, most=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(own.items()):
        h = zlib.crc32(str(c).encode()) % most
        rest = int(abs(c) % family) * (1 if c >= 0 else -1)
        path = tuple(own.get(c - rest, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []

    def below(p):
        todo, found = [p], []
        while todo:
            found.append(todo.pop())
            todo += children[found[-1]]
        return found

    for p, m in members.items():
        subtree = below(p)
        out.append((
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), sum(not children[q] for q in subtree),
            sum((len(members[q]) - 1) * words(q[-1][1]) for q in subtree if q), hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def got(result):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[c] for c in names) for r in result.collect()), key=str)


def mixed(seed, convs, turns=6, texts=3):
    draw = random.Random(seed)
    rows = []
    for c in range(-25, convs):
        for turn in range(draw.randint(1, turns)):
            number = draw.choice([turn, turn, turn, None])
            rows.append((c, number, draw.choice(["user", "user", None]), draw.choice([*(f"w {i}\tx" for i in range(texts)), None, ""])))
    return rows


@pytest.mark.parametrize("shard_turns", [1, 7, 1 << 18])
def test_nodes_equal_a_plain_tree(spark, shard_turns):
    rows = mixed(2, 150)
    rows += [(500, t, "user", f"deep {t}") for t in range(300)] + [(520, t, "user", f"deep {t}") for t in range(299)]
    rows += [(540, 3, "user", "same"), (540, 3, "user", "same"), (540, 3, "a", "same"), (None, 1, "user", "x"), (701, 0, "user", "only")]
    assert got(prefix_trie.conversation_trie(frame(spark, rows), shard_turns=shard_turns)) == plain_nodes(rows)


def test_most_conversations_alike(spark):
    # A node's members and its list of ends go through many shards.
    rows = [(c, t, "user", f"hello {t}") for c in range(0, 4000) for t in range(2)]
    rows += [(c, 0, "user", f"other {c % 7}") for c in range(4000, 4200)]
    assert got(prefix_trie.conversation_trie(frame(spark, rows), shard_turns=100)) == plain_nodes(rows)


def test_no_turns_left(spark):
    # Conversations whose turns are all replaced, by a beginning that is absent, are at the root.
    absent = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3][:2]
    rows = [(c, 0, "user", "gone") for c in absent]
    empty = hashlib.sha256(",".join(map(str, absent)).encode()).hexdigest()
    assert got(prefix_trie.conversation_trie(frame(spark, rows))) == [(absent[0], 0, None, 2, 0, 1, 0, empty)]


def test_no_conversations(spark):
    assert got(prefix_trie.conversation_trie(frame(spark, []))) == []
    assert got(prefix_trie.conversation_trie(frame(spark, [(None, 0, "user", "x")]))) == []


def test_double_array_holds_the_tree():
    draw = np.random.default_rng(3)
    parent, turn, seen = [-1], [0], set()
    while len(parent) < 3000:
        p, t = int(draw.integers(0, max(1, len(parent) // 3))), int(draw.integers(0, 900))
        if (p, t) not in seen:
            seen.add((p, t))
            parent.append(p)
            turn.append(t)
    order = np.argsort(parent, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    parents = np.array([-1 if p < 0 else place[p] for p in np.array(parent)[order]])
    turns = np.array(turn)[order]
    trie = prefix_trie.DoubleArray(parents, turns)
    assert len(set(trie.slot.tolist())) == len(parents)
    assert (trie.step(trie.slot[parents[1:]], turns[1:]) == trie.slot[1:]).all()
    known = set(zip(parents.tolist(), turns.tolist(), strict=True))
    for p in range(200):
        for t in range(0, 900, 13):
            if (p, t) not in known:
                assert trie.step(trie.slot[[p]], np.array([t]))[0] == -1
