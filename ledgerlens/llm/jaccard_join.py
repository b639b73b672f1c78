"""Exact Jaccard self-join of word-shingle sets, size-aware, with components of its links.

Sets that link share almost all of their shingles, so they share some of their rarest ones.
Small ("light") sets enumerate all two-element subsets of their rare shingles and meet
where they share a subset. Large ("heavy") sets are listed under each single rare shingle,
as are the sets of a size that can link with them, and the lists are scanned. The boundary
between the two is the size at which the summed cost is smallest.

Three things keep groups of copies cheap without losing a link:

- Equal texts are one node from the start.
- Sets are first gathered by a few of their least shingles and compared within a gathering
  of bounded size. Those links are real; most of each group is connected by them.
- Lists then only yield sets and labels of components that may link but are not connected
  yet. Each such set is compared with all sets of that component.

Two sets on a common list mostly do not link. Each set has a sketch, the parities of its
shingles' hashes: every bit in which two sketches differ needs a shingle that one set has and
the other has not, and linked sets have few of these. Pairs that differ in more bits are left
out at the list, where they would otherwise be named; no link is among them.

The order "rare first" comes from a bounded table of frequent shingles. Any order that all
sets share gives the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.components import components
from ledgerlens.llm.shingles import forget, mix, shingle_set

#: Frequent shingles in the order table at most, and how often a task must see one.
FREQUENT, FREQUENT_IN_TASK = 1 << 19, 2
#: Least shingles of a set that it is gathered by, and sets that one gathering compares.
GATHERINGS, GATHERED = 4, 500
#: Cost of scanning a list entry against that of making a subset.
SCAN_COST = 4.0
#: Sizes told apart in the cost table.
SIZES = 512
#: Bits of the filter in front of the table of frequent shingles, as a power of two.
FILTER = 23
#: Bits of a sketch: the next power of two from the set's size on, between these.
SKETCH = (64, 4096)
#: Words of sketches that are compared together.
WORDS = 1 << 19
#: Entries of one list that a task holds; longer lists are worked block against block.
LIST_BLOCK = 20_000
#: Entries of short lists that a task looks at together.
LIST_ROWS = 50_000


def needed(size: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap that a set of this size links with."""
    return -(-percent * size // 100)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[at.clip(max=len(b) - 1)] == a).sum())
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


class RareFirst:
    """Orders shingles by known frequency, then by value."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(shingles)
        self.keys, self.counts = shingles[order], counts[order]
        self.filter = np.zeros(1 << FILTER, dtype=bool)
        self.filter[self._slot(self.keys)] = True

    @staticmethod
    def _slot(shingles: np.ndarray) -> np.ndarray:
        return (shingles >> np.uint64(64 - FILTER)).astype(np.int64)

    def frequency(self, shingles: np.ndarray) -> np.ndarray:
        found = np.zeros(len(shingles), dtype=np.int64)
        maybe = np.flatnonzero(self.filter[self._slot(shingles)])
        if len(maybe):
            some = shingles[maybe]
            at = np.searchsorted(self.keys, some).clip(max=len(self.keys) - 1)
            found[maybe] = np.where(self.keys[at] == some, self.counts[at], 0)
        return found

    def first(self, shingles: np.ndarray, k: int) -> np.ndarray:
        """The first ``k`` of ascending shingles in this order."""
        frequency = self.frequency(shingles)
        unknown = shingles[frequency == 0]
        if len(unknown) >= k:
            return unknown[:k]
        return shingles[np.lexsort((shingles, frequency))[:k]]


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the shingles' low bits: half as many parities are the two halves' xor."""
    bits = SKETCH[0]
    while bits < min(len(shingles), SKETCH[1]):
        bits *= 2
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


class Sketches:
    """Sketches of the entries of a list, compared at the shorter one's length."""

    def __init__(self, bodies: list[bytes]) -> None:
        self.words = np.array([len(b) // 8 for b in bodies], dtype=np.int64)
        self.rows: dict[int, np.ndarray] = {}
        for words in np.unique(self.words).tolist():
            own = np.flatnonzero(self.words == words)
            matrix = np.frombuffer(b"".join(bodies[i] for i in own.tolist()), dtype=np.uint64).reshape(len(own), words)
            while words:
                at = self.rows.setdefault(words, np.zeros((len(bodies), words), dtype=np.uint64))
                at[own] = matrix
                words //= 2
                matrix = matrix[:, :words] ^ matrix[:, words:] if words else matrix

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bits in which the sketches of each pair of entries differ."""
        found, least = np.zeros(len(a), dtype=np.int64), np.minimum(self.words[a], self.words[b])
        for words in np.unique(least).tolist():
            here, rows = np.flatnonzero(least == words), self.rows[words]
            for at in range(0, len(here), max(1, WORDS // words)):
                some = here[at : at + max(1, WORDS // words)]
                found[some] = np.bitwise_count(rows[a[some]] ^ rows[b[some]]).sum(axis=1, dtype=np.int64)
        return found


def most_different(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that linked sets of these sizes can have apart from each other at most."""
    return n + m - 2 * -(-percent * (n + m) // (100 + percent))


#: What one look at every set leaves: its size, its least shingles, frequent shingles.
SIZE, SIGN, FREQUENCY = 0, 1, 2
LOOK = "kind int, id long, value long, sketch binary"


class _Counts:
    """Shingles that recur within a task, counted in chunks of bounded size."""

    def __init__(self) -> None:
        self.values, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, shingles: np.ndarray) -> None:
        self.waiting.append(shingles)
        self.held += len(shingles)
        if self.held > 4_000_000:
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        v, n = np.unique(np.concatenate(self.waiting), return_counts=True)
        again = (n > 1) | np.isin(v, self.values, assume_unique=True)
        v, n = np.r_[self.values, v[again]], np.r_[self.counts, n[again]]
        self.values, at = np.unique(v, return_inverse=True)
        self.counts = np.bincount(at, weights=n, minlength=len(self.values)).astype(np.int64)
        if len(self.values) > 4 * FREQUENT:
            top = np.sort(np.argsort(-self.counts, kind="stable")[:FREQUENT])
            self.values, self.counts = self.values[top], self.counts[top]
        self.waiting, self.held = [], 0


def _looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``LOOK``: (SIZE, id, size, sketch), (SIGN, id, shingle), (FREQUENCY, sets, shingle)."""

    def rows(kind: int, ids: np.ndarray, values: np.ndarray, sketches: list[bytes] | None = None) -> pa.RecordBatch:
        drawn = pa.nulls(len(ids), pa.binary()) if sketches is None else pa.array(sketches, pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids), pa.array(values), drawn], ["kind", "id", "value", "sketch"]
        )

    seen = _Counts()
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        least, sizes, sketches = [], [], []
        for text in batch.column("text").to_pylist():
            s = shingle_set(text)
            seen.add(s)
            least.append(s[:GATHERINGS].view(np.int64))
            sizes.append(len(s))
            sketches.append(sketch(s).tobytes())
        yield rows(SIZE, ids, np.array(sizes, dtype=np.int64), sketches)
        yield rows(SIGN, np.repeat(ids, [len(x) for x in least]), np.concatenate([np.empty(0, np.int64), *least]))
    seen.settle()
    kept = seen.counts >= FREQUENT_IN_TASK
    yield rows(FREQUENCY, seen.counts[kept], seen.values[kept].view(np.int64))


#: Shingles whose membership in a block of sets is laid out at once.
COLUMNS = 4_096
#: Pairs that are looked at one by one instead.
FEW = 16
#: Members of a label on one list from which on they count as a block.
BLOCK = 8


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``left`` with every set of ``right``.

    Shingles that both sides hold are numbered; their lists are scanned a block of
    shingles at a time, as products of membership matrices.
    """
    a, b = (np.concatenate([np.empty(0, np.uint64), *side]) for side in (left, right))
    common_shingles = np.intersect1d(a, b)
    sizes = np.zeros((len(left), len(right)), dtype=np.float32)
    places = []
    for values, side in ((a, left), (b, right)):
        owner = np.repeat(np.arange(len(side)), [len(x) for x in side])
        at = np.searchsorted(common_shingles, values).clip(max=max(len(common_shingles) - 1, 0))
        held = common_shingles[at] == values if len(common_shingles) else np.zeros(len(values), bool)
        order = np.argsort(at[held], kind="stable")
        places.append((owner[held][order], at[held][order]))
    for start in range(0, len(common_shingles), COLUMNS):
        blocks = []
        for (owner, at), side in zip(places, (left, right), strict=True):
            lo, hi = np.searchsorted(at, (start, start + COLUMNS))
            block = np.zeros((len(side), COLUMNS), dtype=np.float32)
            block[owner[lo:hi], at[lo:hi] - start] = 1.0
            blocks.append(block)
        sizes += blocks[0] @ blocks[1].T
    return sizes.astype(np.int64)


def link_matrix(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    if len(left) * len(right) <= FEW:
        return np.array([[linked(a, b, percent) for b in right] for a in left], dtype=bool)
    both = overlaps(left, right)
    union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :] - both
    return (both > 0) & (100 * both >= percent * union)


def connect(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """An edge from the least id of each component among the sets to every other one."""
    links = link_matrix(sets, sets, percent)
    np.fill_diagonal(links, True)
    least = np.array(ids, dtype=np.int64)
    while True:
        spread = np.where(links, least[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (spread == least).all():
            return [(int(a), int(b)) for a, b in zip(least, ids, strict=True) if a != b]
        least = spread


def _edges(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = list(zip(*edges, strict=True)) if edges else [[], []]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["a", "b"])


def _by_group(keys: list[str], size: int, link: Callable[[list[dict]], list[tuple[int, int]]]):
    """Calls ``link`` with the rows of each group; the input has groups together, and none
    has more than about ``size`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key = [], None
        for batch in batches:
            edges = []
            for at in range(0, batch.num_rows, size):
                for row in batch.slice(at, size).to_pylist():
                    of_row = tuple(row[k] for k in keys)
                    if of_row != key:
                        edges += link(group)
                        group, key = [], of_row
                    group.append(row)
            yield _edges(edges)
        yield _edges(link(group))

    return run


def _grouped(rows: DataFrame, keys: list[str], link: Callable[[list[dict]], list[tuple[int, int]]]) -> DataFrame:
    n = common.shuffle_partitions(rows.sparkSession)
    return rows.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(common.lean(_by_group(keys, GATHERED, link), forget), "a long, b long")


def _connect_gathered(percent: int):
    def link(rows: list[dict]) -> list[tuple[int, int]]:
        distinct = list({(r["id"], r["text"]): r for r in rows}.values())
        if len(distinct) < 2:
            return []
        return connect(np.array([r["id"] for r in distinct]), [shingle_set(r["text"]) for r in distinct], percent)

    return link


def boundary(sizes: dict[int, int], percent: int) -> int:
    """Largest size whose sets are light, by the cost of subsets and of lists to scan."""
    n = np.arange(SIZES + 1, dtype=np.float64)
    sets = np.array([sizes.get(int(k), 0) for k in n], dtype=np.float64)
    prefix = n - needed(n, percent) + 1
    light = np.cumsum(sets * (prefix + 1) * prefix / 2)
    scans = sets * prefix * SCAN_COST
    scans_above = scans.sum() - np.cumsum(scans)
    # Sets that are light themselves but can link with heavier ones are listed as well.
    below = np.array([scans[int(needed(np.int64(k + 1), percent)) : k + 1].sum() for k in range(SIZES + 1)])
    return int(np.argmin(light + scans_above + below))


def _listed(table, light: int, percent: int):
    """Postings of each set: subsets of two if it is light, rare shingles if a heavy set may
    be among its partners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = RareFirst(*table.value)
        for batch in batches:
            signs, lengths, places, sizes = [], [], [], []
            labels = batch.column("label").to_pylist()
            for text in batch.column("text").to_pylist():
                s = shingle_set(text)
                n = len(s)
                prefix = n - int(needed(np.int64(n), percent)) + 1 if n else 0
                s = rare.first(s, prefix + 1)
                made, at = [], []
                if 2 <= n <= light:
                    few = mix(s)
                    i, j = np.triu_indices(len(few), 1)
                    made.append(mix(few[i] * np.uint64(3) + few[j]) | np.uint64(1))
                    at.append(j)
                if n == 1 or n and 100 * n >= percent * (light + 1):
                    made.append(s[:prefix] & ~np.uint64(1))
                    at.append(np.arange(prefix))
                signs += made
                places += at
                lengths.append(sum(map(len, made)))
                sizes.append(n)
            rows = np.repeat(np.arange(len(sizes)), lengths)
            take = lambda name: np.array(batch.column(name).to_pylist(), dtype=np.int64)[rows]
            n = np.array(sizes, dtype=np.int64)[rows] if len(rows) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.empty(0, np.uint64), *signs]).view(np.int64)),
                    pa.array(take("id") if len(rows) else n),
                    pa.array(np.array(labels, dtype=np.int64)[rows] if len(rows) else n),
                    pa.array(n.astype(np.int32)),
                    pa.array(np.concatenate([np.empty(0, np.int64), *places]).astype(np.int32)),
                ],
                ["sign", "id", "label", "n", "place"],
            )

    return run


@dataclass(frozen=True)
class Entries:
    """Entries of some lists, as columns. ``part`` tells the two sides of a block of a long
    list apart; within a list that is held whole all are 0."""

    sign: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    n: np.ndarray
    place: np.ndarray
    part: np.ndarray
    sketches: Sketches
    two_sided: np.ndarray

    def may_link(self, a: np.ndarray, b: np.ndarray, light: int, percent: int) -> np.ndarray:
        """Whether the sets of each pair of entries of one list are of different labels, of
        sizes that link, share enough from their places on and are alike in their sketches.

        Lists of subsets have odd signs. Two light sets on an even one meet on odd ones, too.
        """
        n, m, at, to = self.n[a], self.n[b], self.place[a], self.place[b]
        both = -(-percent * (n + m) // (100 + percent))  # overlap that this pair needs
        # The common shingle and what comes after its place in either set.
        reach = np.minimum(n - at, m - to) + np.minimum(at, to)
        small, large = np.minimum(n, m), np.maximum(n, m)
        twice = (self.sign[a] & 1 == 0) & (small >= 2) & (large <= light)
        ok = (self.label[a] != self.label[b]) & (100 * small >= percent * large) & (reach >= both) & ~twice
        ok &= ~self.two_sided[a] | (self.part[a] != self.part[b])
        some = np.flatnonzero(ok)
        ok[some] = self.sketches.differ(a[some], b[some]) <= most_different(n[some], m[some], percent)
        return ok


def pairs_of_lists(e: Entries, kept: np.ndarray, light: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs among the ``kept`` entries that are on a common list and may link.

    Entries of a list are ordered by size, so partners of an entry end where they get too
    large, and larger steps have fewer entries left to look at.
    """
    order = kept[np.lexsort((e.ids[kept], e.n[kept], e.sign[kept]))]
    sign, n = e.sign[order], e.n[order]
    at, step = np.arange(len(order)), 1
    found = [(order[:0], order[:0])]
    while len(at):
        at = at[at + step < len(order)]
        to = at + step
        near = (sign[at] == sign[to]) & (100 * n[at] >= percent * n[to])
        at, to = at[near], to[near]
        ok = e.may_link(order[at], order[to], light, percent)
        if ok.any():
            found.append((order[at[ok]], order[to[ok]]))
        step += 1
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def candidates(e: Entries, light: int, percent: int) -> np.ndarray:
    """Distinct (id, label): sets that must be compared with all sets of another label.

    A label with many entries on a list is one block there: another entry of the list is a
    candidate for it as soon as it may link with one of them. Entries outside such blocks
    are looked at in pairs.
    """
    order = np.lexsort((e.label, e.sign))
    sign, label = e.sign[order], e.label[order]
    if not len(sign):
        return np.empty((0, 2), np.int64)
    # Entries of one label on one list, and the largest such group of each list.
    groups = np.flatnonzero(np.r_[True, (sign[1:] != sign[:-1]) | (label[1:] != label[:-1])])
    members = np.diff(np.r_[groups, len(sign)])
    by_list = np.lexsort((-members, sign[groups]))
    top = by_list[np.r_[True, np.diff(sign[groups][by_list]) != 0]]
    of_list = np.cumsum(np.r_[True, sign[1:] != sign[:-1]]) - 1
    block = members[top] >= BLOCK
    main = label[groups[top]][of_list]
    outside = ~block[of_list] | (label != main)
    found = []
    lists = np.flatnonzero(np.r_[True, sign[1:] != sign[:-1]])
    ends = np.r_[lists[1:], len(sign)]
    for k in np.flatnonzero(block).tolist():
        others = lists[k] + np.flatnonzero(outside[lists[k] : ends[k]])
        core = order[groups[top[k]] : groups[top[k]] + members[top[k]]]
        for at in range(0, len(others), max(1, PAIRS // len(core))):
            asking = order[others[at : at + max(1, PAIRS // len(core))]]
            a, b = np.repeat(asking, len(core)), np.tile(core, len(asking))
            some = e.may_link(a, b, light, percent).reshape(len(asking), len(core)).any(axis=1)
            ids = e.ids[asking[some]]
            found.append(np.stack([ids, np.full(len(ids), e.label[core[0]])], axis=1))
    a, b = pairs_of_lists(e, order[outside], light, percent)
    # The one with the larger label is compared with the label of the other.
    x, y = np.where(e.label[a] > e.label[b], a, b), np.where(e.label[a] > e.label[b], b, a)
    found.append(np.stack([e.ids[x], e.label[y]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


#: Pairs that are looked at together.
PAIRS = 1 << 17
POSTING = ["sign", "id", "label", "n", "place"]
SHARED = "sign long, id long, label long, n int, place int, block int"


def _shared(size: int):
    """Entries of lists that hold several labels; the input has the entries of a list
    together. Of a list, ``size`` entries are held at most: a longer one is passed on in
    numbered blocks, whatever its labels."""

    def rows(columns: list[np.ndarray], blocks: np.ndarray) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(blocks.astype(np.int32))], [*POSTING, "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64) for _ in POSTING]
        long, block = None, 0  # the list that is being passed on in blocks, and its next one

        def whole(columns: list[np.ndarray]) -> pa.RecordBatch:
            """Of complete lists; one may be the last block of a long one."""
            sign, label = columns[0], columns[2]
            starts = np.flatnonzero(np.r_[True, sign[1:] != sign[:-1]])
            mixed = np.minimum.reduceat(label, starts) != np.maximum.reduceat(label, starts)
            blocks = np.zeros(len(sign), dtype=np.int64) if long is None else np.where(sign == long, block, 0)
            kept = np.repeat(mixed, np.diff(np.r_[starts, len(sign)])) | (blocks > 0)
            return rows([c[kept] for c in columns], blocks[kept])

        for batch in batches:
            held = [np.concatenate([old, batch.column(c).to_numpy().astype(np.int64)]) for old, c in zip(held, POSTING, strict=True)]
            if not len(held[0]):
                continue
            last = int(np.searchsorted(held[0], held[0][-1]))
            if last:
                yield whole([c[:last] for c in held])
                held = [c[last:] for c in held]
            while len(held[0]) >= size:
                if held[0][0] != long:
                    long, block = held[0][0], 0
                yield rows([c[:size] for c in held], np.full(size, block))
                held, block = [c[size:] for c in held], block + 1
        if len(held[0]):
            yield whole(held)

    return run


def _candidates(light: int, percent: int, together: int):
    """Candidates of lists, or pairs of blocks of a list, which the input has together."""

    def look(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        sign, ids, label, n, place, low, high, block = (
            table.column(c).to_numpy().astype(np.int64) for c in (*POSTING, "low", "high", "block")
        )
        # Blocks of one list are lists of their own here; the lowest bit of a sign stays.
        own = np.unique(np.stack([sign, low, high], axis=1), axis=0, return_inverse=True)[1].reshape(-1)
        entries = Entries(own * 2 + (sign & 1), ids, label, n, place, block, Sketches(table.column("sketch").to_pylist()), low != high)
        pairs = candidates(entries, light, percent)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["id", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("sign", "low", "high")], axis=1)
            edges = [0, *(1 + np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))).tolist()]
            if held and size >= together:
                before = held[-1].slice(held[-1].num_rows - 1, 1).to_pylist()[0]
                cut = edges[0] if tuple(keys[0].tolist()) != (before["sign"], before["low"], before["high"]) else next(iter(edges[1:]), None)
                if cut is not None:
                    yield look([*held, batch.slice(0, cut)])
                    held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += batch.num_rows
        if held:
            yield look(held)

    return run


def _named(postings: DataFrame, sketches: DataFrame, light: int, percent: int) -> DataFrame:
    """(id, other) of all lists of ``postings``, each once."""
    n = common.shuffle_partitions(postings.sparkSession)
    shared = postings.repartition(n, "sign").sortWithinPartitions("sign").mapInArrow(common.lean(_shared(LIST_BLOCK), forget), SHARED)
    shared = common.write_and_read(shared, "lists")
    common.release(postings.sparkSession)
    # Blocks of a long list meet pair by pair; all others are one block.
    long = shared.filter("block > 0").groupBy("sign").agg(F.max("block").alias("last"))
    ahead = F.sequence(F.lit(0), F.coalesce("last", F.lit(0)))
    dealt = shared.join(long, "sign", "left").withColumn("partner", F.explode(ahead))
    dealt = dealt.withColumn("low", F.least("block", "partner")).withColumn("high", F.greatest("block", "partner"))
    drawn = dealt.drop("last", "partner").join(sketches, "id")
    keys = ["sign", "low", "high"]
    look = common.lean(_candidates(light, percent, LIST_ROWS), forget)
    found = drawn.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(look, "id long, other long")
    named = common.write_and_read(found.distinct(), "candidates")
    common.discard(shared)
    return named


def _link_asking(percent: int):
    """Links between sets that ask and sets of the label; one per set that asks is enough."""

    def link(rows: list[dict]) -> list[tuple[int, int]]:
        asking, held = ([r for r in rows if r["asks"] is side] for side in (True, False))
        if not asking or not held:
            return []
        left, right = ([shingle_set(r["text"]) for r in side] for side in (asking, held))
        links = link_matrix(left, right, percent)
        return [(asking[i]["id"], held[links[i].argmax()]["id"]) for i in np.flatnonzero(links.any(axis=1))]

    return link


def _compared(labelled: DataFrame, wanted: DataFrame, percent: int) -> DataFrame:
    """Edges between the sets of ``wanted`` (id, other) and sets of the label ``other``.

    Both sides of a label are dealt out by GATHERED sets; every deal of the one meets every
    deal of the other.
    """
    asked = wanted.groupBy("other").agg(F.ceil(F.count("*") / GATHERED).cast("int").alias("asking"))
    sizes = labelled.groupBy(F.col("label").alias("other")).agg(F.ceil(F.count("*") / GATHERED).cast("int").alias("holding"))
    deals = common.write_and_read(asked.join(sizes, "other"), "deals")

    def one(parts: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")

    def each(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    asking = wanted.join(deals, "other").select("id", "other", "holding", one("asking").alias("deal"))
    asking = asking.select("id", "other", "deal", each("holding").alias("part"))
    asking = labelled.select("id", "text").join(asking, "id").select("other", "deal", "part", F.lit(True).alias("asks"), "id", "text")
    holding = labelled.withColumnRenamed("label", "other").join(deals, "other").select("id", "text", "other", "asking", one("holding").alias("part"))
    holding = holding.select("other", each("asking").alias("deal"), "part", F.lit(False).alias("asks"), "id", "text")
    return _grouped(asking.unionByName(holding), ["other", "deal", "part"], _link_asking(percent))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Per row of ``docs``: doc_id, tag (of the text), n_shingles, component_id and kept.

    component_id is the smallest doc_id reachable over links; ``kept`` marks the document
    that stays of each component. Rows that share a doc_id are one node, linked wherever
    one of their texts is; each gives a row, and rows of one id and text are all marked
    alike. Texts without
    words, null ones included, have an empty set, link with nothing and stay. Rows without doc_id are a
    node for each text; their component_id is null unless they link with numbered
    documents. Without documents the result is empty. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = common.distinct_texts(docs)
    nodes = texts.nodes.select(F.col("key").alias("id"), "text")

    looks = common.write_and_read(nodes.mapInArrow(common.lean(_looked, forget), LOOK), "looks")
    signs, sizes = (looks.filter(F.col("kind") == k).select("id", "value") for k in (SIGN, SIZE))
    frequent = (
        looks.filter(F.col("kind") == FREQUENCY)
        .groupBy(F.col("value").alias("shingle"))
        .agg(F.sum("id").alias("n"))
        .orderBy(F.desc("n"), "shingle")
        .limit(FREQUENT)
    )
    known = frequent.toArrow()  # at most FREQUENT rows of two numbers
    shingles, counts = (known.column(c).to_numpy() for c in ("shingle", "n"))
    table = spark.sparkContext.broadcast((shingles.view(np.uint64), counts))
    small = sizes.filter(F.col("value") <= SIZES).groupBy("value").agg(F.count("*").alias("sets"))
    light = boundary({r["value"]: r["sets"] for r in small.collect()}, percent)

    chosen = signs.withColumnRenamed("value", "sign")
    # A gathering of more sets than GATHERED is dealt out; the lists below find the rest.
    several = chosen.groupBy("sign").agg(F.count("*").alias("members")).filter("members > 1")
    met = chosen.join(several, "sign").withColumn("deal", F.pmod(F.xxhash64("id", "sign"), F.ceil(F.col("members") / GATHERED)))
    gathered = _grouped(nodes.join(met, "id").select("id", "text", "sign", "deal"), ["sign", "deal"], _connect_gathered(percent))
    first = common.write_and_read(gathered.distinct(), "links")
    common.release(spark)
    joined = components(first)

    labelled = nodes.join(joined, "id", "left").select("id", F.coalesce("component", "id").alias("label"), "text")
    listed = labelled.mapInArrow(common.lean(_listed(table, light, percent), forget), "sign long, id long, label long, n int, place int")
    sketches = looks.filter(F.col("kind") == SIZE).select("id", "sketch")
    wanted = _named(listed, sketches, light, percent)
    common.release(spark)
    second = common.write_and_read(_compared(labelled, wanted, percent), "more-links")

    # A document whose text is the node of another key is linked with it, if it has words.
    size = sizes.select(F.col("id").alias("key"), F.col("value").alias("n_shingles"))
    rows = texts.rows.join(size, "key")
    copies = rows.filter("id <> key and n_shingles > 0").select(F.col("id").alias("a"), F.col("key").alias("b"))
    found = components(first.union(second).union(copies))
    for done in (first, second, wanted):
        common.discard(done)

    of_row = rows.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    one = of_row.filter("id = component").groupBy("component").agg(F.min("tag").alias("kept_tag"))
    return of_row.join(one, "component").select(
        "doc_id",
        "tag",
        "n_shingles",
        F.when(F.col("component") < common.UNNUMBERED, F.col("component")).alias("component_id"),
        (((F.col("id") == F.col("component")) & (F.col("tag") == F.col("kept_tag"))) | (F.col("n_shingles") == 0)).alias("kept"),
    )
