"""Where windows of a fixed number of units may repeat, found from a sample of their places.

The anchor of a window is its least sub-window, under a hash. Equal windows have equal
anchors, so a window whose anchor occurs at one place only cannot repeat. Anchors are few
(two in as many places as a window has sub-windows) and are counted in Spark; only runs of
neighbouring windows with a repeated anchor go on. Windows of such a run travel together,
under their anchor, to where they are compared with all other runs of that anchor. Windows
of an anchor with more than ``FREQUENT_RUNS`` runs travel singly, under their own number, so
that no group of runs grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.shingles import mix, windows

#: Windows looked at together; longer documents are gone through in steps.
STEP = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
#: Bytes of runs that are compared at once, about.
BLOCK_BYTES = 2 << 20
#: Runs of one anchor that are compared as runs; about a block of them.
FREQUENT_RUNS = 10_000
#: Single windows of frequent anchors that a sender looks at together.
SINGLE_WINDOWS = 1 << 18

RUNS = "anchor long, key long, start long, n long"
FLAGGED = "key long, first long, last long"

#: Turns a text into spread 64-bit numbers, one per unit.
Units = Callable[[str], np.ndarray]


def anchors(numbers: np.ndarray, window: int, sub: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor place: the anchor's number, its place, the first
    window and the number of windows."""
    total = len(numbers) - window + 1
    parts = []
    for a in range(0, max(total, 0), STEP):
        h = windows(numbers[a : a + STEP + window - 1], sub)
        least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        span, width = 1, window - sub + 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        place = (least[starts] & _PLACE).astype(np.int64)
        parts.append((h[place].view(np.int64), place + a, starts + a, np.diff(np.r_[starts, len(least)])))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _counted(units: Units, window: int, sub: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, np.int64)]
            for text in batch.column("text").to_pylist():
                anchor, place, _, _ = anchors(units(text), window, sub)
                found.append(anchor[np.r_[True, place[1:] != place[:-1]]] if len(place) else anchor)
            values, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], ["anchor", "n"])

    return run


def _placed(units: Units, window: int, sub: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(units(text), window, sub) for text in batch.column("text").to_pylist()]
            lengths = [len(f[0]) for f in found]
            join = lambda k: np.concatenate([np.empty(0, np.int64), *(f[k] for f in found)])  # noqa: B023, E731
            keys = np.repeat(batch.column("key").to_numpy(zero_copy_only=False), lengths)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (join(0), keys, join(2), join(3))], ["anchor", "key", "start", "n"])

    return run


def candidate_runs(nodes: DataFrame, units: Units, window: int, sub: int) -> DataFrame:
    """``nodes`` that hold repeated anchors, with ``runs``: array of (anchor, start, n). ``n``
    is negative where the anchor has more than ``FREQUENT_RUNS`` runs."""
    repeated = (
        nodes.select("text")
        .mapInArrow(common.lean(_counted(units, window, sub)), "anchor long, n long")
        .groupBy("anchor")
        .agg(F.sum("n").alias("n"))
        .filter("n > 1")
        .select("anchor", (F.col("n") > FREQUENT_RUNS).alias("frequent"))
    )
    # Written, so that the join below has two plain inputs and can split a frequent anchor.
    repeated = common.write_and_read(repeated, "anchors")
    common.release(nodes.sparkSession)
    placed = nodes.select("key", "text").mapInArrow(common.lean(_placed(units, window, sub)), RUNS).join(repeated, "anchor")
    n = F.when(F.col("frequent"), -F.col("n")).otherwise(F.col("n")).alias("n")
    runs = placed.select("key", "anchor", "start", n).groupBy("key").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("runs"))
    return nodes.join(runs, "key")


SENT = "route long, anchor long, id long, key long, start long, n long, weight int, body binary"


def sent(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.binary()]
    names = ["route", "anchor", "id", "key", "start", "n", "weight", "body"]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def window_pairs(numbers: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent numbers of every window."""
    return windows(numbers, window), windows(mix(numbers ^ np.uint64(0xA0761D6478BD642F)), window)


class Singles:
    """Windows of frequent anchors, which a sender takes out of their runs.

    Of equal windows that are looked at together one is sent, with weight -1; the later
    ones are flagged at once. If ``all_equal``, all of them are flagged, and one without a
    key, of weight -2, stands for them.
    """

    def __init__(self, all_equal: bool) -> None:
        self.all_equal = all_equal
        self._clear()

    def _clear(self) -> None:
        self.runs: list[tuple[int, int, int, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, id_: int, key: int, start: int, pair: tuple[np.ndarray, np.ndarray], n: int) -> Iterator[pa.RecordBatch]:
        self.runs.append((id_, key, start, pair[0][start : start + n].copy(), pair[1][start : start + n].copy()))
        self.held += n
        if self.held >= SINGLE_WINDOWS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.runs:
            return
        ids, keys, starts, one, two = zip(*self.runs, strict=True)
        self._clear()
        lengths = np.array([len(x) for x in one])
        one, two = np.concatenate(one), np.concatenate(two)
        start = np.arange(len(one)) + np.repeat(np.array(starts) - (np.cumsum(lengths) - lengths), lengths)
        id_, key = (np.repeat(np.array(x, dtype=np.int64), lengths) for x in (ids, keys))
        order = np.lexsort((start, key, id_, two, one))
        one, two, id_, key, start = (x[order] for x in (one, two, id_, key, start))
        head = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
        first = np.flatnonzero(head)
        several = np.diff(np.r_[first, len(head)]) > 1
        gone = np.repeat(several, np.diff(np.r_[first, len(head)])) if self.all_equal else ~head
        several &= self.all_equal

        number, body = one[first].view(np.int64), two[first]
        yield _sent_columns(
            number,
            pa.array(number),
            id_[first],
            pa.array(key[first], mask=several),
            start[first],
            np.ones(len(first), np.int64),
            np.where(several, -2, -1),
            pa.FixedSizeBinaryArray.from_buffers(pa.binary(8), len(first), [None, pa.py_buffer(body.tobytes())]).cast(pa.binary()),
        )
        # Neighbouring windows are flagged as one run.
        at = np.flatnonzero(gone)
        at = at[np.lexsort((start[at], key[at]))]
        begins = np.flatnonzero(np.r_[True, (key[at][1:] != key[at][:-1]) | (start[at][1:] != start[at][:-1] + 1)]) if len(at) else at
        n, at = np.diff(np.r_[begins, len(at)]), at[begins]
        none = lambda kind: pa.nulls(len(at), kind)
        yield _sent_columns(key[at], none(pa.int64()), id_[at], pa.array(key[at]), start[at], n, np.ones(len(at)), none(pa.binary()))


def _sent_columns(route, anchor, id_, key, start, n, weight, body) -> pa.RecordBatch:
    columns = [pa.array(route), anchor, pa.array(id_), key, pa.array(start), pa.array(n), pa.array(weight.astype(np.int32)), body]
    return pa.RecordBatch.from_arrays(columns, ["route", "anchor", "id", "key", "start", "n", "weight", "body"])


class _SinglesCompared:
    """Flags equal windows that were sent singly and arrive in their order, whatever their
    number: of the rows before a batch only the last is held."""

    def __init__(self, all_equal: bool) -> None:
        self.all_equal = all_equal
        self.last: pa.RecordBatch | None = None
        self.done = False

    def flags(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = pa.Table.from_batches([batch] if self.last is None else [self.last, batch]).combine_chunks()
        number = rows.column("anchor").to_numpy()
        body = np.frombuffer(b"".join(rows.column("body").to_pylist()), dtype=np.uint64)
        equal = (number[1:] == number[:-1]) & (body[1:] == body[:-1])
        hit = np.r_[False, equal]
        if self.all_equal:
            hit |= np.r_[equal, False] | (rows.column("weight").to_numpy() == -2)
        new = hit.copy()
        if self.last is not None:
            new[0] &= self.all_equal and not self.done
            hit[0] |= self.done
        self.last, self.done = batch.slice(batch.num_rows - 1), bool(hit[-1])
        found = rows.filter(pc.and_(pa.array(new), pc.is_valid(rows.column("key"))))
        key, start = (found.column(c).to_numpy() for c in ("key", "start"))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (key, start, start)], ["key", "first", "last"])


def flagged(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["key", "first", "last"])


def _compared(compare: Callable[[list[dict]], list[tuple[int, int, int]]], all_equal: bool):
    """Gathers the runs of whole anchors up to a size, and compares them; single windows are
    compared as they pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        held = 0
        singles = _SinglesCompared(all_equal)
        for batch in batches:
            single = pc.less(batch.column("weight"), 0)
            if pc.any(single).as_py():
                yield singles.flags(batch.filter(single))
                batch = batch.filter(pc.invert(single))
            out = []
            for row in batch.to_pylist():
                if row["body"] is None:  # flagged where it came from
                    out.append((row["key"], row["start"], row["start"] + row["n"] - 1))
                    continue
                if held > BLOCK_BYTES and row["anchor"] != waiting[-1]["anchor"]:
                    out += compare(waiting)
                    waiting, held = [], 0
                waiting.append(row)
                held += len(row["body"])
            yield flagged(out)
        if waiting:
            yield flagged(compare(waiting))

    return run


def flagged_windows(candidates: DataFrame, send: Callable, compare: Callable, all_equal: bool) -> DataFrame:
    """Per key, ``flags``: array of (first, last) numbers of windows that ``compare`` names.

    ``send`` turns candidate rows into rows for the shuffle. It names a route for each: the
    anchor for what is to be compared, the key for what is flagged already, and its own
    number for a window of a frequent anchor (see :class:`Singles`). Of those, ``all_equal``
    ones are flagged, or else all but the first by id, key and start.
    """
    n = common.shuffle_partitions(candidates.sparkSession)
    return (
        candidates.mapInArrow(common.lean(send), SENT)
        .repartition(n, "route")
        .sortWithinPartitions("anchor", "body", "id", "key", "start")
        .mapInArrow(common.lean(_compared(compare, all_equal)), FLAGGED)
        .groupBy("key")
        .agg(F.collect_list(F.struct("first", "last")).alias("flags"))
    )


def merged(flags: list[dict] | None, window: int) -> list[list[int]]:
    """Maximal runs of units covered by flagged windows, as half-open intervals."""
    out: list[list[int]] = []
    for first, last in sorted((f["first"], f["last"]) for f in flags or ()):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + window)
        else:
            out.append([first, last + window])
    return out
