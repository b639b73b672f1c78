"""Removal of byte strings that occurred before, by blockwise suffix sorting.

Suffixes are compared by their first ``window`` bytes. A difference cover is a set of
residues modulo v such that any two places reach places of the cover by one common step
shorter than v. The suffixes at places of the cover are ranked first, by doubling. Any two
suffixes with equal first v bytes are then compared by the ranks of the cover places that
their common step leads to, however long they agree, and by their last bytes.

Suffixes are sorted one block at a time: a block holds all suffixes with the same anchors
(see :mod:`repeats`), so equal strings are in one block. A block's memory is bounded by
``repeats.BLOCK_BYTES`` and ``repeats.FREQUENT_RUNS`` runs of one anchor. Strings of an anchor
with more runs are brought together singly, by two 64-bit numbers of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common, repeats
from ledgerlens.llm.shingles import mix
from ledgerlens.llm.substring_dedup import repeated_parts

_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Shortest string whose repeats can be removed.
LEAST_WINDOW = 31


def _units(text: str) -> np.ndarray:
    return _BYTES[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]


@lru_cache(maxsize=4)
def difference_cover(v: int) -> tuple[int, ...]:
    """The first smallest set of residues whose differences are all residues modulo v."""
    for size in range(1, v + 1):
        for rest in combinations(range(1, v), size - 1):
            cover = (0, *rest)
            if len({(a - b) % v for a in cover for b in cover}) == v:
                return cover
    raise ValueError(v)


@lru_cache(maxsize=4)
def _steps(v: int) -> np.ndarray:
    """For two residues, the smallest step that leads both into the cover."""
    cover = set(difference_cover(v))
    return np.array([[next(d for d in range(v) if (i + d) % v in cover and (j + d) % v in cover) for j in range(v)] for i in range(v)])


def _ranks(values: pa.Array) -> np.ndarray:
    """Dense ranks of the values, in their order."""
    coded = values.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return rank[coded.indices.to_numpy()]


def _blocks(text: np.ndarray, places: np.ndarray, size: int) -> pa.Array:
    """The ``size`` bytes from each place on."""
    cut = np.lib.stride_tricks.sliding_window_view(text, size)[places]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(places), [None, pa.py_buffer(cut.tobytes())])


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _ranks(pa.array((a << np.int64(32)) | b))


def suffix_classes(text: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """For each start, the number of starts with a smaller window: equal windows have equal
    numbers, and the numbers follow the order of the windows."""
    v = 8 * ((window + 1) // 32)
    n = len(starts)
    if not n:
        return np.empty(0, dtype=np.int64)
    # Ranks of cover places by 3 v bytes, at all places that a step can lead to.
    cover = np.zeros(v, dtype=bool)
    cover[list(difference_cover(v))] = True
    places = np.flatnonzero(cover[np.arange(len(text) - v + 1) % v])
    by_v = np.full(len(text) + 1, -1, dtype=np.int64)
    by_v[places] = _ranks(_blocks(text, places, v))
    long = places[places + 3 * v <= len(text)]
    twice = _pairs(by_v[long], by_v[long + v])
    rank = np.full(len(text) + 1, -1, dtype=np.int64)
    rank[long] = _pairs(twice, by_v[long + 2 * v])
    tail = -(-(window - 3 * v) // 8)
    words = [np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, 8)).view(">u8").reshape(-1)] if tail else []

    head = _ranks(_blocks(text, starts, v))
    order = np.argsort(head, kind="stable")
    result = np.empty(n, dtype=np.int64)
    edge = np.r_[True, head[order][1:] != head[order][:-1]]
    first = np.flatnonzero(edge)
    size = np.diff(np.r_[first, n])
    result[order] = np.repeat(first, size)
    steps = _steps(v)
    # Ties: every group is split by one of its members into smaller, equal and larger ones.
    tied = size > 1
    members = order[np.repeat(tied, size)]
    low, size = first[tied], size[tied]
    while len(members):
        begin = np.r_[0, np.cumsum(size)[:-1]]
        pivot = starts[np.repeat(members[begin + size // 2], size)]
        at = starts[members]
        step = steps[at % v, pivot % v]
        sign = np.sign(rank[at + step] - rank[pivot + step])
        for k in range(tail):
            same = np.flatnonzero(sign == 0)
            shift = window - 8 * (tail - k)
            a, b = words[0][at[same] + shift], words[0][pivot[same] + shift]
            sign[same] = (a > b).astype(np.int64) - (a < b)
        group = np.repeat(np.arange(len(size)), size)
        cell = 3 * group + sign + 1
        order = np.argsort(cell, kind="stable")
        members, cell = members[order], cell[order]
        counts = np.bincount(cell, minlength=3 * len(size))
        lows = np.repeat(low, 3) + (np.cumsum(counts) - counts - np.repeat(begin, 3))
        result[members] = np.repeat(lows, counts)
        open_ = (counts > 1) & (np.arange(len(counts)) % 3 != 1)
        members = members[np.repeat(open_, counts)]
        low, size = lows[open_], counts[open_]
    return result


def _send(window: int):
    """Of equal runs in a batch, all but the earliest are flagged at once. Windows of
    frequent anchors are sent singly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles = repeats.Singles(all_equal=False)
        for batch in batches:
            seen: dict[tuple[int, bytes], tuple[int, int, int]] = {}
            rows = []
            for doc, key, text, runs in zip(*(batch.column(c).to_pylist() for c in ("id", "key", "text", "runs")), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                pair = repeats.window_pairs(_units(text), window) if any(r["n"] < 0 for r in runs) else None
                for r in runs:
                    if r["n"] < 0:
                        yield from singles.add(doc, key, r["start"], pair, -r["n"])
                        continue
                    what = (r["anchor"], raw[r["start"] : r["start"] + r["n"] + window - 1])
                    place = (doc, key, r["start"])
                    if what in seen:
                        place, later = sorted((place, seen[what]))
                        rows.append((later[1], None, later[0], later[1], later[2], r["n"], 1, None))
                    seen[what] = place
            for (anchor, body), (doc, key, start) in seen.items():
                rows.append((anchor, anchor, doc, key, start, len(body) - window + 1, 1, body))
            yield repeats.sent(rows)
        yield from singles.flush()

    return run


def _compare(window: int):
    def run(rows: list[dict]) -> list[tuple[int, int, int]]:
        """Windows with an earlier equal one: all of repeated runs, then by their classes."""
        rows.sort(key=lambda r: (r["id"], r["key"], r["start"]))
        seen: set[bytes] = set()
        out, distinct = [], []
        for r in rows:
            if r["body"] in seen:
                out.append((r["key"], r["start"], r["start"] + r["n"] - 1))
            else:
                seen.add(r["body"])
                distinct.append(r)
        lengths = np.array([r["n"] for r in distinct])
        text = np.frombuffer(b"".join(r["body"] for r in distinct), dtype=np.uint8)
        base = np.cumsum(lengths + window - 1) - (lengths + window - 1)
        starts = np.arange(lengths.sum()) + np.repeat(base - (np.cumsum(lengths) - lengths), lengths)
        of_class = suffix_classes(text, starts, window)
        # Starts are in order of id and place, so the first of a class is the earliest.
        first = np.full(len(starts), len(starts), dtype=np.int64)
        np.minimum.at(first, of_class, np.arange(len(starts)))
        return out + repeated_parts(distinct, first[of_class] < np.arange(len(starts)))

    return run


DONE = "key long, n_removed long, n_spans long, kept_sha256 string, kept string, spans array<struct<start:long,end:long>>"


def _finish(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, flags in zip(batch.column("text").to_pylist(), batch.column("flags").to_pylist(), strict=True):
                raw, cuts = text.encode("utf-8", "surrogatepass"), repeats.merged(flags, window)
                edges = [0, *(e for cut in cuts for e in cut), len(raw)]
                left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                for column, value in zip(
                    out,
                    (
                        len(raw) - len(left),
                        len(cuts),
                        hashlib.sha256(left).hexdigest(),
                        left.decode("utf-8", "ignore") if with_text else None,
                        [{"start": a, "end": b} for a, b in cuts],
                    ),
                    strict=True,
                ):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                ["key", "n_removed", "n_spans", "kept_sha256", "kept", "spans"],
            )

    return run


def remove_earlier_strings(docs: DataFrame, window: int = 100, with_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, tag (of the text), n_bytes, n_removed, n_spans,
    kept_sha256, kept and spans.

    Bytes covered by a string of ``window`` bytes that starts earlier too are removed;
    earlier is a smaller doc_id or an earlier place in the document. ``kept`` is the rest as
    text if ``with_text``, without characters that a cut went through. Rows without doc_id
    come after all others, in an order by their text. Rows that repeat a doc_id and a text
    are one document, and each gives its result; different texts of one doc_id follow each
    other in a fixed order. Null and empty texts lose nothing. Without documents the result
    is empty. Other columns are ignored. ``window`` is ``LEAST_WINDOW`` at least.
    """
    if window < LEAST_WINDOW:
        raise ValueError(f"strings of {window} bytes are too short")
    sub = min(32, window // 3)
    texts = common.distinct_texts(docs)
    candidates = repeats.candidate_runs(texts.nodes, _units, window, sub)
    flags = repeats.flagged_windows(candidates, _send(window), _compare(window), all_equal=False)
    # Written, so that what was shuffled for it can go before the texts are read again.
    flags = common.write_and_read(flags, "flags")
    common.release(docs.sparkSession)
    done = texts.nodes.select("key", "text").join(flags, "key", "left").mapInArrow(common.lean(_finish(window, with_text)), DONE)
    # A later copy of a whole text was there before, from its first byte to its last.
    copy = (F.col("id") != F.col("owner")) & (F.col("n_bytes") >= window)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return texts.rows.join(done, "key").select(
        "doc_id",
        "tag",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(copy & F.lit(with_text), F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(copy, whole).otherwise(F.col("spans")).alias("spans"),
    )
