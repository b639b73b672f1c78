"""Removal of word windows that occur more than once.

Windows are numbered by a Rabin-Karp hash over their words. Numbers are counted where
Spark's shuffle brings them together; windows that overlap or touch merge into maximal
removal intervals. See :mod:`repeats` for the windows that need not be counted, as their
anchor shows that they are single.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common, repeats
from ledgerlens.llm.shingles import split_words, windows, word_numbers


def _units(text: str) -> np.ndarray:
    return word_numbers(split_words(text))


def _send(window: int):
    """Equal runs of a batch are flagged at once, and one stands for them, counted twice.
    Windows of frequent anchors are sent singly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles = repeats.Singles(all_equal=True)
        for batch in batches:
            places: dict[tuple[int, bytes], list[tuple[int, int, int]]] = defaultdict(list)
            for key, text, runs in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "runs")), strict=True):
                units = _units(text)
                numbers = windows(units, window)
                pair = repeats.window_pairs(units, window) if any(r["n"] < 0 for r in runs) else None
                for r in runs:
                    if r["n"] < 0:
                        yield from singles.add(key, key, r["start"], pair, -r["n"])
                        continue
                    body = numbers[r["start"] : r["start"] + r["n"]].tobytes()
                    places[r["anchor"], body].append((key, r["start"], r["n"]))
            rows = []
            for (anchor, body), found in places.items():
                if len(found) == 1:
                    key, start, n = found[0]
                    rows.append((anchor, anchor, key, key, start, n, 1, body))
                else:
                    rows += [(key, None, key, key, start, n, 2, None) for key, start, n in found]
                    rows.append((anchor, anchor, None, None, 0, found[0][2], 2, body))
            yield repeats.sent(rows)
        yield from singles.flush()

    return run


def _compare(rows: list[dict]) -> list[tuple[int, int, int]]:
    """Runs of windows that occur at least twice among ``rows``."""
    lengths = [r["n"] for r in rows]
    numbers = np.frombuffer(b"".join(r["body"] for r in rows), dtype=np.uint64)
    _, at = np.unique(numbers, return_inverse=True)
    times = np.bincount(at, weights=np.repeat([r["weight"] for r in rows], lengths))
    return repeated_parts(rows, times[at] >= 2)


def repeated_parts(rows: list[dict], hit: np.ndarray) -> list[tuple[int, int, int]]:
    """(key, first, last) of each maximal run of hit windows of the rows that have a key."""
    lengths = np.array([r["n"] for r in rows])
    ends = np.cumsum(lengths)
    before = np.r_[False, hit[:-1]]
    before[np.r_[0, ends[:-1]]] = False
    after = np.r_[hit[1:], False]
    after[ends - 1] = False
    first, last = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after)
    row = np.searchsorted(ends, first, side="right")
    out = []
    for r, a, b in zip(row.tolist(), first.tolist(), last.tolist(), strict=True):
        if rows[r]["key"] is not None:
            shift = rows[r]["start"] - int(ends[r] - lengths[r])
            out.append((rows[r]["key"], a + shift, b + shift))
    return out


DONE = "key long, n_words long, n_removed long, kept_sha256 string, kept string, intervals array<struct<start:long,end:long>>"


def _finish(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, flags in zip(batch.column("text").to_pylist(), batch.column("flags").to_pylist(), strict=True):
                words, cuts = split_words(text), repeats.merged(flags, window)
                kept, at = [], 0
                for a, b in cuts:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                left = b" ".join(kept)
                for column, value in zip(
                    out,
                    (
                        len(words),
                        len(words) - len(kept),
                        hashlib.sha256(left).hexdigest(),
                        left.decode("utf-8", "replace") if with_text else None,
                        [{"start": a, "end": b} for a, b in cuts],
                    ),
                    strict=True,
                ):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                ["key", "n_words", "n_removed", "kept_sha256", "kept", "intervals"],
            )

    return run


def remove_repeated_windows(docs: DataFrame, window: int = 35, with_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept, intervals.

    Words are runs between ASCII blanks, unchanged. ``kept`` is the rest, joined by blanks,
    if ``with_text``; ``intervals`` holds the removed runs of words. Every row is a place of
    its own, so a text of ``window`` words or more that two rows share goes from both, even
    under one doc_id. Null and empty texts have no words. Without documents the result is
    empty. Other columns are ignored.
    """
    sub = max(1, window // 4)
    texts = common.distinct_texts(docs)
    candidates = repeats.candidate_runs(texts.nodes, _units, window, sub)
    flags = repeats.flagged_windows(candidates, _send(window), _compare, all_equal=True)
    # Written, so that what was shuffled for it can go before the texts are read again.
    flags = common.write_and_read(flags, "flags")
    common.release(docs.sparkSession)
    done = texts.nodes.select("key", "text").join(flags, "key", "left").mapInArrow(common.lean(_finish(window, with_text)), DONE)
    gone = (F.col("copies") > 1) & (F.col("n_words") >= window)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    return texts.rows.join(done, "key").select(
        "doc_id",
        "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(gone & F.lit(with_text), F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(gone, whole).otherwise(F.col("intervals")).alias("intervals"),
    )
