"""Text quality by a factorisation machine.

Inputs are hashed words, statistics of the text's structure, and its size classes. Beside
a linear part, every pair of inputs interacts through the product of two short vectors.
The sum over all pairs is half of the squared sums minus the sums of squares, which takes
time in proportion to the inputs present.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common

#: Labelled rows that a model is fitted on at most.
SAMPLE_ROWS = 6_000
WORDS = 1 << 13
FACTORS = 8
SIZE_CLASSES = 24
#: Cached words of one Python worker; the cache starts anew beyond it.
WORD_CACHE = 300_000

# Byte classes: letters and marks, digits, blanks, line breaks, sentence marks, other signs.
_CLASS = np.full(256, 5, dtype=np.uint8)
for _c in range(256):
    if chr(_c).isascii() and chr(_c).isalpha() or _c >= 128:
        _CLASS[_c] = 0
    elif chr(_c).isdigit():
        _CLASS[_c] = 1
    elif chr(_c) in " \t":
        _CLASS[_c] = 2
    elif chr(_c) in "\n\r":
        _CLASS[_c] = 3
    elif chr(_c) in ".,;:!?'\"-()":
        _CLASS[_c] = 4
STATISTICS = ("letters", "digits", "blanks", "breaks", "marks", "signs", "word_size", "distinct", "runs", "repeated_lines", "ends", "short_lines")


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = bucket = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % WORDS
        return bucket


_buckets = _Buckets()


def statistics(text: str, words: list[str]) -> np.ndarray:
    """Shares and means, all between 0 and about 1."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out = np.zeros(len(STATISTICS))
    if not len(raw):
        return out
    out[:6] = np.bincount(_CLASS[raw], minlength=6) / len(raw)
    lines = text.split("\n")
    if words:
        out[6] = min(len(raw) / len(words), 40.0) / 20.0
        out[7] = len(set(words)) / len(words)
        out[8] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words)
        out[11] = min(1.0, len(lines) / len(words))
    out[9] = 1.0 - len(set(lines)) / len(lines)
    out[10] = float(text.rstrip()[-1:] in tuple(".!?"))
    return out


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the inputs that a text has."""
    words = text.split()
    buckets = np.fromiter(map(_buckets.__getitem__, words), dtype=np.int64, count=len(words))
    at, n = np.unique(buckets, return_counts=True)
    value = np.sqrt(n)
    value = value / max(np.sqrt((value**2).sum()), 1e-12)
    size = min(SIZE_CLASSES - 1, len(text).bit_length())
    base = WORDS + len(STATISTICS)
    return (
        np.r_[at, np.arange(WORDS, base), base + size],
        np.r_[value, statistics(text, words), 1.0],
    )


@dataclass(frozen=True)
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, at: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[at]
        sums = value @ v
        pairs = 0.5 * float((sums**2).sum() - (value**2) @ (v**2).sum(axis=1))
        return self.bias + float(self.linear[at] @ value) + pairs


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, rate: float = 0.15) -> Machine:
    """Logistic loss, adaptive steps, both labels of equal weight."""
    size = WORDS + len(STATISTICS) + SIZE_CLASSES
    draw = np.random.default_rng(7)
    w, v = np.zeros(size), draw.normal(0, 0.05, (size, FACTORS))
    gw, gv, b, gb = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2), 0.0, 1e-2
    share = np.bincount(labels, minlength=2) / max(len(labels), 1)
    if len(labels) == 0 or share.min() == 0:
        return Machine(0.0 if len(labels) == 0 else float(np.where(share[1] > 0, 4.0, -4.0)), w, np.zeros_like(v))
    weight = 0.5 / share
    for _ in range(epochs):
        for i in draw.permutation(len(examples)):
            at, x = examples[i]
            va = v[at]
            sums = x @ va
            z = b + w[at] @ x + 0.5 * ((sums**2).sum() - (x**2) @ (va**2).sum(axis=1))
            g = weight[labels[i]] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i])
            dw = g * x + 1e-5 * w[at]
            dv = g * (x[:, None] * sums - va * (x**2)[:, None]) + 1e-4 * va
            gw[at] += dw**2
            gv[at] += dv**2
            gb += g * g
            w[at] -= rate * dw / np.sqrt(gw[at])
            v[at] -= 0.3 * rate * dv / np.sqrt(gv[at])
            b -= rate * g / np.sqrt(gb)
    return Machine(float(b), w, v)


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("label"),
                pa.array([m[0].astype(np.int32) for m in made], pa.list_(pa.int32())),
                pa.array([m[1].astype(np.float32) for m in made], pa.list_(pa.float32())),
            ],
            ["doc_id", "label", "at", "value"],
        )


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Machine:
    """Machine fitted on at most ``rows`` labelled documents, chosen by a hash of their ids.

    ``labels`` holds doc_id and label (0 or 1); null ids or labels are left out. With one
    label only, every text gets it; without labels every text scores one half.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .select("doc_id", F.col("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    # The sample has a fixed number of short rows, so it may be broadcast.
    sample = common.texts(docs).join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("string").alias("doc_id"), "label", "text")
    made = sample.mapInArrow(_features_of, "doc_id string, label int, at array<int>, value array<float>").toArrow()
    order = np.argsort(np.array(made.column("doc_id").to_pylist(), dtype=object).astype(str), kind="stable")
    at, value = made.column("at").to_pylist(), made.column("value").to_pylist()
    y = np.array(made.column("label").to_pylist(), dtype=np.int64)
    return fit([(np.array(at[i]), np.array(value[i])) for i in order], y[order])


def with_score(docs: DataFrame, machine: Machine, column: str = "score") -> DataFrame:
    """``docs`` with the score of each text; a null text counts as empty and is scored from
    its statistics alone. Other columns, repeated rows and empty tables pass through."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # of a fixed size

    def score(text: pd.Series) -> pd.Series:
        m = shared.value
        return text.map(lambda t: float(1 / (1 + np.exp(-np.clip(m.margin(*features(t)), -60, 60)))))

    return docs.withColumn(column, F.pandas_udf(score, "double")(F.coalesce(F.col("text"), F.lit(""))))
