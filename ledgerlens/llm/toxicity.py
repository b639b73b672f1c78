"""Toxicity by a weighted lexicon.

Texts are folded first: case, look-alike letters, and digits or signs that stand for
letters. One Aho-Corasick automaton then finds lexicon entries (whole words or word
beginnings, with weights) and exception phrases in one scan; an entry inside an exception
phrase does not count. Signs at a word's end may be noise or letters: such a word is read
without them, and also with any number of them as letters. The weights found are divided by a slowly growing function of the
text's length and mapped to a score between 0 and 1.

The lexicon, the exceptions and the threshold are learned from a bounded sample of labels.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common

# Letters of other scripts that look like Latin ones, in alphabetical order of the Latin letter.
LOOKALIKES = str.maketrans(
    {
        "а": "a", "α": "a", "ɑ": "a", "в": "b", "β": "b", "с": "c", "ϲ": "c", "ԁ": "d", "е": "e", "ε": "e", "є": "e",
        "ɡ": "g", "һ": "h", "н": "h", "і": "i", "ι": "i", "ı": "i", "ј": "j", "к": "k", "κ": "k", "ӏ": "l", "м": "m",
        "ո": "n", "η": "n", "о": "o", "ο": "o", "σ": "o", "р": "p", "ρ": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t",
        "τ": "t", "υ": "u", "ս": "u", "ν": "v", "ѵ": "v", "ѡ": "w", "ω": "w", "х": "x", "χ": "x", "у": "y", "γ": "y",
        "ʏ": "y", "ᴢ": "z", "​": "", "‌": "", "‍": "", "⁠": "", "﻿": "", "­": "",
    }
)

# Signs written for letters.
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"})
_SIGNED = "0123456789@$!"
_HAS_SIGN = re.compile(r"[0-9@$!]")
_ENDS_SIGNED = re.compile(r"[^ 0-9@$!][0-9@$!]+(?: |$)")
_SIGNED_WORD = re.compile(r"[^ ]*[0-9@$!][^ ]*")
_OTHER = re.compile(r"[^\w@$! ]|_")
_LATIN = bytes(c if chr(c).isalnum() or chr(c) in "@$!" else 32 for c in range(256))

#: Labelled rows that a lexicon is learned from at most.
SAMPLE_ROWS = 8_000
#: Candidate entries that reach the driver at most, best first.
CANDIDATES = 20_000
#: Labelled texts an entry must occur in, and those it must explain best.
SUPPORT, EXPLAINED = 3, 2
#: How far below the heaviest entry of a text, in logarithms, another one explains it too.
NEAR_HEAVIEST = math.log(4.0)
#: An entry is at least so many times as frequent in toxic texts.
LIFT = 8.0
STEMS = (3, 4, 5, 6)


def _signed(match: re.Match) -> str:
    word = match[0].rstrip(_SIGNED)
    return word.translate(SIGNS) if any(c.isalpha() for c in word) else ""


def _plain(text: str) -> str:
    """Lower-case words of Latin look-alikes, digits and signs, with blanks between."""
    s = text.lower()
    try:
        s = s.encode("latin-1").replace(b"\xad", b"").translate(_LATIN).decode("latin-1")
    except UnicodeEncodeError:
        s = unicodedata.normalize("NFKC", s).lower().translate(LOOKALIKES)
        s = _OTHER.sub(" ", s)
    return s


def _folded(plain: str) -> str:
    return _SIGNED_WORD.sub(_signed, plain) if _HAS_SIGN.search(plain) else plain


def fold_text(text: str) -> str:
    """Lower-case words of letters with single or more blanks between, in reading order.
    Signs at the end of a word are left out."""
    return _folded(_plain(text))


def readings(plain: str, longest: int) -> tuple[list[str], dict[int, list[str]]]:
    """The folded words, and for the numbers of words that ended in signs what they read as
    with one or more of these as letters. Readings above ``longest`` letters begin alike, so
    those up to there tell all that entries of that length can match."""
    if not _ENDS_SIGNED.search(plain):
        return _folded(plain).split(), {}
    words, others = [], {}
    for word in plain.split():
        folded = _folded(word)
        if not folded:
            continue
        if len(folded) < len(word):
            full = word[: max(longest, len(folded))].translate(SIGNS)
            if ends := range(len(folded) + 1, len(full) + 1):
                others[len(words)] = [full[:k] for k in ends]
        words.append(folded)
    return words, others


@dataclass(frozen=True)
class Lexicon:
    """Entries as (pattern, weight), where a pattern begins with a blank and ends with one
    if it is a whole word; exception phrases; the threshold and steepness of the score."""

    entries: tuple[tuple[str, float], ...] = ()
    exceptions: tuple[str, ...] = ()
    threshold: float = 1.0
    steepness: float = 4.0


@lru_cache(maxsize=4)
def _automaton(lexicon: Lexicon):
    found = ahocorasick.Automaton()
    for phrase in lexicon.exceptions:
        found.add_word(f" {fold_text(phrase)} ", (len(fold_text(phrase)) + 2, None))
    for pattern, weight in lexicon.entries:
        if pattern not in found:
            found.add_word(pattern, (len(pattern), weight))
    found.make_automaton()
    return found


@lru_cache(maxsize=4)
def _extent(lexicon: Lexicon) -> tuple[int, int]:
    """Letters of the longest word, and words of the longest entry or exception phrase."""
    phrases = [p.split() for p in (*(p for p, _ in lexicon.entries), *map(fold_text, lexicon.exceptions))]
    return max((len(w) for p in phrases for w in p), default=0), max(map(len, phrases), default=0)


def _found(line: str, automaton) -> list[tuple[int, int, float, bool]]:
    """(start, end, weight) of each entry in a line, and whether an exception phrase spares it."""
    entries, phrases = [], []
    for end, (length, weight) in automaton.iter(line):
        (phrases if weight is None else entries).append((end - length, end, weight))
    return [(*m, any(a <= m[0] and m[1] <= b for a, b, _ in phrases)) for m in entries]


def matches(text: str, lexicon: Lexicon) -> tuple[list[tuple[int, int, float]], int]:
    """(start, end, weight) in the folded text of each entry that counts, and its words.

    A word with signs at its end is also read in its other ways, beside the folded words
    around it. An entry counts once there, if no reading puts it into an exception phrase;
    its place is that of the folded word.
    """
    longest, reach = _extent(lexicon)
    words, others = readings(_plain(text), longest)
    if not words or not (lexicon.entries or lexicon.exceptions):
        return [], len(words)
    automaton = _automaton(lexicon)
    counts = [m[:3] for m in _found(f" {' '.join(words)} ", automaton) if not m[3]]
    ends = np.cumsum([len(w) + 1 for w in words]) if others else []
    for at, read in others.items():
        head = " ".join(["", *words[max(0, at - reach + 1) : at], ""])
        tail = " ".join(["", *words[at + 1 : at + reach], ""])
        known: set[tuple[int, str]] = set()
        new: dict[tuple[int, str], float] = {}
        for k, word in enumerate([words[at], *read]):
            line = f"{head}{word}{tail}"
            for start, end, weight, spared in _found(line, automaton):
                if start + 1 < len(head) + len(word) and end >= len(head):
                    if k == 0 or spared:
                        known.add((start, line[start + 1 : end + 1]))
                    else:
                        new[start, line[start + 1 : end + 1]] = weight
        there = int(ends[at])
        counts += [(there - len(words[at]) - 1, there, w) for m, w in new.items() if m not in known]
    return counts, len(words)


def density(text: str, lexicon: Lexicon) -> float:
    found, words = matches(text, lexicon)
    return sum(w for _, _, w in found) / (1.0 + math.log2(1.0 + words))


def toxicity_score(text: str | None, lexicon: Lexicon) -> float:
    z = lexicon.steepness * (density(text or "", lexicon) - lexicon.threshold)
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


def _patterns(words: set[str]) -> set[str]:
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in STEMS if len(w) > k}


def _count_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each label that hold a pattern, added up per task."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            counts[label].update(_patterns(set(fold_text(text).split())))
    names = list(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), *(pa.array([counts[k][n] for n in names], pa.int64()) for k in (1, 0))],
        ["pattern", "toxic", "clean"],
    )


def _best_pattern(weights: dict[str, float]):
    """The candidates that explain each toxic text: of each word the heaviest, then most
    specific pattern, if it is about as heavy as the text's heaviest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = []
        for batch in batches:
            for text in batch.column("text").to_pylist():
                held = set()
                for word in set(fold_text(text).split()):
                    of_word = [p for p in _patterns({word}) if p in weights]
                    if of_word:
                        held.add(max(of_word, key=lambda p: (weights[p], p.endswith(" "), len(p))))
                heaviest = max((weights[p] for p in held), default=0.0)
                best += [p for p in held if weights[p] >= heaviest - NEAR_HEAVIEST]
        yield pa.RecordBatch.from_arrays([pa.array(best, pa.string())], ["pattern"])

    return run


def _contexts(lexicon: Lexicon):
    """Two-word phrases around matches, with the label of their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, labels = [], []
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                line = f" {' '.join(fold_text(text).split())} "
                held = set()
                for end, (length, _) in _automaton(lexicon).iter(line):
                    before, word, after = line[: end - length + 1].split(), line[end - length + 1 :].split()[0], line[end - length + 1 :].split()[1:2]
                    held.update(" ".join(p) for p in (before[-1:] + [word], [word] + after) if len(p) == 2)
                phrases += held
                labels += [label] * len(held)
        yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.string()), pa.array(labels, pa.int32())], ["phrase", "label"])

    return run


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Lexicon from at most ``rows`` labelled documents, chosen by a hash of their ids.

    ``labels`` holds doc_id and label (0 or 1); null ids or labels are left out. Without
    toxic examples the lexicon is empty and every text scores low.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .select("doc_id", F.col("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    common.ship(docs.sparkSession)
    # The sample has a fixed number of short rows, so it may be broadcast.
    sample = common.write_and_read(common.texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "label"), "sample")
    of_label = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = of_label.get(1, 0), of_label.get(0, 0)
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    candidates = (
        sample.mapInArrow(common.lean(_count_patterns), "pattern string, toxic long, clean long")
        .groupBy("pattern")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= SUPPORT)
        .select("pattern", weight.alias("weight"))
        .filter(F.col("weight") >= math.log(LIFT))
        .orderBy(F.desc("weight"), "pattern")
        .limit(CANDIDATES)
    )
    weights = {r["pattern"]: r["weight"] for r in candidates.collect()}
    best = (
        sample.filter("label = 1")
        .mapInArrow(_best_pattern(weights), "pattern string")
        .groupBy("pattern")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= EXPLAINED)
    )
    entries = tuple(sorted((r["pattern"], weights[r["pattern"]]) for r in best.collect()))
    lexicon = Lexicon(entries, exceptions)
    if entries:
        spared = (
            sample.mapInArrow(_contexts(lexicon), "phrase string, label int")
            .groupBy("phrase")
            .agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
            .filter((F.col("toxic") == 0) & (F.col("n") >= SUPPORT))
            .orderBy(F.desc("n"), "phrase")
            .limit(CANDIDATES)
        )
        lexicon = Lexicon(entries, exceptions + tuple(sorted(r["phrase"] for r in spared.collect())))

    def measure(text: pd.Series) -> pd.Series:
        return text.map(lambda t: density(t, lexicon))

    measured = sample.select(F.pandas_udf(measure, "double")("text").alias("x"), "label")
    return _calibrated(lexicon, measured.toPandas())


def _calibrated(lexicon: Lexicon, measured: pd.DataFrame) -> Lexicon:
    """The threshold halfway across the gap with the fewest errors."""
    x, y = measured["x"].to_numpy(dtype=float), measured["label"].to_numpy(dtype=int)
    if not len(x) or y.min() == y.max():
        return lexicon
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    wrong = np.r_[0, np.cumsum(y)] + np.r_[(y == 0).sum(), (y == 0).sum() - np.cumsum(y == 0)]
    gaps = np.r_[False, x[1:] > x[:-1], False]
    if not gaps.any():
        return lexicon
    at = np.flatnonzero(gaps)[np.argmin(wrong[gaps])]
    threshold = (x[at - 1] + x[at]) / 2
    return Lexicon(lexicon.entries, lexicon.exceptions, float(threshold), float(4.0 / max(x[at] - x[at - 1], 0.05)))


def with_score(docs: DataFrame, lexicon: Lexicon, column: str = "score") -> DataFrame:
    """``docs`` with the score of each text; a null text counts as empty. Other columns,
    repeated rows and empty tables pass through."""

    common.ship(docs.sparkSession)

    def score(text: pd.Series) -> pd.Series:
        return text.map(lambda t: toxicity_score(t, lexicon))

    return docs.withColumn(column, F.pandas_udf(score, "double")(F.coalesce(F.col("text"), F.lit(""))))
