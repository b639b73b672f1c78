"""Spelling variants: words one edit apart, found by asymmetric chunks and positional grams.

One edit leaves one of two disjoint chunks of a word whole. The shorter word of a pair (of
equally long ones the smaller) contributes its two halves as chunks, the longer one all of
its positional grams that a chunk can meet: a chunk in front of the edit keeps its place,
one behind it shifts by the difference of the lengths, which is one at most. Words that
meet are verified.

Halves of short words are shared by many. Where both sides of a meeting are large, what the
chunk leaves open is cut into two chunks again, since the one edit lies in there, and the
words meet at the longer key instead. No meeting is skipped, and none holds more pairs than
its smaller side's bound allows for each word, until the open part is two letters long and
the alphabet bounds it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.shingles import LOWER

#: Distinct words that a task counts before it hands its counts on.
COUNTED = 400_000
#: Words that a word may meet under one key before the key is made longer.
MEETINGS = 48

COUNTS = "word string, n long"


def _counts(least_length: int, one_in: int):
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return found

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(runs.findall(text.encode().translate(LOWER).decode())).items():
                    h = zlib.crc32(word.encode(), begun)
                    if h % one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    total[word] += n
                if len(total) >= COUNTED:
                    yield flush()
        yield flush()

    return run


def word_counts(docs: DataFrame, least_length: int = 6, least_count: int = 5, one_in: int = 199) -> DataFrame:
    """word and n of the letter runs of all texts, lower-cased in A-Z.

    Of a run whose crc32 with its doc_id is divisible by ``one_in``, one letter is left out.
    Results shorter than ``least_length`` or rarer than ``least_count`` are left out.
    """
    common.ship(docs.sparkSession)
    found = common.texts(docs).mapInArrow(_counts(least_length, one_in), COUNTS)
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _first_keys(words: DataFrame) -> DataFrame:
    """Every word without any part known yet, in each of its roles: the shorter word
    ('chunks'), or the longer word against one of ``of`` letters."""
    size = F.length("word")
    roles = F.array(
        F.struct(F.lit(True).alias("chunks"), size.alias("of")),
        F.struct(F.lit(False).alias("chunks"), size.alias("of")),
        F.struct(F.lit(False).alias("chunks"), (size - 1).alias("of")),
    )
    zero = F.lit(0)
    return words.select("word", "n", F.explode(roles).alias("role")).select(
        "word", "n", "role.chunks", "role.of", F.xxhash64("role.of").alias("key"), zero.alias("front"), zero.alias("back"), zero.alias("differ")
    )


def _longer_keys(entries: DataFrame) -> DataFrame:
    """Each entry under its two next chunks, or grams at the places these can be.

    ``front`` and ``back`` count the known letters at both ends, ``differ`` is the length of
    the front in which the words of a pair must differ: a pair whose front chunks agree
    meets there and not at the back chunks too.
    """
    open_ = F.col("of") - F.col("front") - F.col("back")
    half = F.floor(open_ / 2).cast("int")
    rest = (open_ - half).cast("int")
    size = F.length("word")
    ahead = F.struct(
        F.xxhash64("key", F.lit(0), F.substring(F.col("word"), F.col("front") + 1, half)).alias("key"),
        (F.col("front") + half).alias("front"),
        F.col("back").alias("back"),
        F.col("differ").alias("differ"),
    )
    behind = F.struct(
        F.xxhash64("key", F.lit(1), F.substring(F.col("word"), size - F.col("back") - rest + 1, rest)).alias("key"),
        F.col("front").alias("front"),
        (F.col("back") + rest).alias("back"),
        (F.col("front") + half).alias("differ"),
    )
    made = entries.select("word", "n", "chunks", "of", F.explode(F.array(ahead, behind)).alias("next"))
    return made.select("word", "n", "chunks", "of", "next.key", "next.front", "next.back", "next.differ")


def _verified(entries: DataFrame) -> DataFrame:
    """Pairs one edit apart among entries that meet; each pair once."""
    a = entries.filter("chunks").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), "of", "differ")
    b = entries.filter("not chunks").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = a.join(b, "key").filter(
        ((F.length("b") > F.col("of")) | (F.col("a") < F.col("b")))
        & ((F.col("differ") == 0) | (F.substring("a", F.lit(1), F.col("differ")) != F.substring("b", F.lit(1), F.col("differ"))))
    )
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")


def near_pairs(words: DataFrame, meetings: int = MEETINGS) -> DataFrame:
    """a, a_n, b and b_n of all pairs of ``words`` (word, n; distinct words of two letters or
    more) that differ by one inserted, deleted or replaced letter."""
    entries = common.write_and_read(_longer_keys(_first_keys(words)), "keys")
    found: DataFrame | None = None
    while True:
        sides = entries.groupBy("key").agg(
            F.count(F.when(F.col("chunks"), 1)).alias("a"),
            F.count(F.when(~F.col("chunks"), 1)).alias("b"),
            F.max(F.col("of") - F.col("front") - F.col("back")).alias("open"),
        )
        heavy = (F.least("a", "b") > meetings) & (F.col("open") > 2)
        # Keys of one side alone hold no pair.
        judged = common.write_and_read(entries.join(sides.filter("a > 0 and b > 0").select("key", heavy.alias("heavy")), "key"), "judged")
        pairs = common.write_and_read(_verified(judged.filter("not heavy")), "pairs")
        found = pairs if found is None else found.unionByName(pairs)
        entries = judged.filter("heavy").drop("heavy")
        if entries.isEmpty():
            return found
        entries = common.write_and_read(_longer_keys(entries), "keys")


def _roots(forms: DataFrame, most: int, times: int) -> DataFrame:
    """word and root: forms followed to their end by doubling the step.

    A form is at least ``times`` as frequent as its word, so a chain has at most
    log(``most``) / log(``times``) steps.
    """
    longest, reach = 0, 1
    while reach <= most:
        longest, reach = longest + 1, reach * max(2, times)
    at = forms.select("word", F.col("form").alias("root"))
    step = 1
    while step < longest:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        at = common.write_and_read(at, "roots")
        step *= 2
    return at


def variants(words: DataFrame, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of ``words`` (word, n).

    A word's form is the most frequent word one edit away (of equal ones the smallest in
    code-point order) if that is at least ``times`` (two or more) as frequent; else null. Its
    root is where the forms end: the word itself if it has none. A rarer word never is a
    form, so there are no circles.
    """
    if times < 2:
        raise ValueError("a form must be more frequent than its word")
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")
    )
    enough = -F.col("best.minus") >= F.col("n") * times
    judged = common.write_and_read(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("best.other")).alias("form"),
            F.when(enough, -F.col("best.minus")).alias("form_n"),
        ),
        "variants",
    )
    most = judged.agg(F.max("n")).first()[0] or 0
    roots = _roots(judged.filter("form is not null"), most, times)
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, one_in: int = 199, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of all whole texts.

    Rows may repeat: each counts. Null and empty texts hold no words, a null doc_id is the
    empty text where runs are altered, and very long runs are words like others. Without
    words the result is empty. Other columns are ignored.
    """
    words = common.write_and_read(word_counts(docs, least_length, least_count, one_in), "words")
    return variants(words, times)
