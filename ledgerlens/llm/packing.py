"""Packing of documents into training sequences by vector best-fit.

A sequence has three capacities: tokens, pieces of documents, and attention cost (the sum
of squared piece lengths). A piece goes into the open sequence that has room for it in all
three and fits it best, by the weighted norm of what would be left or by the weighted
product of demand and room; without such a sequence it opens one. Pieces are placed by
falling length, which best-fit needs to come near the smallest number of sequences.

Spark deals the pieces at random to groups of ``group_pieces`` pieces, which are packed
independently. What a group leaves in sequences that are not nearly full is dealt and packed
again, with that of other groups, until one group is left or nothing more is gained, so that
the number of groups does not show in the number of sequences; a group should hold many
sequences' worth of pieces. Full-length pieces are
sequences already and are not dealt.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import common

#: Cached words of one Python worker; the cache starts anew beyond it.
WORD_CACHE = 500_000

#: Share of a capacity from which on a sequence is not opened again.
NEARLY_FULL = 0.98

PIECES = "doc_id bigint, row_no int, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence; a limit of None never binds."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"  # or "product"

    def vector(self) -> np.ndarray:
        return np.array(
            [
                self.tokens,
                self.tokens if self.documents is None else self.documents,
                self.tokens**2 if self.attention is None else self.attention,
            ],
            dtype=np.float64,
        )


# How the vocabulary's own file splits text; fixed values.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"[\x21-\x7E\xA1-\xFF]*")


def _bytes(ids: list[int]) -> bytes:
    """Unsigned 32-bit numbers, little end first."""
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the
    letters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds(dict):
    """Token ids of a word as little-endian bytes. Words end at a blank or line break,
    where every pre-token of the vocabulary ends too, so a text's ids are its words' ids.

    If the tokenizer lower-cases and splits as expected, a word of printable Latin letters
    and signs is split here, and its parts, which recur more often, go to the tokenizer's
    model one by one. All other words are encoded whole.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        made = json.loads(self.tokenizer.to_str())
        kinds = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (made["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.known = kinds == ["NFC", "Replace", "Lowercase"] and splits == [_SPLIT, None]
        self.special = re.compile("|".join(re.escape(t["content"]) for t in made["added_tokens"]) or "(?!)")
        self.split = regex.compile(_SPLIT)
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        if len(self.parts) >= WORD_CACHE:
            self.parts.clear()
        text = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
        self.parts[part] = ids = _bytes([t.id for t in self.model.tokenize(text)])
        return ids

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORD_CACHE:
            self.clear()
        if self.known and _PLAIN.fullmatch(word) and not self.special.search(word):
            ids = b"".join([self.parts.get(p) or self._part(p) for p in self.split.findall(word.lower())])
        else:
            ids = _bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = ids
        return ids


@lru_cache(maxsize=2)
def _words(path: str) -> WordIds:
    return WordIds(path)


def _forget() -> None:
    _words.cache_clear()


def document_ids(text: str, path: str, end_id: int = 0) -> bytes:
    """Ids of a text and the closing id, four bytes each."""
    get = _words(path).__getitem__
    return b"".join(map(get, text.replace("\n", " ").split(" "))) + end_id.to_bytes(4, "little")


def _cut(path: str, tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "row_no", "piece", "start", "length", "ids_crc32"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        row = 0  # tells repeated rows of a task apart
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text")), strict=True):
                row += 1
                ids = document_ids(text, path)
                for piece, at in enumerate(range(0, len(ids), 4 * tokens)):
                    part = ids[at : at + 4 * tokens]
                    for column, value in zip(out, (doc, row, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return run


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, packed in falling order of length."""
    full = capacity.vector()
    weights = np.array(capacity.weights) / np.where(full > 0, full, 1) ** (2 if capacity.rule == "norm" else 1)
    order = np.argsort(-lengths, kind="stable")
    room = np.empty((len(lengths), 3))
    bins = np.empty(len(lengths), dtype=np.int64)  # sequence numbers of the open ones
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    shortest = lengths.min() if len(lengths) else 0
    n_open = n_made = 0
    for i in order:
        size = lengths[i]
        demand = np.array([size, 1.0, float(size) ** 2])
        if (demand > full).any():
            raise ValueError(f"a piece of {size} tokens exceeds an empty sequence")
        left = room[:n_open] - demand
        fits = np.flatnonzero((left >= 0).all(axis=1))
        if len(fits):
            if capacity.rule == "norm":
                best = fits[np.argmin((left[fits] ** 2) @ weights)]
            else:
                best = fits[np.argmax(room[fits] @ (weights * demand / full))]
        else:
            best, n_open = n_open, n_open + 1
            room[best], bins[best] = full, n_made
            n_made += 1
        sequence[i], offset[i] = bins[best], full[0] - room[best, 0]
        room[best] -= demand
        if room[best, 0] < shortest or room[best, 1] < 1 or room[best, 2] < float(shortest) ** 2:
            n_open -= 1  # no piece can enter it any more
            room[best], bins[best] = room[n_open], bins[n_open]
    return sequence, offset


def pack(docs: DataFrame, capacity: Capacity = Capacity(), tokenizer: str | None = None, group_pieces: int = 4000) -> DataFrame:
    """One row per piece: where its ids come from and where they stand in a sequence.

    A null or empty text is the closing id alone. Documents longer than a sequence are cut
    at full length. Each row of ``docs`` is a document of its own, repeated or not; columns
    beside doc_id and text are ignored. Without documents the result is empty. With a
    document or attention limit too tight for a full piece, pieces are still cut by tokens
    and an impossible piece is an error.
    """
    common.ship(docs.sparkSession)
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    rows = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    pieces = common.write_and_read(rows.mapInArrow(common.lean(_cut(path, capacity.tokens), _forget), PIECES), "pieces")
    whole = (F.col("length") == capacity.tokens) & F.lit(capacity.documents is None and capacity.attention is None)
    packed = pack_pieces(pieces.filter(~whole), capacity, group_pieces)
    # Full pieces need no place to be found; their numbers, all negative, count the scan.
    alone = pieces.filter(whole).select(
        "*",
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(alone).drop("row_no")


#: Rounds whose sequence numbers are told apart.
ROUNDS = 32


def pack_pieces(pieces: DataFrame, capacity: Capacity, group_pieces: int) -> DataFrame:
    """``pieces`` with sequence_id and offset, in rounds: see the module."""
    done: DataFrame | None = None
    loose, number = pieces, 0
    while True:
        n = loose.count()
        groups = max(1, -(-n // group_pieces))
        # Each round deals anew, so that leftovers meet others.
        deal = F.pmod(F.xxhash64("row_no", "doc_id", "piece", F.lit(number)), F.lit(groups)).alias("deal")
        kinds = f"{PIECES}, sequence_id long, offset long, full boolean"
        packed = loose.select("*", deal).groupBy("deal").applyInPandas(_place(capacity, groups, number), kinds)
        if groups > 1:
            packed = common.write_and_read(packed, "packed")
            again = packed.filter("not full").count()
            # Little is gained where most pieces are in sequences that no other piece fits in.
            if 2 * again > n or number + 1 == ROUNDS:
                groups = 1
        ended = packed if groups == 1 else packed.filter("full")
        done = ended.drop("full") if done is None else done.unionByName(ended.drop("full"))
        if groups == 1:
            return done
        loose, number = packed.filter("not full").drop("full", "sequence_id", "offset"), number + 1


def _place(capacity: Capacity, groups: int, number: int):
    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "row_no", "piece"], ascending=[False, True, True, True], kind="stable")
        length = frame["length"].to_numpy()
        sequence, offset = best_fit(length, capacity)
        used = np.stack([np.bincount(sequence, weights=w) for w in (length, np.ones(len(length)), length.astype(float) ** 2)], axis=1)
        full = (used / np.maximum(capacity.vector(), 1)).max(axis=1) >= NEARLY_FULL
        # Numbers of a group follow each other at a distance of the number of groups.
        frame["sequence_id"] = (sequence * groups + frame["deal"]) * ROUNDS + number
        frame["offset"] = offset
        frame["full"] = full[sequence]
        return frame.drop(columns="deal")

    return place
