"""Token counts through a digest cache.

A text's count depends on its characters and the tokenizer alone. Counts are therefore
stored under the pair (content digest, tokenizer digest); a run joins its texts to the
store, encodes every missing content once however many documents hold it, appends the new
counts and reads all counts back from the store.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common

#: Cached unit counts of one Python worker; the cache starts anew beyond it.
UNIT_CACHE = 200_000

STORE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Names a tokenizer version by the content of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


class PieceCounter:
    """Counts pieces of a SentencePiece BPE model.

    No piece of such a model continues from a letter into the next blank, and none
    holds a line break. Texts fall apart at those places and the parts, which recur, are
    counted once each. Texts with blanks in a row, a leading blank or a literal blank
    mark are encoded whole, and so are all texts if the model does not qualify.
    """

    BLANK = "▁"

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.splits = (
            not any(self.BLANK in p.lstrip(self.BLANK) or "\n" in p for p in pieces)
            and self.model.encode("a", out_type=str) == [self.BLANK + "a"]
            and len(self.model.encode("a b")) == 2
            and self.model.encode("a  b", out_type=str) != self.model.encode("a b", out_type=str)
        )
        self.cache: dict[str, int] = {"": 1}

    def _unit(self, unit: str) -> int:
        # Behind a line break a unit has no blank mark of its own; the encoder adds one.
        n = len(self.model.encode(unit)) - unit.startswith("\n")
        if len(self.cache) >= UNIT_CACHE:
            self.cache = {"": 1}
        self.cache[unit] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.splits or "  " in text or text[0] == " " or self.BLANK in text:
            return len(self.model.encode(text))
        total = 0
        for unit in text.replace("\n", " \n").split(" "):
            n = self.cache.get(unit)
            total += self._unit(unit) if n is None else n
        return total


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            counts = [counter.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def token_counts(
    docs: DataFrame,
    store: str | None = None,
    tokenizer: str | None = None,
    limit: int = 4096,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``.

    ``store`` is the folder of the cache, which later runs may share; left out, the run
    starts from an empty one in the shared checkpoint folder. A null text is empty and an
    empty text has no tokens. Rows may repeat: each gives a row. Without documents the
    result is empty. Other columns are ignored.
    """
    spark = docs.sparkSession
    common.ship(spark)
    path = tokenizer or public_tokenizers.path("piece_bpe_32k.model")
    version = tokenizer_digest(path)
    store = store or f"{common.scratch_folder(spark)}/token_counts"
    spark.createDataFrame([], STORE_SCHEMA).write.mode("append").parquet(store)

    rows = common.texts(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    known = spark.read.schema(STORE_SCHEMA).parquet(store).filter(F.col("tokenizer") == version)
    # Digests alone decide what is missing; then only texts that are travel.
    digests = common.write_and_read(rows.select("digest").distinct(), "digests")
    misses = common.write_and_read(digests.join(known.select("digest"), "digest", "left_anti"), "misses")
    missing = misses.count()
    if missing < digests.count():
        wanted = rows.join(misses, "digest", "left_semi")
    else:
        wanted = rows
    # One text stands for all of its copies; copies within a task meet before the shuffle.
    distinct = wanted.select("digest", "text").groupBy("digest").agg(F.first("text").alias("text"))
    counted = distinct.mapInArrow(_encode(path), "digest binary, n_tokens long") if missing else spark.createDataFrame([], "digest binary, n_tokens long")
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(store)

    # Runs that overlapped may have appended a content twice, with equal counts.
    counts = (
        spark.read.schema(STORE_SCHEMA)
        .parquet(store)
        .filter(F.col("tokenizer") == version)
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    return (
        rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
        .join(counts, "digest")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
