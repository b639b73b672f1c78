"""Token ids of documents in files that can be asked without being unpacked.

Documents are sorted over all partitions. Each partition writes one Parquet file, whose rows
are shards: the documents' ids and lengths, and a wavelet matrix of their token ids. Spark
commits the files, so that a lost task leaves nothing half done, and any store that Spark
reaches will do. Totals of tokens read two columns; occurrences and single tokens are found
by rank and select in the bit planes; whole documents are rebuilt from all planes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.packing import WordIds
from ledgerlens.llm.wavelet import Plane, WaveletMatrix

#: Tokens of a shard; it ends with the document that reaches them.
SHARD_TOKENS = 1 << 23
#: Positions that are looked up together.
STRETCH = 1 << 20
#: Cached parts of one Python worker; the cache starts anew beyond it.
PART_CACHE = 800_000

# How the vocabulary splits a lower-cased text of these characters: blanks and line breaks,
# and printable Latin letters, digits and signs. Fixed values.
_LETTERS, _DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
_LATIN = re.compile(r"[\n \x21-\x7E\xA1-\xFF]*")
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\n {_LETTERS}{_DIGITS}]+")


class TextIds(dict):
    """Token ids of lower-cased parts as little-endian bytes. Latin texts are split as a
    whole and their parts, which recur, are encoded once; all other texts go word by word."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.words = WordIds(path)

    def __missing__(self, part: str) -> bytes:
        if len(self) >= PART_CACHE:
            self.clear()
        text = part if part.isascii() else "".join(map(self.words.letters.__getitem__, part.encode()))
        self[part] = ids = b"".join([t.id.to_bytes(4, "little") for t in self.words.model.tokenize(text)])
        return ids

    def encode(self, text: str) -> bytes:
        if self.words.known and _LATIN.fullmatch(text) and not self.words.special.search(text):
            return b"".join(map(self.__getitem__, _PARTS.findall(text.lower())))
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def _text_ids(path: str) -> TextIds:
    return TextIds(path)


PLANES = "planes array<struct<zeros:long,ones:array<long>,ends:array<long>,body:binary>>"
SHARDS = f"part int, shard int, n_tokens long, doc_ids array<long>, lengths array<long>, alphabet array<long>, counts array<long>, {PLANES}"
_PLANE = pa.struct([("zeros", pa.int64()), ("ones", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("body", pa.binary())])


def _pack(path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _text_ids(path).encode, end_id.to_bytes(4, "little")
        part, shard, held = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        lengths: list[int] = []
        bodies: list[bytes] = []

        def flush() -> pa.RecordBatch:
            matrix = WaveletMatrix.of(np.frombuffer(b"".join(bodies), dtype="<u4"))
            planes = [{"zeros": p.zeros, "ones": p.ones, "ends": p.ends, "body": p.body} for p in matrix.planes]
            values = [part, shard, matrix.n, docs, lengths, matrix.alphabet, matrix.counts, planes]
            numbers = pa.list_(pa.int64())
            kinds = [pa.int32(), pa.int32(), pa.int64(), numbers, numbers, numbers, numbers, pa.list_(_PLANE)]
            names = ["part", "shard", "n_tokens", "doc_ids", "lengths", "alphabet", "counts", "planes"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encode(text) + end
                docs.append(doc)
                lengths.append(len(ids) // 4)
                bodies.append(ids)
                held += len(ids) // 4
                if held >= shard_tokens:
                    yield flush()
                    shard, held = shard + 1, 0
                    for kept in (docs, lengths, bodies):
                        kept.clear()
        if docs:
            yield flush()

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> None:
    """Writes the token ids of all documents in ascending order of doc_id to ``folder``.

    Each text's ids, without special tokens, are followed by ``end_id``; a null or empty
    text is that id alone. Rows without doc_id come last. Rows of one doc_id follow each
    other in an order by their texts, and repeated rows are documents of their own. Other
    columns are ignored. A shard ends with the document that reaches ``shard_tokens``, so a
    task holds that many and one whole document at most.
    """
    spark = docs.sparkSession
    common.ship(spark)
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    rows = common.texts(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag"), F.monotonically_increasing_id().alias("row")
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("tag"), F.col("row")]
    dealt = rows.repartitionByRange(common.shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    packed = dealt.select("doc_id", "text").mapInArrow(_pack(path, end_id, shard_tokens), SHARDS)
    packed.write.option("compression", "zstd").parquet(folder)


def _matrix(row: dict) -> WaveletMatrix:
    planes = [Plane(row["n_tokens"], p["zeros"], np.array(p["ones"]), np.array(p["ends"]), p["body"]) for p in row["planes"]]
    return WaveletMatrix(row["n_tokens"], np.array(row["alphabet"], dtype=np.int64), np.array(row["counts"], dtype=np.int64), planes)


def _by_shard(batches: Iterator[pa.RecordBatch], make: Callable[[dict], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield make(batch.slice(i, 1).to_pylist()[0])


DOCUMENTS = "part int, shard int, doc_id long, local long, n_tokens long, ids_crc32 long, ids array<long>"


def _read(with_ids: bool):
    def make(row: dict) -> pa.RecordBatch:
        numbers = _matrix(row).numbers().astype("<u4")
        ends = np.cumsum(row["lengths"])
        raw = memoryview(numbers).cast("B")
        begins = ends - row["lengths"]
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        n = len(crc)
        ids = pa.ListArray.from_arrays(np.r_[0, ends].astype(np.int32), pa.array(numbers.astype(np.int64))) if with_ids else pa.nulls(n, pa.list_(pa.int64()))
        columns = [
            pa.array(np.full(n, row["part"]), pa.int32()), pa.array(np.full(n, row["shard"]), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
            pa.array(begins), pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64()), ids,
        ]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in DOCUMENTS.split(", ")])

    return lambda batches: _by_shard(batches, make)


def _starts(shards: DataFrame) -> DataFrame:
    """part, shard and the tokens in front of each shard. Shards are summed up within their
    file; one task then sees one row per file."""
    sizes = shards.select("part", "shard", "n_tokens")
    files = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = files.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    return sizes.select("part", "shard", inside.alias("inside")).join(ahead, "part").select("part", "shard", (F.col("ahead") + F.col("inside")).alias("base"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    common.ship(spark)
    return spark.read.schema(SHARDS).parquet(folder)


def read_documents(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (tokens of all documents in front), n_tokens, ids_crc32 and, if
    ``with_ids``, ids of every document in the files, decoded from their bit planes."""
    shards = _files(spark, folder)
    found = shards.mapInArrow(_read(with_ids), DOCUMENTS).join(_starts(shards), ["part", "shard"])
    more = ["ids"] if with_ids else []
    return found.select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *more)


def token_totals(spark: SparkSession, folder: str) -> DataFrame:
    """token and n over all files, without opening any bit plane."""
    pairs = _files(spark, folder).select(F.explode(F.arrays_zip("alphabet", "counts")).alias("pair"))
    return pairs.groupBy(F.col("pair.alphabet").alias("token")).agg(F.sum("pair.counts").alias("n"))


OCCURRENCES = "part int, shard int, doc_id long, token long, place long, local long"


def _find(tokens: list[int]):
    def make(row: dict) -> pa.RecordBatch:
        matrix, ends = _matrix(row), np.cumsum(row["lengths"])
        docs = pa.array(row["doc_ids"], pa.int64())
        token, local = [], []
        for number in tokens:
            places = matrix.select(number)
            token.append(np.full(len(places), number))
            local.append(places)
        at = np.concatenate(local)
        doc = np.searchsorted(ends, at, side="right")
        begins = ends - row["lengths"]
        n = len(at)
        columns = [
            pa.array(np.full(n, row["part"]), pa.int32()), pa.array(np.full(n, row["shard"]), pa.int32()), docs.take(pa.array(doc)),
            pa.array(np.concatenate(token), pa.int64()), pa.array(at - begins[doc]), pa.array(at),
        ]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in OCCURRENCES.split(", ")])

    return lambda batches: _by_shard(batches, make)


def occurrences(spark: SparkSession, folder: str, tokens: list[int]) -> DataFrame:
    """doc_id, token, place (in the document) and position (in all files) of every
    occurrence of the given tokens, by select in the shards whose alphabet has one of them."""
    wanted = sorted(set(tokens))
    shards = _files(spark, folder)
    some = F.arrays_overlap("alphabet", F.array(*(F.lit(t).cast("long") for t in wanted)))
    found = shards.filter(some).mapInArrow(_find(wanted), OCCURRENCES).join(_starts(shards), ["part", "shard"])
    return found.select("doc_id", "token", "place", (F.col("base") + F.col("local")).alias("position"))


TOKENS = "position long, token long"


def _access(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def make(row: dict) -> pa.RecordBatch:
        places = np.array(row["places"], dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(places + row["base"]), pa.array(_matrix(row).access(places))], ["position", "token"])

    return _by_shard(batches, make)


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame) -> DataFrame:
    """position and token for each distinct position (long) of ``positions`` that is in the
    files. A shard is asked once for all of its positions."""
    shards = _files(spark, folder)
    spans = _starts(shards).join(shards.select("part", "shard", "n_tokens"), ["part", "shard"])
    asked = positions.select(F.col("position").cast("long").alias("position")).filter("position >= 0").distinct()
    # Positions and shards meet by the stretch of positions they are in.
    first, last = (F.floor(F.col("base") / STRETCH), F.floor((F.col("base") + F.col("n_tokens") - 1) / STRETCH))
    spans = spans.filter("n_tokens > 0").withColumn("stretch", F.explode(F.sequence(first, last)))
    inside = (F.col("position") >= F.col("base")) & (F.col("position") < F.col("base") + F.col("n_tokens"))
    met = asked.withColumn("stretch", F.floor(F.col("position") / STRETCH)).join(spans, "stretch").filter(inside)
    by_shard = met.groupBy("part", "shard", "base").agg(F.collect_list(F.col("position") - F.col("base")).alias("places"))
    return shards.join(by_shard, ["part", "shard"]).mapInArrow(_access, TOKENS)
