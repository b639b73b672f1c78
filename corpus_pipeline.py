"""The corpus pipeline: stages over documents, each written and read again as the next input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import common, decontaminate, jaccard_join, packing, suffix_dedup, toxicity

#: Stages learn, match and pack, which SQL cannot express.
ORACLE_SQL = None


def _same_text() -> Column:
    """A document against an id and a text's tag."""
    tag = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (tag == F.col("_tag"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the lexicon is learned from the labels of
    documents whose crc32 modulo 5 is not 0."""
    labels = common.read(spark, sf_dir, "labels").filter(common.fold("doc_id", 5) != 0)
    lexicon = toxicity.learn(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    kept = toxicity.with_score(docs, lexicon, "_toxicity").filter(F.col("_toxicity") < 0.5)
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, and of repeated
    rows one. Documents without words stay, as they resemble nothing."""
    found = jaccard_join.near_duplicates(docs)
    stays = found.filter("kept").select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), (F.col("n_shingles") == 0).alias("_empty"))
    stays = stays.groupBy("_id", "_tag").agg(F.max("_empty").alias("_empty"))
    # Repeated rows of a kept text are numbered; rows that differ elsewhere in a fixed order.
    number = F.row_number().over(common.Window.partitionBy("_id", "_tag").orderBy(*(F.col(c) for c in docs.columns if c != "text")))
    kept = docs.join(stays, _same_text()).withColumn("_number", number).filter("_empty or _number = 1")
    return kept.select(*docs.columns)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the strings of 100 bytes that occurred before. A null text
    stays null; n_chars, where there, follows the text."""
    found = suffix_dedup.remove_earlier_strings(docs, with_text=True)
    cut = found.filter("n_removed > 0").select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), F.col("kept").alias("_kept"))
    cut = cut.groupBy("_id", "_tag").agg(F.min("_kept").alias("_kept"))
    joined = docs.join(cut, _same_text(), "left")
    text = F.coalesce(F.col("_kept"), F.col("text"))
    size = F.when(F.col("_kept").isNull(), F.col("n_chars")).otherwise(F.length("_kept")) if "n_chars" in docs.columns else None
    return joined.select(
        *(
            text.alias("text") if c == "text" else size.cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
            for c in docs.columns
        )
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    hits = decontaminate.hit_flag(docs, common.read(spark, sf_dir, "benchmark"), "_hit")
    return hits.filter(~F.col("_hit")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: What earlier stages wrote on their way, until a stage starts from their written output.
_left: list[common.Scratch] = []


def _shipped(stage: Stage) -> Stage:
    """The stage with its code on the executors, in a scope of its own.

    A stage's scratch tables are needed until its output is written. The next stage reads
    that output, so it clears them, unless its input still comes from them.
    """

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.ship(spark)
        read = "\n".join(docs.inputFiles())
        for own in [s for s in _left if not any(folder.rsplit("/", 1)[-1] in read for folder in s.folders)]:
            common.clear(spark, own)
            _left.remove(own)
        with common.scope() as own:
            _left.append(own)
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _shipped(drop_toxic)),
    ("ngram_jaccard_join", _shipped(drop_near_duplicates)),
    ("suffix_dedup", _shipped(cut_repeated_strings)),
    ("decontamination", _shipped(drop_contaminated)),
    ("best_fit_packing", _shipped(pack_sequences)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    folder = common.scratch_folder(spark)
    docs = common.read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    for own in _left:
        common.clear(spark, own)
    _left.clear()
    return docs
