"""What a Python worker holds: short Arrow batches, and no caches of an operator it left."""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers

from ledgerlens.llm import common, packing, shingles

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_written_tables_travel_in_short_batches(spark):
    def sizes_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    given = spark.conf.get(ROWS)
    rows = spark.range(0, 2 * common.BATCH_ROWS + 1, 1, 1)
    sizes = [r.n for r in common.write_and_read(rows.mapInArrow(sizes_of, "n long"), "sizes").collect()]
    assert max(sizes) <= common.BATCH_ROWS and sum(sizes) == 2 * common.BATCH_ROWS + 1
    assert spark.conf.get(ROWS) == given


def test_a_shorter_limit_stays(spark):
    given = spark.conf.get(ROWS)
    spark.conf.set(ROWS, "7")
    try:
        with common.short_batches(spark):
            assert spark.conf.get(ROWS) == "7"
    finally:
        spark.conf.set(ROWS, given)


def test_caches_last_until_another_operator_runs():
    texts = [pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some words of a text"]})]
    cut = common.lean(packing._cut(public_tokenizers.path("word_bpe_49k.json"), 2048), packing._forget)
    first = [b.to_pydict() for b in cut(iter(texts))]
    assert packing._words.cache_info().currsize == 1
    assert [b.to_pydict() for b in cut(iter(texts))] == first
    assert packing._words.cache_info().hits > 0

    def numbered(batches):
        for batch in batches:
            shingles.shingle_set(batch.column("text")[0].as_py())
            yield batch

    assert list(common.lean(numbered, shingles.forget)(iter(texts))) == texts
    assert packing._words.cache_info().currsize == 0 and len(shingles._numbers) > 0
    assert list(common.lean(lambda batches: batches)(iter(texts))) == texts
    assert len(shingles._numbers) == 0
