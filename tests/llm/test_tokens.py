import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlens.llm import packing, token_counts
from tests.llm.helpers import documents, mixed_documents

ODD = ["a", "b", " ", "  ", "\n", "\t", "▁", "é", "é", "<s>", "</s>", "<|endoftext|>", "'s", "'S", "1", "中", " ", "\x1c", "\x85", "İ", "ß", "#", "\r", "😀", "\x00", "ﬁ", "ª", "²", "\xad", "don't"]


def odd_texts(n: int) -> list[str]:
    draw = random.Random(5)
    return ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 12))) for _ in range(n)]


def test_piece_counts_equal_the_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    counter, model = token_counts.PieceCounter(path), sentencepiece.SentencePieceProcessor(model_file=path)
    assert counter.splits
    for text in odd_texts(3000):
        assert counter.count(text) == len(model.encode(text)), repr(text)


def test_word_ids_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for text in odd_texts(3000):
        expected = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert np.frombuffer(packing.document_ids(text, path), "<u4").tolist() == expected, repr(text)


def test_token_counts_of_rows(spark, tmp_path):
    rows = [*mixed_documents(), (1, "same"), (1, "same"), (2, "same"), (3, "long word " * 9000)]
    store = str(tmp_path / "store")
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = sorted((str(i), len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in rows)
    got = token_counts.token_counts(documents(spark, rows), store).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == expected
    stored = spark.read.parquet(store)
    assert stored.count() == len({t or "" for _, t in rows})
    # A second run encodes nothing, another tokenizer version everything.
    token_counts.token_counts(documents(spark, rows), store).collect()
    assert spark.read.parquet(store).count() == stored.count()


def test_stored_counts_are_used(spark, tmp_path):
    store = str(tmp_path / "store")
    version = token_counts.tokenizer_digest(public_tokenizers.path("piece_bpe_32k.model"))
    import hashlib

    known = [(bytearray(hashlib.sha256(b"abc").digest()), version, 77), (bytearray(hashlib.sha256(b"x").digest()), "older", 99)]
    spark.createDataFrame(known, token_counts.STORE_SCHEMA).write.parquet(store)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(documents(spark, [(1, "abc"), (2, "x")]), store).collect()}
    assert got[1] == 77 and got[2] != 99


def test_no_documents(spark):
    assert token_counts.token_counts(documents(spark, [])).count() == 0
    assert packing.pack(documents(spark, [])).count() == 0


def packed(frame):
    rows = frame.collect()
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return rows, by_sequence


def test_packing_is_whole_and_tight(spark):
    rows = [*mixed_documents(), (1, "word " * 5000), (1, "word " * 5000), (2, "word " * 2047), (3, None)]
    got, sequences = packed(packing.pack(documents(spark, rows)))
    path = public_tokenizers.path("word_bpe_49k.json")
    expected = []
    for i, t in rows:
        ids = packing.document_ids(t or "", path)
        expected += [(str(i), k, at // 4, len(ids[at : at + 8192]) // 4, zlib.crc32(ids[at : at + 8192])) for k, at in enumerate(range(0, len(ids), 8192))]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(expected)
    assert len(sequences) <= -(-sum(r["length"] for r in got) // 2048) + 1


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_known_texts_do_not_travel(spark, tmp_path, monkeypatch):
    """Cold, warm and half-warm: only texts that are missing are grouped and encoded."""
    store = str(tmp_path / "store")
    rows = [(i, f"text number {i % 50}") for i in range(200)]
    grouped = []
    encode = token_counts._encode
    monkeypatch.setattr(token_counts, "_encode", lambda path: grouped.append(path) or encode(path))
    token_counts.token_counts(documents(spark, rows), store).collect()
    assert len(grouped) == 1 and spark.read.parquet(store).count() == 50
    token_counts.token_counts(documents(spark, rows), store).collect()
    assert len(grouped) == 1  # nothing is missing: no text is asked for at all
    more = [*rows, *((1000 + i, f"new {i % 3}") for i in range(30))]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = token_counts.token_counts(documents(spark, more), store).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == sorted((i, len(model.encode(t))) for i, t in more)
    assert len(grouped) == 2 and spark.read.parquet(store).count() == 53


@pytest.mark.parametrize("group", [60, 400, 10**6])
def test_groups_do_not_show_in_the_number_of_sequences(spark, group):
    rows = [(i, "word " * 19) for i in range(3000)]
    got = packing.pack(documents(spark, rows), packing.Capacity(tokens=500), group_pieces=group).collect()
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        assert [o for o, _ in sorted(places)] == [20 * k for k in range(len(places))] and len(places) <= 25
    assert len(got) == 3000 and len(by_sequence) <= 3000 // 25 + 2


def test_pieces_that_no_other_fits_beside(spark):
    """Rounds end where nothing is gained: each sequence holds one piece."""
    rows = [(i, "word " * 299) for i in range(60)]
    got = packing.pack(documents(spark, rows), packing.Capacity(tokens=500), group_pieces=5).collect()
    assert len({r["sequence_id"] for r in got}) == 60 and {r["offset"] for r in got} == {0}


@pytest.mark.parametrize("rule", ["norm", "product"])
def test_every_capacity_holds(rule):
    draw = np.random.default_rng(1)
    lengths = draw.integers(1, 400, 500)
    capacity = packing.Capacity(tokens=1000, documents=4, attention=300_000, rule=rule)
    sequence, offset = packing.best_fit(lengths, capacity)
    for s in np.unique(sequence):
        inside = lengths[sequence == s]
        assert inside.sum() <= 1000 and len(inside) <= 4 and (inside.astype(float) ** 2).sum() <= 300_000
        order = np.argsort(offset[sequence == s])
        assert (offset[sequence == s][order] == np.r_[0, np.cumsum(inside[order])[:-1]]).all()
    assert len(np.unique(sequence)) <= 1.25 * max(lengths.sum() / 1000, len(lengths) / 4, (lengths.astype(float) ** 2).sum() / 300_000)


def test_impossible_piece():
    with pytest.raises(ValueError):
        packing.best_fit(np.array([10]), packing.Capacity(tokens=20, attention=50))
