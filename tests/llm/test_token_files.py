import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import token_files, wavelet
from tests.llm.helpers import documents, mixed_documents
from tests.llm.test_tokens import odd_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("size, top", [(0, 1), (1, 1), (5, 1), (1000, 2), (70_000, 3), (200_000, 5000), (150_000, 1 << 32)])
def test_wavelet_matrix(size, top):
    draw = np.random.default_rng(size)
    numbers = (top * draw.random(size) ** 4).astype(np.uint32)
    matrix = wavelet.WaveletMatrix.of(numbers)
    assert (matrix.numbers() == numbers).all() and matrix.numbers().dtype == np.uint32
    if not size:
        return
    places = draw.integers(0, size, 300)
    assert (matrix.access(places) == numbers[places]).all()
    for number in {int(numbers[0]), int(numbers[-1]), int(np.bincount(numbers % 97).argmax())}:
        found = np.flatnonzero(numbers == number)
        assert (matrix.select(number) == found).all()
        some = draw.integers(0, len(found), 20) if len(found) else np.empty(0, dtype=np.int64)
        assert (matrix.select(number, some) == found[some]).all() if len(found) else not len(matrix.select(number))
        ends = np.r_[0, size, places]
        assert (matrix.rank(number, ends) == np.searchsorted(found, ends)).all()
    assert matrix.rank(4_000_000_000, np.array([size]))[0] == (numbers == 4_000_000_000).sum()


def test_frequent_numbers_compress():
    skewed = np.minimum(np.random.default_rng(1).zipf(1.6, 400_000), 40_000).astype(np.uint32)
    matrix = wavelet.WaveletMatrix.of(skewed)
    share = np.bincount(skewed)[np.unique(skewed)] / len(skewed)
    bits = 8 * sum(len(p.body) for p in matrix.planes) / len(skewed)
    # Near the entropy of 3.9 bits, where plain planes take 13.
    assert len(matrix.planes) == 13 and bits < 1.25 * -(share * np.log2(share)).sum()


def test_text_ids_equal_the_library():
    tokenizer, ids = Tokenizer.from_file(PATH), token_files.TextIds(PATH)
    latin = "".join(map(chr, [*range(0x20, 0x7F), *range(0xA1, 0x100), 10]))
    draw = random.Random(8)
    texts = odd_texts(2000) + ["".join(draw.choice(latin) for _ in range(draw.randint(0, 30))) for _ in range(2000)]
    texts += ["It's we'LL 'RE 'd 'S1'm", "a<|endoftext|>b", "²³½x", "  \n \n", "ªºµ ÀÿŸ"]
    for text in texts:
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def plain(rows, end=2):
    """doc_id and ids in file order; rows of one doc_id in no particular order."""
    tokenizer = Tokenizer.from_file(PATH)
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.fixture(scope="module", params=[1, 500, token_files.SHARD_TOKENS])
def written(request, spark, tmp_path_factory):
    rows = [*mixed_documents(), (1, "same"), (1, "same"), (2, "same"), (3, "long word " * 9000), (-5, "first"), (None, "nameless")]
    folder = str(tmp_path_factory.mktemp("tokens") / "files")
    token_files.write_token_files(documents(spark, rows), folder, shard_tokens=request.param)
    return folder, plain(rows)


def test_documents_come_back(spark, written):
    folder, expected = written
    got = sorted((r.asDict() for r in token_files.read_documents(spark, folder, with_ids=True).collect()), key=lambda r: r["start"])
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == crc(r["ids"])
        at += r["n_tokens"]
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda i: (i is None, i or 0))
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == sorted((str(i), ids) for i, ids in expected)


def test_tokens_are_found_without_unpacking(spark, written):
    folder, _ = written
    documents_ = token_files.read_documents(spark, folder, with_ids=True).collect()
    times = Counter(t for r in documents_ for t in r["ids"])
    assert {r["token"]: r["n"] for r in token_files.token_totals(spark, folder).collect()} == times
    wanted = [2, times.most_common(2)[-1][0], min(times, key=times.get), 49_000]
    expected = [(t, i, r["start"] + i) for r in documents_ for i, t in enumerate(r["ids"]) if t in wanted]
    got = token_files.occurrences(spark, folder, wanted).collect()
    assert sorted((r["token"], r["place"], r["position"]) for r in got) == sorted(expected)
    by_start = {r["start"]: r["doc_id"] for r in documents_}
    assert all(by_start[r["position"] - r["place"]] == r["doc_id"] for r in got)

    flat = {r["start"] + i: t for r in documents_ for i, t in enumerate(r["ids"])}
    asked = [*range(0, len(flat), 71), len(flat) - 1, len(flat), -1, 0]
    frame = spark.createDataFrame([(a,) for a in asked], "position long")
    assert {r["position"]: r["token"] for r in token_files.tokens_at(spark, folder, frame).collect()} == {a: flat[a] for a in set(asked) if a in flat}


def test_no_documents(spark, tmp_path):
    token_files.write_token_files(documents(spark, []), str(tmp_path / "none"))
    assert token_files.read_documents(spark, str(tmp_path / "none")).count() == 0
    assert token_files.token_totals(spark, str(tmp_path / "none")).count() == 0
