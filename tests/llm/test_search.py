import hashlib
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import ledgerlens.llm.queries as corpus
from ledgerlens.llm import decontaminate, topk
from tests.llm.helpers import documents, mixed_documents, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_hits(rows, items, size=10):
    patterns = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(UP))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            patterns.setdefault(tuple(w[k : k + size]), set()).add("null" if item is None else str(item))
    out = []
    for i, text in rows:
        w = WORD.findall((text or "").translate(UP))
        hit, found = set(), set()
        for p, ids in patterns.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    found |= ids
        out.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return sorted(out)


def bench():
    draw = random.Random(8)
    rows = mixed_documents()
    long = rows[1][1].split()
    return [(1, " ".join(long[3:40])), (1, " ".join(long[3:40])), (10, "-".join(long[30:42])), (2, "w7 w9"), (3, ""), (4, None), (None, "W1"), (5, "é été"), (6, sentence(draw, 30)), (7, "w1")]


@pytest.mark.parametrize("block", [1 << 23, 60])
def test_hits_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    # Hits of several blocks are joined by id.
    rows = [r for r in mixed_documents() if r[0] is not None] + [(1, "x," + "w7 w9;" * 2000), (2, "É ÉTÉ é été"), (3, None)]
    items = spark.createDataFrame([(i, t, 0) for i, t in bench()], "item_id long, text string, doc_id int")
    got = decontaminate.benchmark_hits(documents(spark, rows), items).withColumn("n_hit", decontaminate.hit_words("runs")).collect()
    have = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest()) for r in got)
    assert have == brute_hits(rows, bench())
    text = dict(rows)
    for r in got:
        for run, span in zip(r["runs"], r["spans"], strict=True):
            part = text[r["doc_id"]].encode()[span["start"] : span["end"]].decode()
            assert len(WORD.findall(part.translate(UP))) == run["last"] - run["first"]
    flags = {r["doc_id"]: r["hit"] for r in decontaminate.hit_flag(documents(spark, rows), items, "hit").collect()}
    assert flags == {r["doc_id"]: r["n_hit"] > 0 for r in got}


def test_rows_without_distinct_ids_are_the_same_for_blocks(spark, monkeypatch):
    text = sentence(random.Random(5), 60)
    words = text.split()
    rows = [(1, text), (1, text), (1, "clean words"), (None, text), (None, None), (None, "more clean words"), (2, " ".join(words[:25]))]
    bench = [(k, " ".join(words[4 * k : 4 * k + 12])) for k in range(10)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = []
    for block in (1 << 20, 100):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = decontaminate.benchmark_hits(documents(spark, rows), items)
        assert got.columns == ["doc_id", "n_words", "runs", "spans", "items"]
        found.append(sorted(repr(r) for r in got.collect()))
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_repeated_rows_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    got = decontaminate.benchmark_hits(documents(spark, [(1, "x a b"), (1, "x a b"), (None, None)]), items)
    assert sorted(len(r["items"]) for r in got.collect()) == [0, 1, 1]
    assert decontaminate.benchmark_hits(documents(spark, []), items).count() == 0
    clean = decontaminate.benchmark_hits(documents(spark, [(1, "x a b")]), items.limit(0)).first()
    assert clean["items"] == [] and clean["n_words"] == 3


def brute_top(rows, k, every):
    kept = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(float(np.float32(x)) * 1024)) for x in v]))
    out = []
    for i, q in kept:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c, strict=False)), j) for j, c in kept if j != i)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_top_k_equals_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET_ROWS", 32)
    draw = np.random.default_rng(4)
    rows = [(int(i), (draw.normal(size=8) * np.exp(spread * draw.normal())).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + k, rows[5][1]) for k in range(15)]  # ties
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (2004, []), (2005, [1.0]), (None, [1.0] * 8), (2100, [0.0] * 8)]
    frame = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double").repartition(5)
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0, 10).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, 10, 50)


def test_blocks_large_values_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rows = [(i * 50, [float(i) * 1e4, -1e9]) for i in range(12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 50 == 0, 20).collect())) == [
        (q, r, j, min(s, 2**63 - 1)) for q, r, j, s in resorted(brute_top(rows, 20, 50))
    ]
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(frame, F.lit(False)).count() == 0


def test_every_vector_of_a_query_id_has_its_list(spark):
    draw = np.random.default_rng(9)
    rows = [(int(i), draw.normal(size=4).astype(np.float32).tolist()) for i in range(1, 40)]
    twice = [(0, [1.0, 0.0, 0.0, 0.0]), (0, [0.0, -1.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([*rows, *twice], "vec_id long, embedding array<float>")
    got = topk.top_k(frame, F.col("vec_id") == 0, 5).collect()
    want = []
    for query in (twice[0], twice[1]):
        want += [tuple(r) for r in brute_top([query, *rows], 5, 1000)]
    assert sorted(map(tuple, got)) == sorted(want) and len(got) == 10


def resorted(rows):
    """Scores at the end of long are ties."""
    out = []
    for q in sorted({r[0] for r in rows}):
        mine = sorted((-min(s, 2**63 - 1), j) for a, _, j, s in rows if a == q)
        out += [(q, rank, j, -s) for rank, (s, j) in enumerate(mine, 1)]
    return out


SQL = sorted(corpus.ORACLES)


@pytest.mark.parametrize("name", SQL)
def test_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    base = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "labels", "conversations"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = base.sql(corpus.ORACLES[name])
    found = corpus.QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    assert sorted(found.columns) == columns
    places = [result.columns.index(c) for c in columns]
    wanted = sorted([str(row[k]) for k in places] for row in result.fetchall())
    assert sorted([str(row[c]) for c in columns] for row in found.collect()) == wanted


def test_every_operator_has_a_query():
    assert [sum(n.startswith(f"op{k}_") for n in corpus.QUERIES) for k in range(1, 14)] == [1] * 13
    assert "ledgerlens.llm" in sys.modules
