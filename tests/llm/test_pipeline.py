import importlib
import sys
from collections import defaultdict
from pathlib import Path

import pytest

from ledgerlens.llm import jaccard_join, toxicity
from tests.llm.helpers import sentence
from tests.llm.test_repeats import brute_links, brute_suffixes
from tests.llm.test_search import brute_hits

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
corpus_pipeline = importlib.import_module("corpus_pipeline")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, copies int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import random

    path = tmp_path_factory.mktemp("corpus")
    draw = random.Random(6)
    item = sentence(draw, 14)
    passage = sentence(draw, 60)
    rows, labels = [], []
    for i in range(160):
        text = sentence(draw, draw.randint(20, 60))
        if i % 5 == 0:
            text += draw.choice([" zorgish", " blarnt"])
        labels.append((i, 1, int(i % 5 == 0)))
        if i % 16 == 3:
            text = f"{text} {item} end"
        if i % 16 == 7:
            text = f"{passage} {text}"
        rows.append((i, text))
    rows += [(200 + i, rows[i][1]) for i in range(1, 9)] + [(300, rows[2][1] + " more"), (9, rows[9][1]), (None, None), (None, rows[11][1]), (400, ""), (401, "")]
    spark.createDataFrame([(i, t, "xx", "s", len(t or ""), 1) for i, t in rows], COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "best_fit_packing":
            assert docs.columns == columns
        seen[name] = (before, docs.collect())

    before, after = seen["toxicity"]
    assert sorted(str((r["doc_id"], r["text"])) for r in after) == sorted(
        str(x) for x in before if not any(w in (x[1] or "") for w in ("zorgish", "blarnt"))
    )

    before, after = seen["ngram_jaccard_join"]
    groups = defaultdict(set)
    for i, n, c in brute_links(before):
        if n:
            groups[c].add(i)
    left = defaultdict(int)
    component = {i: c for i, n, c in brute_links(before) if n and i != "None"}
    for r in after:
        if (r["text"] or "").split():
            left[component.get(str(r["doc_id"]), "None")] += 1
    assert set(left) <= set(groups) and all(n == 1 for n in left.values())
    assert sum(not (r["text"] or "").split() for r in after) == sum(not (t or "").split() for _, t in before)

    before, after = seen["suffix_dedup"]
    assert len(before) == len(after) and all(r["n_chars"] == len(r["text"]) for r in after if r["text"])
    removed = {i: n for i, _, n, _, _ in brute_suffixes(before, 100)}
    old = {str(i): t for i, t in before if i is not None}
    for r in after:
        if r["doc_id"] is not None:
            assert len(old[str(r["doc_id"])].encode()) - removed[str(r["doc_id"])] == len(r["text"].encode())
    assert any(removed.values())

    before, after = seen["decontamination"]
    item = spark.read.parquet(f"{folder}/benchmark.parquet").filter("text is not null").first()
    hit = brute_hits(before, [(item["item_id"], item["text"])])
    assert len(after) == sum(n == 0 for _, _, n, _, _ in hit) < len(before)

    before, after = seen["best_fit_packing"]
    whole = defaultdict(int)
    for r in after:
        whole[r["sequence_id"]] += r["length"]
    assert max(whole.values()) <= 2048 and len(after) >= len(before)


def test_run_and_empty_documents(spark, folder, tmp_path):
    import os

    from ledgerlens.llm import common

    known = len(common._scopes[0].folders)
    whole = corpus_pipeline.run(spark, folder)
    assert whole.count() > 0 and "sequence_id" in whole.columns
    # Of all that the stages wrote, their outputs are left.
    left = [f for f in common._scopes[0].folders[known:] if os.path.exists(f)]
    assert [sorted(os.listdir(f)) for f in left] == [[f"{i}-{name}" for i, (name, _) in enumerate(corpus_pipeline.STAGES, 1)]]
    assert not corpus_pipeline._left
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_stages_that_are_not_written_in_between(spark, folder):
    """A stage does not clear what its input still has to be computed from."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, folder)
    assert docs.count() > 0


def test_operators_are_the_ones_of_the_library():
    assert corpus_pipeline.jaccard_join is jaccard_join and corpus_pipeline.toxicity is toxicity
    assert corpus_pipeline.ORACLE_SQL is None
