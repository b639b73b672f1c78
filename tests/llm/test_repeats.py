import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import common, jaccard_join, repeats, substring_dedup, suffix_dedup
from ledgerlens.llm.components import components
from ledgerlens.llm.shingles import shingle_set, windows, word_numbers
from tests.llm.helpers import documents, mixed_documents, sentence


def test_windows_are_equal_exactly_for_equal_runs():
    draw = random.Random(2)
    words = [draw.choice([b"a", b"b", b"c"]) for _ in range(300)]
    for size in (1, 2, 5, 8, 35):
        seen = defaultdict(set)
        for i, h in enumerate(windows(word_numbers(words), size).tolist()):
            seen[h].add(tuple(words[i : i + size]))
        assert all(len(x) == 1 for x in seen.values())
        assert len(seen) == len({tuple(words[i : i + size]) for i in range(len(words) - size + 1)})
    assert not len(windows(word_numbers(words[:3]), 5))


def brute_suffixes(rows, window):
    """By doc_id (null last) and text; rows of one id and text are one document."""
    order = sorted({(i is None, i or 0, t or "", i) for i, t in rows}, key=lambda x: x[:3])
    seen, out = set(), {}
    found = []
    for _, _, t, i in order:
        b = t.encode()
        gone = bytearray(len(b))
        new = []
        for k in range(len(b) - window + 1):
            s = b[k : k + window]
            if s in seen:
                gone[k : k + window] = b"\1" * window
            seen.add(s)
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        found.append((str(i), len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
        out[i, t] = found[-1]
    return sorted(out[i, t or ""] for i, t in rows)


def test_suffix_dedup_equals_brute_force(spark):
    rows = [r for r in mixed_documents() if r[0] is not None]
    rows += [(1000 + k, "ab" * k) for k in (49, 50, 51, 90)] + [(1, "é" * 120), (1, "é" * 120), (2, "xé" + "é" * 99)]
    got = suffix_dedup.remove_earlier_strings(documents(spark, rows), with_text=True).collect()
    have = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got)
    assert have == brute_suffixes(rows, 100)
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]
        if not r["n_removed"]:
            assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]


def test_suffix_dedup_without_ids_and_one_id_with_two_texts(spark):
    shared = sentence(random.Random(9), 40)
    got = suffix_dedup.remove_earlier_strings(documents(spark, [(None, shared), (9, shared + " tail"), (3, "a"), (3, shared)])).collect()
    removed = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in got}
    n = len(shared.encode())
    assert removed == {(None, n): n, (9, n + 5): n, (3, 1): 0, (3, n): 0}


@pytest.mark.parametrize("window", [31, 64, 100])
def test_suffix_classes_follow_the_order(window):
    draw = random.Random(window)
    text = np.frombuffer(bytes(draw.choice(b"ab") for _ in range(600)) * 3 + b"a" * 300 + bytes(draw.choice(b"abcd") for _ in range(500)), dtype=np.uint8)
    starts = np.arange(len(text) - window + 1)
    got = suffix_dedup.suffix_classes(text, starts, window)
    strings = [text[i : i + window].tobytes() for i in starts]
    rank = {s: k for k, s in enumerate(sorted(set(strings)))}
    _, dense = np.unique(got, return_inverse=True)
    assert dense.tolist() == [rank[s] for s in strings]


def test_difference_cover():
    for v in (8, 16, 24, 32):
        cover = suffix_dedup.difference_cover(v)
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    with pytest.raises(ValueError):
        suffix_dedup.remove_earlier_strings(None, window=10)


def brute_windows(rows, size):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = defaultdict(int)
    for w in words:
        for k in range(len(w) - size + 1):
            count[tuple(w[k : k + size])] += 1
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if count[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((str(i), len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out)


def test_substring_dedup_equals_brute_force(spark):
    rows = [*mixed_documents(), (1, "p q " * 40), (2, "p q " * 18), (3, sentence(random.Random(1), 3000)), (8, "twice " * 35), (8, "twice " * 35)]
    got = substring_dedup.remove_repeated_windows(documents(spark, rows), with_text=True).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute_windows(rows, 35)
    for r in got:
        assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]
        assert sum(s["end"] - s["start"] for s in r["intervals"]) == r["n_removed"]


@pytest.mark.parametrize("operator", [suffix_dedup, substring_dedup])
def test_runs_of_a_frequent_anchor_are_not_gathered(spark, operator, monkeypatch):
    monkeypatch.setattr(repeats, "FREQUENT_RUNS", 5, raising=False)
    monkeypatch.setattr(repeats, "SINGLE_WINDOWS", 300, raising=False)
    draw = random.Random(11)
    passage = sentence(draw, 60)
    rows = [(k, f"{sentence(draw, 20)} {passage} {sentence(draw, 20)}") for k in range(60)]
    rows += [r for r in mixed_documents() if r[0] is not None and r[0] >= 60] + [(900, rows[3][1] + " end"), (901, rows[3][1])]
    docs = documents(spark, rows)
    if operator is suffix_dedup:
        sent = operator._send(100)
        candidates = repeats.candidate_runs(common.distinct_texts(docs).nodes, operator._units, 100, 32)
        got = operator.remove_earlier_strings(docs).collect()
        have = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got)
        assert have == brute_suffixes(rows, 100)
    else:
        sent = operator._send(35)
        candidates = repeats.candidate_runs(common.distinct_texts(docs).nodes, operator._units, 35, 8)
        got = operator.remove_repeated_windows(docs).collect()
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute_windows(rows, 35)
    gathered = candidates.mapInArrow(sent, repeats.SENT).filter("weight > 0 and body is not null").groupBy("anchor").count()
    assert (gathered.agg(F.max("count").alias("n")).first()["n"] or 0) <= 5


def brute_links(rows):
    up = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(up))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            same_id = rows[a][0] is not None and rows[a][0] == rows[b][0]
            if same_id or both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = defaultdict(lambda: None)
    for a, (i, _) in enumerate(rows):
        if i is not None:
            r = root(a)
            least[r] = i if least[r] is None else min(least[r], i)
    return sorted((str(i), len(sets[a]), str(least[root(a)])) for a, (i, _) in enumerate(rows))


@pytest.mark.parametrize("seed", [3, 4])
def test_jaccard_join_equals_brute_force(spark, seed):
    draw = random.Random(seed)
    rows = mixed_documents(seed)
    # Chains of small changes, short texts, and one id with two texts.
    words = sentence(draw, 50).split()
    for k in range(12):
        words[draw.randrange(50)] = f"new{k}"
        rows.append((500 + k, " ".join(words)))
    rows += [(600 + k, sentence(draw, n)) for k, n in enumerate((1, 1, 2, 5, 6, 7))] + [(700, "w1"), (701, "W1"), (702, "a b c d e f"), (703, "a b c d e f g")]
    rows += [(800, "one text of eight different words here now"), (800, rows[1][1]), (800, rows[1][1])]
    got = jaccard_join.near_duplicates(documents(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute_links(rows)
    kept = defaultdict(set)
    for r in got:
        if r["kept"] and r["n_shingles"]:
            kept[r["component_id"]].add((r["doc_id"], r["tag"]))
    assert all(len(x) == 1 for c, x in kept.items() if c is not None)
    assert {r["component_id"] for r in got if r["n_shingles"]} == set(kept)
    assert all(r["kept"] for r in got if not r["n_shingles"])


def test_lists_yield_exactly_the_pairs_that_can_link():
    draw = np.random.default_rng(5)
    base = np.unique(draw.integers(1, 1 << 60, 40).astype(np.uint64))
    sets = [np.unique(np.where(draw.random(len(base)) < 0.12, draw.integers(1, 1 << 60, len(base)).astype(np.uint64), base)) for _ in range(40)]
    sets += [s[: draw.integers(1, len(s))] for s in sets]
    wanted = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if jaccard_join.linked(sets[a], sets[b], 75)}
    assert wanted

    class Table:
        value = (base[3:4], np.array([50]))

    import pyarrow as pa

    for light in (0, 10, 30, 500):
        listed = jaccard_join._listed(Table, light, 75)
        jaccard_join.shingle_set, kept = (lambda t: sets[int(t)]), jaccard_join.shingle_set
        try:
            batch = pa.RecordBatch.from_pydict({"id": range(len(sets)), "label": range(len(sets)), "text": [str(i) for i in range(len(sets))]})
            (out,) = listed(iter([batch]))
        finally:
            jaccard_join.shingle_set = kept
        columns = [out.column(k).to_numpy().astype(np.int64) for k in range(5)]
        sketches = jaccard_join.Sketches([jaccard_join.sketch(sets[i]).tobytes() for i in columns[1].tolist()])

        def named_by(label, columns=columns, sketches=sketches, light=light):
            whole = np.zeros(len(label), dtype=np.int64)
            entries = jaccard_join.Entries(columns[0], columns[1], label, columns[3], columns[4], whole, sketches, whole > 0)
            return {tuple(map(int, p)) for p in jaccard_join.candidates(entries, light, 75)}

        found = {frozenset(p) for p in named_by(columns[2])}
        assert {frozenset(p) for p in wanted} <= found, light
        # Most pairs that do not link are not named.
        assert len(found) < len(sets) ** 2 / 6
        # Labels of several sets are named as a whole.
        named = named_by(columns[1] % 3)
        assert all(a % 3 == b % 3 or (a, b % 3) in named or (b, a % 3) in named for a, b in wanted)


def test_sketches_bound_the_difference():
    draw = np.random.default_rng(8)
    sets = [np.unique(draw.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 3, 60, 64, 65, 130, 700, 5000)]
    sets += [np.unique(np.r_[s[: len(s) * 9 // 10], draw.integers(0, 1 << 62, 9).astype(np.uint64)]) for s in sets]
    made = jaccard_join.Sketches([jaccard_join.sketch(s).tobytes() for s in sets])
    a, b = (x.reshape(-1) for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    differ = made.differ(a, b)
    for i, j, d in zip(a.tolist(), b.tolist(), differ.tolist(), strict=True):
        assert d <= len(np.setxor1d(sets[i], sets[j])) and (i != j or d == 0)
        if jaccard_join.linked(sets[i], sets[j], 75):
            assert d <= jaccard_join.most_different(np.int64(len(sets[i])), np.int64(len(sets[j])), 75)


def test_rare_shingles_come_first():
    draw = np.random.default_rng(4)
    known = np.unique(draw.integers(0, 1 << 63, 300).astype(np.uint64))
    rare = jaccard_join.RareFirst(known, draw.integers(1, 9, len(known)))
    for n in (0, 1, 40, 300):
        shingles = np.unique(np.r_[known[:n], draw.integers(0, 1 << 63, 60).astype(np.uint64)])
        frequency = rare.frequency(shingles)
        order = shingles[np.lexsort((shingles, frequency))]
        for k in (0, 1, 30, 400):
            assert (rare.first(shingles, k) == order[:k]).all()


@pytest.mark.parametrize("size", [2, 5])
def test_lists_longer_than_a_block(spark, monkeypatch, size):
    """Many sets that share rare shingles but do not all link; lists are worked in blocks."""
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", size)
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", 3)
    monkeypatch.setattr(jaccard_join, "GATHERINGS", 1)
    draw = random.Random(13)
    base = sentence(draw, 40).split()
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(40)] = f"n{draw.randrange(500)}"
        rows.append((k, " ".join(words)))
    got = jaccard_join.near_duplicates(documents(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute_links(rows)


def test_nothing_is_left_but_the_result(spark):
    import os

    from ledgerlens.llm import queries

    def tables():
        return {t.name for t in spark.catalog.listTables() if t.name.startswith("ledgerlens")}

    before, known = tables(), len(common._scopes[0].folders)
    for name in ("op3_suffix_dedup", "op4_substring_dedup", "op7_ngram_jaccard_join"):
        queries.QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert tables() == before
    left = [f for f in common._scopes[0].folders[known:] if os.path.exists(f)]
    assert [os.listdir(f) for f in left] == [["result"]] * 3


def test_overlaps_and_components_of_a_block(monkeypatch):
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 60, draw.integers(0, 40)).astype(np.uint64)) for _ in range(50)]
    for columns in (7, 4096):
        monkeypatch.setattr(jaccard_join, "COLUMNS", columns)
        got = jaccard_join.overlaps(sets[:20], sets[10:])
        assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[10:]] for a in sets[:20]]
    chain = [np.arange(k, k + 20).astype(np.uint64) for k in range(0, 10, 2)] + [np.arange(100, 110).astype(np.uint64)]
    assert jaccard_join.connect(np.array([9, 4, 7, 5, 6, 1]), chain, 75) == [(4, 9), (4, 7), (4, 5), (4, 6)]


def test_no_documents(spark):
    none = documents(spark, [])
    assert jaccard_join.near_duplicates(none).count() == 0
    assert substring_dedup.remove_repeated_windows(none).count() == 0
    assert suffix_dedup.remove_earlier_strings(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 200)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_sets():
    assert len(shingle_set("")) == 0 and len(shingle_set(" \n")) == 0
    assert len(shingle_set("a b")) == 1 and len(shingle_set("a b c d e f")) == 2
    assert shingle_set("A b C").tolist() == shingle_set("a B\tc").tolist() != shingle_set("a b").tolist()
