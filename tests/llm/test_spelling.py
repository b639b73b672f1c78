import random
import zlib
from collections import Counter

import pytest

from ledgerlens.llm import spelling
from tests.llm.helpers import documents


def one_edit(a, b):
    """Whether two different words are one inserted, deleted or replaced letter apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, times=5):
    found = {}
    for word, n in counts.items():
        near = [(-m, other) for other, m in counts.items() if one_edit(word, other)]
        best = min(near, default=None)
        form = best[1] if best and -best[0] >= times * n else None
        found[word] = (form, n, len(near), -best[0] if form else None)
    out = []
    for word, (form, n, n_near, form_n) in found.items():
        root = word
        while found[root][0] is not None:
            root = found[root][0]
        out.append((word, form, root, n, n_near, form_n))
    return sorted(out, key=str)


def plain_counts(rows, one_in=199):
    total = Counter()
    for doc, text in rows:
        run = ""
        for letter in [*(text or ""), " "]:
            if "a" <= letter <= "z" or "A" <= letter <= "Z" or "À" <= letter <= "ÿ":
                run += letter.lower() if letter.isascii() else letter
                continue
            if run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if h % one_in == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                total[run] += 1
            run = ""
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def words_frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def rows_of(frame):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in frame.collect()), key=str)


@pytest.mark.parametrize("meetings", [0, 2, 48])
def test_near_words_of_a_small_alphabet(spark, monkeypatch, meetings):
    # So many words share halves that keys are made longer again and again.
    monkeypatch.setattr(spelling, "near_pairs", lambda words, f=spelling.near_pairs: f(words, meetings))
    draw = random.Random(4)
    words = {"".join(draw.choice("abç") for _ in range(draw.randint(6, 9))) for _ in range(500)}
    words |= {"a" * n for n in (6, 7, 8, 30, 31)} | {"ab" * 40, "ab" * 39 + "a", "ba" * 40}
    counts = {w: draw.choice([5, 5, 6, 25, 30, 125, 126, 700]) for w in sorted(words)}
    assert rows_of(spelling.variants(words_frame(spark, counts))) == plain_variants(counts)


def test_pairs_are_found_once(spark):
    counts = {"abcabc": 5, "abccabc": 5, "abcab": 5, "aaaaaa": 5, "aaaaaaa": 5}
    got = [(r["a"], r["b"]) for r in spelling.near_pairs(words_frame(spark, counts)).collect()]
    assert len(got) == len(set(got))
    assert {frozenset(p) for p in got} == {frozenset((a, b)) for a in counts for b in counts if one_edit(a, b)}


def test_forms_in_a_chain(spark):
    counts = {"colour": 5, "colours": 25, "coloursa": 125, "coloursab": 625, "coloursabc": 3125, "tiedword": 5, "tiedworda": 25, "tiedwordb": 25, "tiedwor": 24}
    got = {r["word"]: r for r in spelling.variants(words_frame(spark, counts)).collect()}
    assert {got[w]["root"] for w in counts if w.startswith("colour")} == {"coloursabc"}
    assert (got["tiedword"]["form"], got["tiedword"]["n_near"]) == ("tiedworda", 3)
    assert got["tiedwor"]["form"] is None and got["tiedwor"]["root"] == "tiedwor"


def test_texts(spark):
    draw = random.Random(9)
    pool = ["Straßen", "straße", "été", "élèves", "élève", "thinking", "thinkng", "×÷×÷×÷", "x" * 3000, "İstanbul", "under_score", "ABCDEF", "abcdef"]
    rows = [(draw.choice([1, 2, 3, None, -4]), " ".join(draw.choice(pool) + draw.choice(["", ".", "1", "\n", "-"]) for _ in range(60))) for _ in range(40)]
    rows += [(7, "repeated repeated")] * 3 + [(8, None), (9, ""), (10, " \n"), (11, "long word " * 20_000)]
    # Runs are altered often here, so that many documents meet it.
    words = spelling.word_counts(documents(spark, rows), one_in=3)
    counts = plain_counts(rows, 3)
    assert {r["word"]: r["n"] for r in words.collect()} == counts
    assert rows_of(spelling.spelling_variants(documents(spark, rows))) == plain_variants(plain_counts(rows))


def test_counts_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 3)
    rows = [(i, "alphabet betagamma gammadelta deltas epsilon") for i in range(8)]
    assert {r["word"]: r["n"] for r in spelling.word_counts(documents(spark, rows)).collect()} == plain_counts(rows)


def test_no_words(spark):
    assert spelling.spelling_variants(documents(spark, [])).count() == 0
    assert spelling.spelling_variants(documents(spark, [(1, None), (2, "short")])).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(words_frame(spark, {"abcdef": 5}), times=1)
