import random
import zlib

import numpy as np
import pytest

from ledgerlens.llm import common, language, quality, toxicity
from tests.llm.helpers import documents

BAD = ["zorgish", "blarnt"]


def labelled_texts(n=240, seed=1):
    draw = random.Random(seed)
    rows, toxic, good = [], [], []
    for i in range(n):
        words = [draw.choice(["ala", "beri", "comu", "dano", "epsi", "fura"]) + str(draw.randrange(30)).replace("1", "x") for _ in range(draw.randint(5, 80))]
        words = ["".join(c for c in w if c.isalpha()) for w in words]
        if bad := i % 4 == 0:
            words[draw.randrange(len(words))] = draw.choice(BAD)
        if junk := i % 3 == 0:
            words = [w + draw.choice(["###", "$$$", "&&&"]) for w in words]
        rows.append((i, " ".join(words)))
        toxic.append((i, int(bad)))
        good.append((i, int(not junk)))
    return rows, toxic, good


@pytest.fixture(scope="module")
def lexicon(spark):
    rows, toxic, _ = labelled_texts()
    return toxicity.learn(documents(spark, rows), spark.createDataFrame(toxic, "doc_id long, label int"))


def test_folding():
    assert toxicity.fold_text("Z0RG1SH").split() == ["zorgish"]
    assert toxicity.fold_text("zоrgіsh Ｚｏｒｇ").split() == ["zorgish", "zorg"]
    assert toxicity.fold_text("bl@rnt, été! 1999 $$$ word###").split() == ["blarnt", "été", "word"]
    assert toxicity.fold_text("") == ""


def test_lexicon_scores(spark, lexicon):
    rows, toxic, _ = labelled_texts(seed=2)
    got = {r["doc_id"]: r["score"] for r in toxicity.with_score(documents(spark, rows), lexicon).collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, y in toxic)
    for text in ("say z0rgish now", "ZORGISH###", "blаrnt"):
        assert toxicity.toxicity_score(text, lexicon) >= 0.5
    assert toxicity.toxicity_score(None, lexicon) < 0.5 and toxicity.toxicity_score("", lexicon) < 0.5
    long = "ala " * 200_000
    assert toxicity.toxicity_score(long, lexicon) < 0.5 < toxicity.toxicity_score("ala zorgish " * 50_000, lexicon)


@pytest.mark.parametrize("spelling", ["worthle$$", "w0r7hl355", "worthle$$!!", "W0RTHLE55!", "idi07", "1d107", "idi07!", "h4t3", "a$$", "a$$$!"])
def test_signs_for_letters_at_the_end_of_a_word(spelling):
    lexicon = toxicity.Lexicon(tuple((f" {w} ", 5.0) for w in ("worthless", "idiot", "hate", "ass")), ("idiot savant", "old hate"), 0.5, 4.0)
    assert [m[2] for m in toxicity.matches(f"you {spelling} there", lexicon)[0]] == [5.0]
    assert toxicity.matches("an idi07 savant, 0ld h4t3!", lexicon)[0] == []
    assert toxicity.matches("as5ess idiots 1999 $$$ class5", lexicon)[0] == []


def test_a_word_with_noise_counts_once():
    lexicon = toxicity.Lexicon(((" zorg", 5.0), (" zorgish ", 5.0)), ("old zorgish tree",), 0.5, 4.0)
    for text in ("say zorgish now", "say zorgish!!! now", "say zorgi$h$$$ now"):
        assert len(toxicity.matches(text, lexicon)[0]) == 2
    assert toxicity.matches("an old zorgish!! tree", lexicon)[0] == []
    assert len(toxicity.matches("zorg" + "01" * 50_000, lexicon)[0]) == 1


def naive_density(text, lexicon):
    """Word by word, without an automaton."""
    words = toxicity.fold_text(text).split()
    spared = set()
    for phrase in lexicon.exceptions:
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                spared |= set(range(k, k + len(p)))
    total = 0.0
    for k, word in enumerate(words):
        for pattern, weight in lexicon.entries:
            held = word == pattern.strip() if pattern.endswith(" ") else word.startswith(pattern.strip())
            total += weight * (held and k not in spared)
    return total / (1 + np.log2(1 + len(words)))


def test_matching_equals_a_plain_loop():
    lexicon = toxicity.Lexicon(((" zor", 2.0), (" zorg ", 5.0), (" bla", 1.5), (" blarnt ", 4.0), (" été ", 3.0)), ("old zorg", "zorg tree old", "blarnt blarnt", "bla"), 0.5, 4.0)
    draw = random.Random(12)
    pieces = ["zorg", "ZORG", "zоrg", "z0rg", "zor", "zorgs", "bla", "blarnt", "8larnt", "b1arnt", "old", "0ld", "tree", "été", "ÉTÉ", "x", "1999", "ｚｏｒｇ"]
    for _ in range(3000):
        text = "".join(draw.choice(pieces) + draw.choice([" ", " ", "\n", ", ", " - ", "\u200b "]) for _ in range(draw.randint(0, 12)))
        assert toxicity.density(text, lexicon) == pytest.approx(naive_density(text, lexicon)), repr(text)


def test_exception_phrases():
    lexicon = toxicity.Lexicon(((" zorg", 5.0),), ("old zorg tree",), 0.5, 4.0)
    assert toxicity.matches("the old zorg tree", lexicon)[0] == []
    assert len(toxicity.matches("the old zorg trees and Z0RGS", lexicon)[0]) == 2
    assert toxicity.density("zorg " * 3, lexicon) > toxicity.density("zorg " * 3 + "word " * 500, lexicon)


def test_learned_exceptions(spark):
    texts = [f"zorgish person {'abc' * (i % 5)}" for i in range(40)] + ["zorgish tree in the park"] * 1 + [f"plain text number {'x' * (i % 7)}" for i in range(80)]
    texts += [f"zorgish tree {'y' * (i % 3)}" for i in range(4)]
    labels = [(i, int(t.startswith("zorgish person"))) for i, t in enumerate(texts)]
    found = toxicity.learn(documents(spark, list(enumerate(texts))), spark.createDataFrame(labels, "doc_id long, label int"))
    assert toxicity.toxicity_score("zorgish person", found) >= 0.5 > toxicity.toxicity_score("zorgish tree", found)


def test_toxicity_without_examples(spark):
    docs = documents(spark, [(1, "a b"), (1, "a b"), (None, None)])
    none = spark.createDataFrame([], "doc_id long, label int")
    for labels in (none, spark.createDataFrame([(1, 0), (None, 1)], none.schema)):
        lexicon = toxicity.learn(docs, labels)
        out = toxicity.with_score(docs, lexicon)
        assert out.columns == docs.columns and [r["score"] < 0.5 for r in out.collect()] == [True] * 3
        assert toxicity.with_score(docs.limit(0), lexicon).count() == 0


def test_quality(spark):
    rows, _, good = labelled_texts()
    machine = quality.learn(documents(spark, rows), spark.createDataFrame(good, "doc_id long, label int"))
    rows, _, good = labelled_texts(seed=2)
    docs = documents(spark, [*rows, (None, None), (1, ""), (1, "word " * 100_000)])
    out = quality.with_score(docs, machine)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows) + 3 and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got if r["text"] and len(r["text"]) < 10_000}
    assert np.mean([(score[i] >= 0.5) == bool(y) for i, y in good]) > 0.97


def test_machine_equals_sum_over_pairs():
    draw = np.random.default_rng(3)
    size = quality.WORDS + len(quality.STATISTICS) + quality.SIZE_CLASSES
    machine = quality.Machine(0.3, draw.normal(size=size), draw.normal(size=(size, quality.FACTORS)))
    at, x = quality.features("some words and words. Again\nlines ### 12")
    slow = 0.3 + sum(machine.linear[i] * v for i, v in zip(at, x, strict=True))
    slow += sum((machine.factors[at[i]] @ machine.factors[at[j]]) * x[i] * x[j] for i in range(len(at)) for j in range(i))
    assert machine.margin(at, x) == pytest.approx(slow)


def test_quality_without_labels(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r["score"] for r in quality.with_score(docs, quality.learn(docs, none)).collect()} == {0.5}
    one = quality.learn(docs, spark.createDataFrame([(1, 1)], none.schema))
    assert all(r["score"] > 0.9 for r in quality.with_score(docs, one).collect())
    assert quality.with_score(docs.limit(0), one).count() == 0


TONGUES = {"aa": "the and ing tion of with", "bb": "der die und ung keit schaft", "cc": "que los ción mente ado y", "dd": "été eux ment oise que les", "ee": "jou nie het van een geen", "ff": "och att det som för med"}


def tongue_rows(n, seed):
    draw = random.Random(seed)
    return [(i, " ".join(draw.choice(TONGUES[k].split()) for _ in range(draw.randint(4, 40))), k) for i in range(n) for k in [list(TONGUES)[i % len(TONGUES)]]]


@pytest.mark.parametrize("languages", [1, 2, 4, 6])
def test_languages(spark, languages):
    kept = list(TONGUES)[:languages]
    rows = [r for r in tongue_rows(300, 1) if r[2] in kept]
    schema = "doc_id long, text string, lang string, score double"
    frame = spark.createDataFrame([(*r, 9.0) for r in rows] + [(1, "many", None, 9.0), (2, None, "aa", 9.0), (3, "12 !", "zz", 9.0)], schema)
    coder = language.learn(frame)
    assert coder.languages == tuple(sorted(kept))
    test = [r for r in tongue_rows(120, 2) if r[2] in kept]
    out = language.identify(spark.createDataFrame([(*r, 9.0) for r in test], schema), coder)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "ambiguous"]
    got = out.collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)
    odd = language.identify(documents(spark, [(None, None), (1, ""), (1, "12 ?!"), (2, "x" * 200_000), (2, "é")]), coder).collect()
    assert [r["lang_pred"] == "und" for r in odd] == [True, True, True, False, False]
    assert [r["score"] for r in odd[:3]] == [0.0] * 3


def test_mixed_text_is_ambiguous(spark):
    frame = spark.createDataFrame(tongue_rows(300, 1), "doc_id long, text string, lang string")
    text = " ".join((TONGUES["aa"] + " " + TONGUES["bb"]).split() * 3)
    coder = language.learn(frame)
    clear, mixed = (language.identify(documents(spark, [(1, t)]), coder).first()["score"] for t in (TONGUES["aa"], text))
    assert clear > mixed


@pytest.mark.parametrize("languages", [2, 3, 6])
def test_decoding_equals_a_plain_search_for_the_nearest_word(spark, languages):
    kept = list(TONGUES)[:languages]
    frame = spark.createDataFrame([r for r in tongue_rows(200, 1) if r[2] in kept], "doc_id long, text string, lang string")
    coder = language.learn(frame)
    draw = random.Random(3)
    texts = [" ".join(draw.choice(TONGUES[draw.choice(kept)].split()) for _ in range(draw.randint(1, 12))) for _ in range(60)]
    lead = 0.35
    got = {r["doc_id"]: r for r in language.identify(documents(spark, list(enumerate(texts))), coder, lead).collect()}
    for i, text in enumerate(texts):
        x = language.grams(text).astype(np.float64)
        losses = []
        for word in coder.code:
            loss = 0.0
            for bit, sign in enumerate(word):
                margin = float(sum(x[g] * coder.weights[g, bit] for g in np.flatnonzero(x))) + float(coder.bias[bit])
                loss += coder.trust[bit] * np.log1p(np.exp(-margin * sign))
            losses.append(loss)
        shares = sorted((np.exp(min(losses) - v) / sum(np.exp(min(losses) - u) for u in losses) for v in losses), reverse=True)
        r = got[i]
        assert r["lang_pred"] == coder.languages[int(np.argmin(losses))] and r["score"] == pytest.approx(shares[0], abs=1e-4)
        if abs(shares[0] - shares[1] - lead) > 1e-3:
            assert r["ambiguous"] == (shares[0] - shares[1] < lead)
    assert {r["ambiguous"] for r in got.values()} == {True, False}


def test_signs_and_numbers_are_no_letters(spark):
    coder = language.learn(spark.createDataFrame(tongue_rows(100, 1), "doc_id long, text string, lang string"))
    texts = ["²", "½", "①②", "_", "12 ?!", "🙂", "٣", "ª", "é", "中", "x", "²é"]
    got = language.identify(documents(spark, list(enumerate(texts))), coder).orderBy("doc_id").collect()
    assert [r["lang_pred"] == "und" for r in got] == [True] * 7 + [False] * 5


def test_nothing_to_learn(spark):
    frame = documents(spark, [(1, "abc")])
    coder = language.learn(frame.withColumn("lang", frame["lang"].cast("string")).limit(0))
    assert language.identify(frame, coder).first()["lang_pred"] == "und"


def test_code_words_are_far_apart():
    for n in (2, 3, 4, 5, 6, 12, 40):
        m = language.code_matrix(n)
        distance = min(int((m[i] != m[j]).sum()) for i in range(n) for j in range(i))
        assert distance >= (1 if n == 2 else 2 if n == 3 else m.shape[1] // 4)


def test_folds(spark):
    rows = [(0, ""), (17, ""), (-3, ""), (None, "")]
    got = [r[0] for r in documents(spark, rows).select(common.fold("doc_id", 5)).collect()]
    assert got == [zlib.crc32(t) % 5 for t in (b"0", b"17", b"-3", b"")]
