"""Small documents for the operators, and plain versions of what they must return."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, tag long, score double, key string, id int, label string"


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    """Documents with further columns, some named like columns that operators make."""
    return spark.createDataFrame([(i, t, "xx", "s", len(t or ""), 1, 0.5, "k", 2, "l") for i, t in rows], DOCUMENTS)


WORDS = [f"w{i}" for i in range(400)] + ["Ärger", "été", "niño", "AbC"]


def sentence(draw: random.Random, words: int) -> str:
    return " ".join(draw.choice(WORDS) for _ in range(words))


def mixed_documents(seed: int = 3) -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, empty, null and periodic texts."""
    draw = random.Random(seed)
    passage, other = sentence(draw, 60), sentence(draw, 80)
    rows: list[tuple[int | None, str | None]] = []
    for i in range(60):
        kind = i % 6
        if kind == 0:
            text = sentence(draw, draw.randint(1, 90))
        elif kind == 1:
            text = sentence(draw, 10) + " " + passage + "\n" + sentence(draw, draw.randint(0, 20))
        elif kind == 2:
            words = other.split()
            for _ in range(draw.randint(0, 4)):
                words[draw.randrange(len(words))] = draw.choice(WORDS)
            text = " ".join(words)
        elif kind == 3:
            text = other
        elif kind == 4:
            text = draw.choice(["", " \n\t ", "w1", "w1 w2 w3 w4", "a b " * 60, "x" * 350])
        else:
            text = sentence(draw, 30) + passage.upper()
        rows.append((100 - i, text))
    return rows + [(7, None), (None, passage), (None, None), (5, other + " end")]
