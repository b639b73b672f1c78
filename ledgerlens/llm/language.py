"""Language identification by error-correcting output codes.

Each language has a codeword of several bits, far from all others. One linear classifier
per bit over hashed byte n-grams predicts that bit. A text gets the language whose codeword
has the smallest loss, each bit weighted by how reliable its classifier is; a small lead
over the runner-up marks the text as ambiguous.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common

#: Documents of each language that classifiers are fitted on, about, and of all at most.
SAMPLE_OF_LANGUAGE, SAMPLE_ROWS = 400, 20_000
GRAMS = 1 << 12
UNKNOWN = "und"
_LETTER = regex.compile(r"[A-Za-z]|\p{L}")
# ASCII letters in lower case, other bytes as they are, all else a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def grams(text: str) -> np.ndarray:
    """Frequencies of hashed one-, two- and three-byte grams, as a vector of length 1."""
    raw = text.encode("utf-8", "surrogatepass").translate(_LETTERS)
    raw = b" " + b" ".join(raw.split()) + b" "
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = two[:-1] * np.uint32(263) + b[2:]
    n = np.bincount((two * np.uint32(2654435761)) >> np.uint32(20), minlength=GRAMS)
    n = n + np.bincount((three * np.uint32(2246822519)) >> np.uint32(20), minlength=GRAMS)
    n[:256] += np.bincount(b, minlength=256)
    x = np.sqrt(n.astype(np.float64))
    return (x / max(np.sqrt((x * x).sum()), 1e-12)).astype(np.float32)


def code_matrix(classes: int) -> np.ndarray:
    """Rows of +1 and -1, one per class. Up to five classes: every way to split them;
    beyond: random words, the best of a fixed number of draws by their smallest distance."""
    if classes < 2:
        return np.ones((classes, 0))
    if classes <= 5:
        bits = np.arange(1, 2 ** (classes - 1))
        return np.array([[1.0 if c and (b >> (c - 1)) & 1 else -1.0 for b in bits] for c in range(classes)])
    length, draw = math.ceil(10 * math.log2(classes)), np.random.default_rng(11)
    best, far = None, -1.0
    for _ in range(50):
        m = draw.choice([-1.0, 1.0], (classes, length))
        distance = (length - m @ m.T) / 2
        np.fill_diagonal(distance, length)
        split = np.abs(m.sum(axis=0)).max() < classes
        if split and distance.min() > far:
            best, far = m, distance.min()
    return best if best is not None else draw.choice([-1.0, 1.0], (classes, length))


@dataclass(frozen=True)
class Coder:
    languages: tuple[str, ...]
    code: np.ndarray  # classes x bits
    weights: np.ndarray  # grams x bits
    bias: np.ndarray
    trust: np.ndarray  # of each bit

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, probability-like score and lead of each row."""
        margin = x @ self.weights + self.bias
        loss = np.log1p(np.exp(-np.clip(margin[:, None, :] * self.code[None], -30, 30))) @ self.trust
        order = np.argsort(loss, axis=1, kind="stable")
        odds = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        share = odds / odds.sum(axis=1, keepdims=True)
        first = np.take_along_axis(share, order[:, :1], 1)[:, 0]
        second = np.take_along_axis(share, order[:, 1:2], 1)[:, 0] if share.shape[1] > 1 else np.zeros(len(share))
        return order[:, 0], first, first - second


def fit(x: np.ndarray, y: np.ndarray, languages: tuple[str, ...], steps: int = 120) -> Coder:
    """Logistic classifiers for all bits at once; classes weigh the same."""
    code = code_matrix(len(languages))
    target = code[y].astype(np.float32)
    weight = (1.0 / np.bincount(y, minlength=len(languages)).clip(1))[y][:, None]
    weight = (weight / weight.sum()).astype(np.float32)
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    mw, mb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        margin = x @ (w + 0.9 * mw) + b + 0.9 * mb
        g = -weight * target / (1 + np.exp(np.clip(target * margin, -30, 30)))
        mw, mb = 0.9 * mw - 8.0 * (g.T @ x).T - 8e-5 * w, 0.9 * mb - 8.0 * g.sum(axis=0)
        w, b = w + mw, b + mb
    error = (weight * ((x @ w + b) * target <= 0)).sum(axis=0)
    trust = np.clip(np.log((1 - error + 1e-3) / (error + 1e-3)), 0.05, None)
    return Coder(languages, code, w, b, trust / max(trust.sum(), 1e-12) * len(trust))


def _grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [grams(t).astype("<f2").tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(made, pa.binary())], ["doc_id", "lang", "x"])


def learn(docs: DataFrame, per_language: int = SAMPLE_OF_LANGUAGE, rows: int = SAMPLE_ROWS) -> Coder:
    """Classifiers fitted on about ``per_language`` documents of each language and ``rows``
    in all, chosen by a hash. Null languages and texts without a letter are left out."""
    common.ship(docs.sparkSession)
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(rows).collect()}
    each = min(per_language, max(1, rows // max(len(counts), 1)))
    share = docs.sparkSession.createDataFrame([(k, min(1.0, each / n)) for k, n in counts.items()], "lang string, share double")
    # At most `rows` languages of one short row each, so the table may be broadcast.
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_003)) / 1_000_003
    sample = (
        known.join(F.broadcast(share), "lang")
        .filter(place < F.col("share"))
        .select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text")
        .mapInArrow(_grams_of, "doc_id string, lang string, x binary")
        .limit(2 * rows)
        .toArrow()
        .to_pandas()
        .sort_values(["lang", "doc_id"], kind="stable")
    )
    languages = tuple(sorted(sample["lang"].unique()))
    x = np.frombuffer(b"".join(sample["x"]), dtype="<f2").reshape(-1, GRAMS).astype(np.float32)
    number = {k: i for i, k in enumerate(languages)}
    return fit(x, sample["lang"].map(number).to_numpy(dtype=np.int64), languages)


def identify(docs: DataFrame, coder: Coder, lead: float = 0.2) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous.

    A null text or one without a letter is ``und`` with score 0, and so is every text if
    nothing could be learned. With one learned language every other text gets it. Columns
    of the three names are replaced; others, repeated rows and empty tables pass through.
    """
    common.ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(coder)  # of a fixed size

    def run(text: pd.Series) -> pd.DataFrame:
        c = shared.value
        out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "ambiguous": True}, index=text.index)
        held = np.flatnonzero([t is not None and bool(c.languages) and _LETTER.search(t) is not None for t in text])
        for part in np.array_split(held, max(1, -(-len(held) // 256))):
            if len(part):
                at, score, ahead = c.decode(np.stack([grams(text.iloc[i]) for i in part]))
                out.iloc[part, 0] = [c.languages[i] for i in at]
                out.iloc[part, 1] = score
                out.iloc[part, 2] = ahead < lead
        return out

    found = F.pandas_udf(run, "lang_pred string, score double, ambiguous boolean")(F.col("text"))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]
    return docs.select(*kept, found.alias("_found")).select(*kept, "_found.*")
