"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, every run of other characters than letters becomes a blank,
and all n-grams of one to three characters are hashed into ``DIMENSIONS`` features.
Document frequencies come from all learning texts. The weights are fitted with
follow-the-regularised-leader (per-coordinate rates, elastic net), which leaves
most of them at zero, on a bounded sample per language; a temperature fitted on a
part of the sample kept aside calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridtide.llm.common import id_and_bytes, ship_package

DIMENSIONS = 1 << 16
# Learning texts per language, in expectation; fewer if there are no more.
SAMPLE_PER_LANGUAGE = 1000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
SCALE = 10.0
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def ngrams(text: str | None) -> np.ndarray:
    """Features of all n-grams of a text, one entry per occurrence; empty if it has no letter."""
    if not text:
        return np.empty(0, np.uint32)
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letter_table()[c]
    if not letter.any():
        return np.empty(0, np.uint32)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # the first other character after a letter stands for the whole run
    c = np.where(letter, c, np.uint32(32))[keep]
    a, b, d = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
    one = c * a
    two = one[:-1] + c[1:] * b + np.uint32(0x27D4EB2F)
    three = two[:-1] + c[2:] * d + np.uint32(0x165667B1)
    h = np.concatenate((one, two, three))
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    return h & np.uint32(DIMENSIONS - 1)


@dataclass
class LanguageModel:
    """Weights times inverse document frequency, (features, languages), bias, temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        f = ngrams(text)
        if not len(f) or not self.languages:
            return UNKNOWN, 0.0
        logits = (self.weights[f].sum(0, dtype=np.float64) * (SCALE / len(f)) + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        k = int(p.argmax())
        return self.languages[k], float(p[k] / p.sum())


def _vector(f: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, n = np.unique(f, return_counts=True)
    return i, n * idf[i] * (SCALE / len(f))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by ternary search on its logarithm."""
    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).mean())

    lo, hi = -3.0, 3.0
    for _ in range(60):
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of a softmax model by follow-the-regularised-leader with elastic net."""
    z, n = np.zeros((DIMENSIONS + 1, k)), np.zeros((DIMENSIONS + 1, k))

    def weights(i: np.ndarray | slice) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for r in order.permutation(len(rows)):
            i, x = np.append(rows[r][0], DIMENSIONS), np.append(rows[r][1], 1.0)
            w = weights(i)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[r]] -= 1.0
            g = x[:, None] * p[None, :]
            g2 = g * g
            z[i] += g - (np.sqrt(n[i] + g2) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g2
    w = weights(slice(None))
    return w[:-1], w[-1]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Number of texts (first column, bytes) with each feature, and of texts with any, over all rows."""
    ship_package(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, n = np.zeros(DIMENSIONS, np.int64), np.zeros(DIMENSIONS, bool), 0
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                f = ngrams(raw.decode()) if raw else ()
                if len(f):
                    seen[f] = True
                    total += seen
                    seen[f] = False
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, DIMENSIONS), pa.int32()), pa.array(np.append(total[at], n), pa.int64())], names=["feature", "n"]
        )

    out = np.zeros(DIMENSIONS + 1, np.int64)
    for i, n in texts.mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n")).collect():
        out[i] = n
    return out[:-1], int(out[-1])


def fit(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """Model from the rows where ``learn`` holds and the language is not NULL.

    Inverse document frequencies cover all of them. The weights are fitted on a
    hash sample of ``per_language`` rows per language in expectation.
    """
    rows = docs.filter(learn & F.col(lang_col).isNotNull())
    df, n = document_frequencies(rows.select(F.col(text_col).cast("binary").alias("text")))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    languages = sorted(counts)
    if not languages or not n:
        return LanguageModel([], np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0), 1.0)
    idf = np.log((1 + n) / (1 + df)) + 1.0
    cells = 1 << 20
    keep = F.create_map(*[F.lit(x) for k in languages for x in (k, min(cells, -(-cells * per_language // counts[k])))])
    place = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(cells))
    sample = rows.filter(place < keep[F.col(lang_col)]).select(
        F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("text"), F.xxhash64(F.col(text_col)).alias("order")
    )

    # Vectors, not texts, reach the driver: at most DIMENSIONS entries a row.
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_vector(f, np.ones(DIMENSIONS)) if len(f := ngrams(r.decode() if r else None)) else None for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2),
                    pa.array([None if v is None else v[0].astype(np.int32) for v in out], pa.list_(pa.int32())),
                    pa.array([None if v is None else v[1].astype(np.float32) for v in out], pa.list_(pa.float32())),
                ],
                names=["lang", "order", "i", "x"],
            )

    got = sample.mapInArrow(vectors, "lang string, order long, i array<int>, x array<float>").filter("i is not null").toArrow()
    index = {k: j for j, k in enumerate(languages)}
    data = sorted(
        ((o, index[g], np.array(i), np.array(x) * idf[i]) for g, o, i, x in zip(
            got["lang"].to_pylist(), got["order"].to_pylist(), got["i"].to_numpy(), got["x"].to_numpy())),
        key=lambda r: (r[0], r[1]),
    )
    rows_, y = [(r[2], r[3]) for r in data], np.array([r[1] for r in data])
    aside = np.arange(len(y)) % 5 == 0 if len(y) >= 20 else np.zeros(len(y), bool)
    w, b = ftrl([r for r, a in zip(rows_, aside) if not a], y[~aside], len(languages))
    temperature = 1.0
    if aside.any():
        temperature = _temperature(np.array([x @ w[i] + b for (i, x), a in zip(rows_, aside) if a]), y[aside])
    return LanguageModel(languages, (w * idf[:, None]).astype(np.float32), b, temperature)


def identify(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", *more: Column
) -> DataFrame:
    """(id_col, *more, lang_pred, score) per row, from the text alone.

    ``score`` is the calibrated probability. NULL texts and texts without a letter
    give ``und`` and 0, as all texts do if nothing could be learned. Rows with NULL
    or repeated ids and repeated rows are predicted each for itself. An empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(r.decode() if r else None) for r in batch.column(1).to_pylist()]
            kept = [i for i in range(batch.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*(batch.schema.names[i] for i in kept), "lang_pred", "score"],
            )

    read = id_and_bytes(docs, id_col, text_col, *more)
    kept = ", ".join(f"`{n}` {t}" for n, t in read.dtypes if n != "text")
    return read.mapInArrow(run, f"{kept}, lang_pred string, score double").withColumnRenamed("id", id_col)
