"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is labelled good or bad from features of the line and of the lines before
and after it; a tied potential favours neighbours with the same label. Forward and
backward messages give each line's marginal probability of being good; their mean,
weighted by length, is the quality of the text, which a logistic curve turns
into the score. Lines have no labels of their own: at first they carry their
document's, then lines of bad documents that look good to the first model are
called good and the model is fitted again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridtide.llm.common import id_and_bytes, ship_package

# Labelled documents the model is fitted on, per label and in expectation, and the most lines of each.
SAMPLE_PER_LABEL = 1500
MAX_TRAINING_LINES = 400
CUT = 0.3
# What texts scored at once may take together: padded lines (three doubles each), bytes, texts.
BLOCK_CELLS, BLOCK_BYTES, BLOCK_TEXTS = 2_000_000, 4_000_000, 1000

_CLASSES = 10
_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate((
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b".,;:", b"!?", b"|", b"#*$%&<>", b"'\"()[]{}",
)):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _k
_CLASS[128:] = 9
OWN = _CLASSES + 7
FEATURES = 3 * OWN + 3


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(features of the lines with a character, their lengths in bytes)."""
    b = np.frombuffer(text, np.uint8)
    ends = np.append(np.flatnonzero(b == 10), len(b))
    starts = np.append(0, ends[:-1] + 1)
    filled = ends > starts
    starts, ends = starts[filled], ends[filled]
    n = len(starts)
    if not n:
        return np.empty((0, OWN), np.float32), np.empty(0, np.int64)
    length = ends - starts
    kind = _CLASS[b]
    # Counts by class between starts, from running sums at both ends of a line.
    own = np.empty((n, OWN), np.float32)
    for k in range(_CLASSES):
        total = np.concatenate(([0], np.cumsum(kind == k)))
        own[:, k] = (total[ends] - total[starts]) / length
    space = kind == 3
    begins = np.concatenate(([0], np.cumsum(~space & np.concatenate(([True], space[:-1] | (b[:-1] == 10))))))
    words = np.maximum(begins[ends] - begins[starts], 1)
    lines = [text[s:e] for s, e in zip(starts, ends)]
    seen: set[bytes] = set()
    for i, line in enumerate(lines):
        own[i, _CLASSES + 4] = line in seen
        seen.add(line)
        parts = line.split()
        own[i, _CLASSES + 5] = len(set(parts)) / max(len(parts), 1)
    own[:, _CLASSES] = np.log1p(length)
    own[:, _CLASSES + 1] = np.log1p(words)
    own[:, _CLASSES + 2] = length / words / 10
    own[:, _CLASSES + 3] = kind[ends - 1] == 4
    own[:, _CLASSES + 6] = kind[starts] == 1
    return own, length


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before, of the line after, first, last, one."""
    n = len(own)
    out = np.zeros((n, FEATURES), np.float32)
    out[:, :OWN] = own
    out[1:, OWN:2 * OWN] = own[:-1]
    out[:-1, 2 * OWN:3 * OWN] = own[1:]
    out[0, 3 * OWN] = out[-1, 3 * OWN + 1] = out[:, 3 * OWN + 2] = 1
    return out


def _pass(m: np.ndarray, stay: float) -> np.ndarray:
    """Log-odds handed to the neighbour of a line that has log-odds ``m``."""
    return np.logaddexp(m + stay, 0) - np.logaddexp(m, stay)


def messages(scores: list[np.ndarray], stay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward, backward, positions): padded (document, line) log-odds, forward with the line's own score.

    All documents move one line a step; longer ones come first, so a step only
    touches those that still have a line.
    """
    lengths = np.array([len(s) for s in scores])
    order = np.argsort(-lengths, kind="stable")
    n = lengths[order]
    most = int(n[0]) if len(n) else 0
    e = np.zeros((most, len(n)))
    for j, i in enumerate(order):
        e[:n[j], j] = scores[i]
    alive = np.searchsorted(-n, -np.arange(1, most + 1), "right")
    forward, backward = e.copy(), np.zeros_like(e)
    for t in range(1, most):
        k = alive[t]
        forward[t, :k] += _pass(forward[t - 1, :k], stay)
    for t in range(most - 2, -1, -1):
        k = alive[t + 1]
        backward[t, :k] = _pass(e[t + 1, :k] + backward[t + 1, :k], stay)
    back = np.empty(len(n), np.int64)
    back[order] = np.arange(len(n))
    return forward, backward, back


def marginals(scores: list[np.ndarray], stay: float) -> list[np.ndarray]:
    """Log-odds of being good of every line."""
    forward, backward, at = messages(scores, stay)
    return [(forward[:len(s), at[i]] + backward[:len(s), at[i]]) for i, s in enumerate(scores)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _stay_expectation(scores: list[np.ndarray], stay: float) -> tuple[list[np.ndarray], float, int]:
    """(marginal probabilities, expected number of neighbours with one label, pairs)."""
    forward, backward, at = messages(scores, stay)
    out, same, pairs = [], 0.0, 0
    for i, s in enumerate(scores):
        f, b = forward[:len(s), at[i]], backward[:len(s), at[i]]
        out.append(_sigmoid(f + b))
        if len(s) > 1:
            a, v = f[:-1], s[1:] + b[1:]
            keep = np.logaddexp(a + v, 0) + stay
            change = np.logaddexp(a, v)
            same += float(_sigmoid(keep - change).sum())
            pairs += len(s) - 1
    return out, same, pairs


@dataclass
class LineCrf:
    """Weights of the standardised features, the tie between neighbours, the logistic curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    stay: float
    slope: float = 1.0
    shift: float = 0.0

    def line_scores(self, own: np.ndarray) -> np.ndarray:
        return ((with_neighbours(own) - self.mean) / self.scale) @ self.weights

    def qualities(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Log-odds of the length-weighted mean marginal; 0 lines give the weight of nothing, 0."""
        out = np.zeros(len(documents))
        filled = [i for i, (own, _) in enumerate(documents) if len(own)]
        found = marginals([self.line_scores(documents[i][0]) for i in filled], self.stay)
        for i, m in zip(filled, found):
            length = documents[i][1]
            good = float((_sigmoid(m) * length).sum() / length.sum())
            # The mean log-odds part keeps apart texts whose marginals are all but 0 or 1.
            tail = float((np.clip(m, -30, 30) * length).sum() / length.sum())
            good = min(max(good, 1e-6), 1 - 1e-6)
            out[i] = np.log(good / (1 - good)) + 0.05 * tail
        return out

    def scores(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        filled = np.array([len(own) > 0 for own, _ in documents], bool)
        return np.where(filled, _sigmoid(self.slope * self.qualities(documents) + self.shift), 0.0)


def _fit_chain(x: list[np.ndarray], y: list[np.ndarray], steps: int, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """(weights, stay) of the largest penalised likelihood, by Adam on all documents."""
    theta = np.zeros(FEATURES + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    stacked, target = np.concatenate(x), np.concatenate(y)
    cuts = np.cumsum([len(a) for a in x])[:-1]
    same = sum(float((a[1:] == a[:-1]).sum()) for a in y)
    for t in range(1, steps + 1):
        scores = np.split(stacked @ theta[:-1], cuts)
        p, expected, pairs = _stay_expectation(scores, theta[-1])
        g = np.append((target - np.concatenate(p)) @ stacked / len(target), (same - expected) / max(pairs, 1)) - l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        theta[-1] = np.clip(theta[-1], 0.0, 3.0)
    return theta[:-1], float(theta[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the logistic curve of y over x, by damped Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * x + b)
        w = p * (1 - p) + 1e-6
        g = np.array([((y - p) * x).mean() - 1e-3 * a, (y - p).mean()])
        h = np.array([[(w * x * x).mean() + 1e-3, (w * x).mean()], [(w * x).mean(), w.mean() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
    return max(float(a), 1e-3), float(b)


def fit_lines(documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 120) -> LineCrf:
    """Model from the lines of labelled documents (1 good, 0 bad)."""
    used = [i for i, (own, _) in enumerate(documents) if len(own)]
    if not used or len(set(labels[used])) < 2:
        share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
        return LineCrf(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, 0.0, float(np.log(share / (1 - share))))
    docs, y = [documents[i] for i in used], labels[used].astype(float)
    raw = [with_neighbours(own) for own, _ in docs]
    stacked = np.concatenate(raw)
    mean, scale = stacked.mean(0), stacked.std(0) + 1e-3
    mean[-1], scale[-1] = 0.0, 1.0
    x = [(r - mean) / scale for r in raw]
    line_labels = [np.full(len(r), v) for r, v in zip(x, y)]
    weights, stay = _fit_chain(x, line_labels, steps)
    alone = [r @ weights for r in x]
    line_labels = [np.where(s > 0, 1.0, v) if v == 0 and (s <= 0).any() else np.full(len(s), v) for s, v in zip(alone, y)]
    weights, stay = _fit_chain(x, line_labels, steps)
    model = LineCrf(mean, scale, weights, stay)
    model.slope, model.shift = _logistic(model.qualities(docs), y)
    return model


def _own_features(rows: DataFrame) -> DataFrame:
    """(label, order, own features row by row, lengths) of (label, text, order)."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_features(r or b"") for r in batch.column(1).to_pylist()]
            kept = [len(f[1]) <= MAX_TRAINING_LINES for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2),
                    pa.array([f[0].ravel() if k else None for f, k in zip(found, kept)], pa.list_(pa.float32())),
                    pa.array([f[1] if k else None for f, k in zip(found, kept)], pa.list_(pa.int64())),
                ],
                names=["label", "order", "own", "lengths"],
            )

    return rows.mapInArrow(run, "label int, order long, own array<float>, lengths array<long>").filter("own is not null")


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", per_label: int = SAMPLE_PER_LABEL,
) -> LineCrf:
    """Model from labelled documents where ``learn`` holds; NULL labels are ignored.

    A hash sample of ``per_label`` labelled ids per label, in expectation, is joined
    to the texts; documents of more than ``MAX_TRAINING_LINES`` lines are not learned from.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().distinct()
    known = known.filter(learn(F.col("id")) if callable(learn) else learn)
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    cells = 1 << 20
    keep = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(cells, -(-cells * per_label // n)))]) if counts else None
    picked = known.filter(F.pmod(F.xxhash64("id"), F.lit(cells)) < keep[F.col("label")]) if counts else known
    # Its size is bounded by the sample.
    rows = id_and_bytes(docs, id_col, text_col).join(F.broadcast(picked), "id").select(
        "label", "text", F.xxhash64("id", "text").alias("order")
    )
    table = _own_features(rows).toArrow()
    got = sorted(
        zip(table["order"].to_pylist(), table["label"].to_pylist(), table["own"].to_numpy(), table["lengths"].to_numpy()),
        key=lambda r: (r[0], r[1]),
    )
    documents = [(np.asarray(own, np.float32).reshape(-1, OWN), np.asarray(lengths, np.int64)) for _, _, own, lengths in got]
    return fit_lines(documents, np.array([label for _, label, _, _ in got], np.int64))


def blocks(lines: list[int], sizes: list[int]) -> Iterator[list[int]]:
    """Indices of texts in blocks of like numbers of lines, so that padding stays small and memory bounded.

    A block is closed before a text that would take it over ``BLOCK_CELLS`` padded lines, ``BLOCK_BYTES`` or
    ``BLOCK_TEXTS``; a text that is over a bound by itself stands alone.
    """
    block: list[int] = []
    size = 0
    for i in sorted(range(len(lines)), key=lambda i: (lines[i], sizes[i])):
        # Lines rise along the order, so this text is the longest of the block.
        over = lines[i] * (len(block) + 1) > BLOCK_CELLS or size + sizes[i] > BLOCK_BYTES or len(block) >= BLOCK_TEXTS
        if block and over:
            yield block
            block, size = [], 0
        block.append(i)
        size += sizes[i]
    if block:
        yield block


def score(docs: DataFrame, model: LineCrf, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """(id_col, *more, score, predicted) per row, from the text alone.

    ``score`` is higher the likelier the text is good, ``predicted`` is 1 from
    ``CUT`` on. NULL texts and texts without a character have 0. Rows with NULL or
    repeated ids and repeated rows are scored each for itself. Very long texts are scored whole, in
    memory in proportion to the text. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = np.zeros(len(texts))
            for block in blocks([(t or b"").count(b"\n") + 1 for t in texts], [len(t or b"") for t in texts]):
                found[block] = shared.value.scores([line_features(texts[i] or b"") for i in block])
            kept = [i for i in range(batch.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(found, pa.float64()), pa.array((found >= CUT).astype(np.int32), pa.int32())],
                names=[*(batch.schema.names[i] for i in kept), "score", "predicted"],
            )

    read = id_and_bytes(docs, id_col, text_col, *more)
    kept = ", ".join(f"`{n}` {t}" for n, t in read.dtypes if n != "text")
    return read.mapInArrow(run, f"{kept}, score double, predicted int").withColumnRenamed("id", id_col)
