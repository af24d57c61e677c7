"""Secret scan: fixed patterns, and character Markov models for what has no fixed form.

Two second-order Markov models over the characters of identifiers are trained from
labelled samples, one on random strings, one on ordinary identifiers. A run of such
characters is a secret if the mean log-likelihood ratio per character is above a
threshold and its sum is high enough. The fixed patterns come first; what the models
add never overlaps them.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridtide.llm.common import id_and_bytes
from gridtide.session import materialize

KINDS = ("assign", "access", "hex", "markov")
THRESHOLD = 0.35
LEAST_SUM = 12.0
# Shorter runs cannot reach the least sum with any certainty: random strings of 10 characters mostly do.
MIN_LENGTH = 10
# Labelled strings of each class that the models are trained on at most.
MAX_SAMPLES = 20_000
SEED = 20_240_601

# The base patterns and the least lengths they need.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGNED, MIN_ACCESS = 8, 16

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
# Whole runs of letters or digits; pieces of random strings are not ordinary.
_ORDINARY = r"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z][A-Za-z_-]{3,60}|[0-9][0-9_-]{3,60})(?![A-Za-z0-9+/_=-])"
_CODE = np.full(256, -1, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the fixed patterns, leftmost and non-overlapping per kind."""
    spans = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    # A run of hexadecimal digits that is long enough is taken whole, as the plain pattern would.
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _codes(run: str) -> np.ndarray:
    return _CODE[np.frombuffer(run.encode("ascii"), np.uint8)]


def markov_table(samples: Iterable[str], smooth: float = 0.05) -> np.ndarray:
    """Log-probability of a character after two others; thinly seen pairs lean on single characters."""
    k = len(ALPHABET)
    triples, pairs = np.zeros((k, k, k)), np.full((k, k), smooth)
    for sample in samples:
        for part in re.findall(r"[A-Za-z0-9+/_=-]{3,}", sample):
            c = _codes(part)
            np.add.at(triples, (c[:-2], c[1:-1], c[2:]), 1)
            np.add.at(pairs, (c[:-1], c[1:]), 1)
    lower = pairs / pairs.sum(1, keepdims=True)
    return np.log((triples + 2.0 * lower[None, :, :]) / (triples.sum(2, keepdims=True) + 2.0))


def random_strings(n: int, seed: int = SEED) -> list[str]:
    """Random strings over the alphabets keys are written in."""
    rng = random.Random(seed)
    alphabets = (ALPHABET[:62], ALPHABET[:64], ALPHABET[:62] + "_-", "0123456789abcdef", "0123456789ABCDEF", ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62])
    return ["".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(20, 64))) for i in range(n)]


def decimal_numbers(n: int, seed: int = SEED + 1) -> list[str]:
    """Numbers in decimals, which are ordinary however many of them the texts hold."""
    rng = random.Random(seed)
    return ["".join(rng.choices("0123456789", k=rng.randint(4, 20))) for _ in range(n)]


def training_samples(docs: DataFrame, id_col: str, text_col: str, max_samples: int = MAX_SAMPLES) -> tuple[list[str], list[str]]:
    """(random strings, ordinary identifiers).

    Random strings are generated from a seed. Ordinary identifiers are distinct
    words of letters and numbers, also joined by signs, from all texts, an eighth by hash; of these
    a share by hash that holds ``max_samples`` in expectation, or all if there are
    fewer. They come in capitals as well, as names of constants do, and with an eighth as
    many seeded numbers, of which few texts hold few. The set is the same in every run.
    """
    words = F.regexp_extract_all(F.col(text_col), F.lit(_ORDINARY), F.lit(0))
    place = F.xxhash64("w", F.lit("place"))
    picked = docs.select(F.explode(words).alias("w")).filter(F.pmod(F.xxhash64("w"), F.lit(8)) == 0).distinct()
    picked = materialize(picked)
    cells = 1 << 20
    share = min(cells, -(-cells * max_samples // max(picked.count(), 1)))
    ordinary = picked.filter(F.pmod(place, F.lit(cells)) < share)
    found = sorted(r[0] for r in ordinary.collect())
    return random_strings(max_samples), found + [w.upper() for w in found] + decimal_numbers(max_samples // 8)


class SecretScanner:
    """All spans of a text, given the table of log-likelihood ratios."""

    def __init__(self, ratios: np.ndarray, threshold: float = THRESHOLD, least_sum: float = LEAST_SUM):
        self.ratios, self.threshold, self.least_sum = ratios, threshold, least_sum

    def is_random(self, run: str) -> bool:
        c = _codes(run)
        r = self.ratios[c[:-2], c[1:-1], c[2:]]
        total = float(r.sum())
        return total >= self.least_sum and total >= self.threshold * len(r)

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base spans, all spans)."""
        base = base_spans(text)
        added, at, reach = [], 0, 0
        for m in _RUN.finditer(text):
            s, e = m.start(), m.end()
            # Both go by start: what begins before the run's end overlaps it if it reaches beyond its start.
            while at < len(base) and base[at][1] < e:
                reach = max(reach, base[at][2])
                at += 1
            if reach <= s and self.is_random(m[0]):
                added.append(("markov", s, e))
        return base, sorted(base + added, key=lambda x: (x[1], KINDS.index(x[0]))) if added else base


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: tuple[list[str], list[str]] | None = None) -> np.ndarray:
    """Log-likelihood ratios (three characters of the alphabet) from labelled samples."""
    randoms, ordinary = samples or training_samples(docs, id_col, text_col)
    return (markov_table(randoms) - markov_table(ordinary)).astype(np.float32)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    samples: tuple[list[str], list[str]] | None = None, threshold: float = THRESHOLD, least_sum: float = LEAST_SUM,
) -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans, n_markov) per row.

    Spans are ``kind:start:end`` in code points, end exclusive, joined by commas in
    order of start and kind; ``base_sha256`` is the hash of those of the fixed
    patterns alone. A NULL or empty text has no spans, a very long one is scanned whole. Rows with NULL or repeated ids
    and repeated rows are scanned each for itself; other columns are ignored. An
    empty table gives an empty result.
    """
    ratios = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col, samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = SecretScanner(ratios.value, threshold, least_sum)
        for batch in batches:
            rows = []
            for raw in batch.column(1).to_pylist():
                base, spans = scanner.spans(raw.decode()) if raw else ((), ())
                text = ",".join("%s:%d:%d" % s for s in base)
                counts = [sum(s[0] == k for s in spans) for k in KINDS]
                rows.append((*counts[:3], hashlib.sha256(text.encode()).hexdigest(), ",".join("%s:%d:%d" % s for s in spans), counts[3]))
            columns = list(zip(*rows)) if rows else [()] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"
    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, schema).withColumnRenamed("id", id_col)
