"""Hard negatives, byte-level BPE and collocations on awkward rows, against brute force and the library."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.llm import byte_bpe, collocations, hard_negatives, queries
from tests.conftest import SF_DIR
from tests.llm.test_operators import DOCS, ODD, odd

# --- 11 --------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, score long, anchor string, v string"


def mined(rows, is_anchor, k=5, percent=80):
    items = {}
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        items[vec_id, label, tuple(int(np.floor(256 * c)) for c in x)] = None
    out = set()
    for a in items:
        if not is_anchor(a[0]):
            continue
        scored = {(-sum(p * q for p, q in zip(a[2], b[2])), b[0], a[1] == b[1]) for b in items if len(a[2]) == len(b[2])}
        positives = sorted((s, i) for s, i, same in scored if same and i != a[0])[:k]
        for s, i in positives:
            inside = sorted((t, j) for t, j, same in scored if not same and percent * -s <= 100 * -t <= 100 * -s)
            out |= {(a[0], i, r + 1, j, -s, -t) for r, (t, j) in enumerate(inside[:k])}
    return sorted(out)


@pytest.mark.parametrize("cells", [1 << 22, 300])
def test_hard_negatives(spark, cells):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        # few distinct values, so that scores tie; a common direction, so that windows are full
        rows.append((i, [1.0, 0.5, *(float(x) for x in rng.integers(-3, 4, 4) / 8)], int(rng.integers(0, 4))))
    rows += [(700, [0.0] * 6, 1), (701, [], 1), (702, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (703, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0], 1), (704, None, 1)]
    rows += [(705, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0], 1), (None, [1.0] * 6, 1), (800, [1.0] * 6, None), (900, [1.0, 2.0], 1), (901, [2.0, 1.0], 1)]
    rows += [(902, [2.0, 1.0], 2), rows[100], rows[100], rows[5], rows[5], (1000, [-1.0] * 6, 0), (0, [0.5] * 6, 2)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], VECTORS).repartition(7)
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, anchor_cells=cells).collect()
    want = mined(rows, lambda i: i % 100 == 0)
    assert sorted(map(tuple, got)) == want and len(want) > 100


def test_hard_negatives_without_rows_and_with_large_numbers(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS), F.col("vec_id") % 100 == 0).count() == 0
    rows = [(i, [float(2**20 + i), -float(2**19 - 3 * i), 0.1], i % 2) for i in range(20)]
    got = hard_negatives.mine(spark.createDataFrame([(*r, 1, "x", "y") for r in rows], VECTORS), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == mined(rows, lambda i: i % 10 == 0)


# --- 12 --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(byte_bpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), *(hashlib.sha256(b).hexdigest() for b in (" ".join(map(str, ids)).encode(), library.decode_bytes(ids)))


def test_byte_bpe_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_byte_bpe(spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == sorted((i, *digests(library, t)) for i, t in docs)


def test_byte_bpe_of_odd_rows(spark, library):
    long_words = ["".join(random.Random(7).choices("abcdefgh", k=200_000)), "a" * 100_001, "中" * 50_000, " " * 70_000 + "x"]
    rows = [(i, t, "decoded", 3) for i, t in enumerate([*ODD, *long_words])] + [(None, "a b", None, None), (4, "x", None, None), (4, "x", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    encoded = byte_bpe.encode_documents(df)
    got = byte_bpe.decode_ids(encoded).collect()
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in got), key=repr) == sorted(
        ((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows), key=repr
    )
    assert byte_bpe.decode_ids(byte_bpe.encode_documents(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.decode_ids(encoded, out_col="n_tokens")


def test_byte_bpe_of_random_text(library):
    rng, bpe = random.Random(1), byte_bpe.encoder(byte_bpe.VOCABULARY, None, None)
    alphabet = "abcdeé 　\xa0\x1c\x85 \t\n'stremdv0123٣½漢!?.  \U0001f600 "
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(2000)]
    assert [np.frombuffer(x, "<i4").tolist() for x in bpe.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_merges_follow_any_ranks():
    """Vocabularies in which a merge opens a pair of lower rank, against the plain rule."""
    def plain(piece, ranks):
        parts = [bytes([b]) for b in piece]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(5)
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        tokens = list({bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(40)})
        rng.shuffle(tokens)
        ranks |= {t: 256 + i for i, t in enumerate(tokens)}
        bpe = byte_bpe.BytePairs(ranks, r"\S+|\s+")
        pieces = [bytes(rng.choices(b"abcd", k=rng.randint(1, 40))) for _ in range(30)]
        assert [np.frombuffer(x, "<i4").tolist() for x in bpe.merge(pieces)] == [plain(p, ranks) for p in pieces]


def test_what_is_forgotten_is_learnt_again(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 4000)
    bpe = byte_bpe.Encoder(byte_bpe.encoder(byte_bpe.VOCABULARY, None, None).vocabulary)
    texts = [f"the w{i % 40} x{i} of" for i in range(400)]
    for i in range(0, 400, 9):
        assert [np.frombuffer(x, "<i4").tolist() for x in bpe.encode(texts[i:i + 9])] == [library.encode_ordinary(t) for t in texts[i:i + 9]]


# --- 13 --------------------------------------------------------------------------

def phrases(rows, least, longest=5, top=2000, percent=100):
    totals, counts = collections.Counter(), collections.defaultdict(collections.Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = collections.Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    covered[p[i:i + k]] = max(covered[p[i:i + k]], a)
        kept = []
        for p, a in found.items():
            if 100 * covered[p] >= percent * a:
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, r, p.decode(), -a, l, q, totals[lang], -s) for r, (s, a, p, l, q) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def mined_phrases(df, **options):
    return sorted(tuple(r) for r in collocations.mine_phrases(df, **options).collect())


def test_phrases_of_repeated_passages(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ß", "İ"]
    passage = [f"p{i}" for i in range(700)]  # a chain over more than one segment
    rows = []
    for i in range(60):
        words = rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(len(vocabulary))], k=120)
        words[40:40] = passage[: 700 - 5 * (i % 3)] if i % 2 else ["x"] * rng.randint(1, 9)
        text = "".join(w + rng.choice([" "] * 9 + [", ", "\t", " . ", "\n"]) for w in words)
        rows.append((text.upper() if i % 7 == 0 else text, rng.choice(["en", "de", None, "und"])))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string").repartition(5)
    for options in ({"least": 3}, {"least": 8, "top": 7}, {"least": 5, "percent": 60}, {"least": 4, "max_bits": 1 << 10}):
        got = mined_phrases(df, **options)
        options.pop("max_bits", None)
        assert got == phrases(rows, **options) and len(got) > 20


def test_phrases_of_odd_rows(spark):
    df = odd(spark)
    rows = [(r.text, r.lang) for r in df.select("text", "lang").collect()]
    assert mined_phrases(df, least=2) == phrases(rows, 2)
    assert mined_phrases(spark.createDataFrame([], DOCS)) == []
    assert mined_phrases(df.filter("text IS NULL")) == []


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits, and ids with leading zeros in a gram."""
    counts = spark.createDataFrame([("en", bytes([1, *[0] * 7, *[0] * 7, 1]), 3 * 10**9)], "lang string, gram binary, n long")
    frequent = spark.createDataFrame([("en", "a", 1, 10**10), ("en", "b", 1 << 56, 7 * 10**9)], "lang string, word string, id long, n long")
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    row = collocations._scored(counts, frequent, totals).first()
    assert row.score == 1000 * 3 * 10**9 * 10**14 // (10**10 * 7 * 10**9) and (row.l, row.r) == (10**10, 7 * 10**9)


def test_words_that_share_a_hash_hash_again(spark, monkeypatch):
    plain = collocations._id_of
    monkeypatch.setattr(collocations, "_id_of", lambda w, salt: plain(w, salt) if salt else F.lit(5).cast("long"))
    _, salt = collocations._with_ids(spark.createDataFrame([("en", "a", 1), ("en", "b", 1)], "lang string, word string, n long"))
    assert salt == "#1"


def test_python_and_spark_hash_alike(spark):
    import xxhash

    for word in ("a", "é" * 40, "x" * 100):
        assert spark.range(1).select(F.xxhash64(F.lit(word))).first()[0] % 2**64 == xxhash.xxh64_intdigest(word.encode(), 42)


# --- components ------------------------------------------------------------------

def test_components_with_edges_added_later(spark):
    from gridtide.llm.components import connected_components, merged_components

    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]

    def frame(some):
        return spark.createDataFrame(some, "a long, b long")

    parts = connected_components(frame(edges[:60]))
    for a, b in ((60, 61), (61, 120), (120, 170)):
        parts = merged_components(parts, frame(edges[a:b]))
        assert sorted(map(tuple, parts.select("node", "component").collect())) == sorted(
            map(tuple, connected_components(frame(edges[:b])).select("node", "component").collect())
        )
    assert sorted(map(tuple, merged_components(parts, frame([])).select("node", "component").collect())) == sorted(
        map(tuple, parts.select("node", "component").collect())
    )
