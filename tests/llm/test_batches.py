"""Sets and signatures by batches; small remainders in one partition."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from gridtide.llm import line_dedup, minhash
from gridtide.llm.components import connected_components
from gridtide.session import compacted

ODD = [
    None, b"", b" \n", b"a", b"A b", b"a b c d", b"A B C D E f g", b"a a a a a a a a", b" a\tb\x0bc\x0cd\re\nf ", "é Ü x y z ß".encode(),
    b"x" * 70000 + b" y " + b"Z" * 66000 + b" a b c", b"ab cd " * 20000, b"w" * 65536 + b" v", b"w" * 65535 + b" v", b" " * 70000 + b"q", b"\x1c a\x85b c d e f",
]


def _plain_set(text: bytes | None, n: int) -> set[bytes]:
    words = (text or b"").lower().split()
    if len(words) < n:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def test_sets_of_a_batch():
    pick = random.Random(3)
    texts = ODD + [" ".join(pick.choice("abABc") for _ in range(pick.randint(0, 9))).encode() for _ in range(200)]
    for n in (3, 5):
        hashes, begins = minhash.Shingler(n).sets(texts)
        found = [hashes[i:j] for i, j in zip(begins[:-1], begins[1:])]
        wanted = [_plain_set(t, n) for t in texts]
        assert [len(s) for s in found] == [len(s) for s in wanted]
        assert all((s[1:] > s[:-1]).all() for s in found)
        for _ in range(2000):
            a, b = pick.randrange(len(texts)), pick.randrange(len(texts))
            assert len(np.intersect1d(found[a], found[b])) == len(wanted[a] & wanted[b])


def test_signatures_of_a_batch_follow_the_walk(monkeypatch):
    signer = minhash.Signer(6, 4)
    pick = np.random.default_rng(1)
    sets = [np.unique(pick.integers(0, 1 << 64, k, np.uint64)) for k in (1, 2, 5, 40, 300)]
    found = signer.signatures(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    for hashes, row in zip(sets, found):
        least: dict[int, int] = {}
        for h in hashes.tolist():
            least.setdefault(h * signer.bins >> 64, h)
        for i in range(signer.bins):
            at, step = i, 0
            while at not in least:
                at, step = int(signer._step(np.array([i]), step)[0]), step + 1
            assert row[i] == least[at]
    # Few filled bins are looked up, which must come to the same.
    monkeypatch.setattr(minhash, "FEW_BINS", 0)
    assert (signer.signatures(np.concatenate(sets), np.cumsum([0, *map(len, sets)])) == found).all()


def test_few_rows_are_worked_on_in_one_partition(spark):
    few, rows = compacted(spark.range(0, 100, 1, 8).withColumnRenamed("id", "a"))
    assert rows == 100 and few.rdd.getNumPartitions() == 1
    assert "Exchange" not in few.groupBy("a").count()._jdf.queryExecution().executedPlan().toString()
    many, rows = compacted(spark.range(0, 100, 1, 8), most=99)
    assert rows == 100 and "Coalesce" not in many._jdf.queryExecution().executedPlan().toString()
    wide, _ = compacted(spark.range(0, 100, 1, 8), most=100, size=F.col("id") * 1000)
    assert "Coalesce" not in wide._jdf.queryExecution().executedPlan().toString()
    empty, rows = compacted(spark.range(0))
    assert rows == 0 and empty.collect() == []


def test_components_of_few_and_of_many_edges(spark, monkeypatch):
    pairs = [(i, i + 3) for i in range(60)] + [(100, 101), (101, 101), (None, 5), (200, 199)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    few = connected_components(edges)
    assert few.rdd.getNumPartitions() == 1
    wanted = {i: i % 3 for i in range(63)} | {100: 100, 101: 100, 199: 199, 200: 199}
    assert {r.node: r.component for r in few.collect()} == wanted
    monkeypatch.setattr("gridtide.llm.components.FEW_ROWS", 0)
    assert {r.node: r.component for r in connected_components(edges).collect()} == wanted


def test_band_hashes_are_shuffled_once_and_narrow(spark):
    bands = {b"a" * 16: [1, 2, 3], b"b" * 16: [9, 2, 8], b"c" * 16: [7, 6, 3], b"d" * 16: [4, 5, 0], b"e" * 16: [4, 2, 11]}
    rows = [(k, i, 10, v) for i, (k, v) in enumerate(bands.items())]
    classes = spark.createDataFrame(rows, "set_key binary, rep long, n long, bands array<long>")
    got = {(r.key, bytes(r.set_key), r.rep, r.members) for r in minhash._buckets(classes, 3).collect()}
    often = {key: sum(key in v for v in bands.values()) for v in bands.values() for key in v}
    assert got == {(key, k, i, often[key]) for i, (k, v) in enumerate(bands.items()) for key in v if often[key] > 1}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = minhash._shared(classes)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("ReusedExchange") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_only_sets_of_candidates_are_moved_and_met_once(spark, monkeypatch):
    sets = spark.createDataFrame([(bytes([i]) * 16, list(range(i, i + 50))) for i in range(20)], "set_key binary, hashes array<long>")
    pairs = [(bytes([i]) * 16, bytes([j]) * 16, i, j, 50, 50) for i, j in ((1, 2), (1, 6), (1, 7), (8, 3), (8, 9))]
    edges = spark.createDataFrame(pairs, "a binary, b binary, rep_a long, rep_b long, n_a long, n_b long")
    few = minhash._of_edges(sets, edges, 5)
    assert sorted(r.set_key[0] for r in few.collect()) == [1, 2, 3, 6, 7, 8, 9]
    monkeypatch.setattr(minhash, "SMALL_EDGES", 4)
    assert minhash._of_edges(sets, edges, 5).count() == 20
    # 45 of 55 are more than 80 %, 44 of 56 are less.
    found = minhash._confirmed(edges, few, 80)
    assert {(r.rep_a, r.rep_b) for r in found.collect()} == {(1, 2), (1, 6), (8, 3), (8, 9)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("array_intersect") == 1


def test_lines_are_trimmed_of_all_blanks(spark):
    lines = ["", " ", "a", " a", "a\t", "\x0b a b \x0c\r", "\r", "a b", "\t\ta  ", " a", " \x0b\x0c", "é \r"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r.line: r.core for r in df.select("line", line_dedup._core(F.col("line")).alias("core")).collect()}
    assert got == {x: x.strip(" \t\x0b\x0c\r") for x in lines}


def test_a_block_without_a_set_has_no_signature():
    assert minhash.Signer(6, 4).band_hashes(np.empty(0, np.uint64), np.array([0])).shape == (0, 6)
