"""The corpus pipeline, stage by stage against brute force, and the registration without the subpackage."""

from __future__ import annotations

import collections
import os
import subprocess
import sys
import zlib

import corpus_pipeline as pipeline
import numpy as np
from pyspark.sql import functions as F

from gridtide.llm import queries, quality_rules
from gridtide.session import ensure_checkpoint_dir, materialize
from tests.conftest import ROOT, SF_DIR
from tests.llm.test_operators import WORD, by_brute_force, statistics


def test_stages(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    columns, before = docs.columns, docs
    for name, stage in pipeline.STAGES:
        after = materialize(stage(spark, before, SF_DIR))
        if name == "quality_rules":
            assert after.exceptAll(before).count() == 0
            kept = {r.doc_id for r in after.collect()}
            for r in before.collect():
                assert r.doc_id not in kept or not statistics(r.text)[-1]
            marked = before.join(queries.table(spark, SF_DIR, "labels"), "doc_id").filter("quality = 1")
            assert all(r.doc_id in kept or statistics(r.text)[-1] for r in marked.collect())
        elif name == "line_dedup":
            assert after.count() == before.count() and after.filter(F.length("text") != F.col("n_chars")).count() == 0
        elif name == "near_copies":
            want = by_brute_force([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, c in want.items() if i == c)
        elif name == "mixing":
            copies = collections.Counter(r.doc_id for r in after.collect())
            assert max(copies.values()) <= 3 and after.distinct().exceptAll(before.distinct()).count() == 0
            total = [sum(len(WORD.findall(r.text or "")) for r in x.collect()) for x in (before, after)]
            assert abs(total[1] - total[0]) < 0.2 * total[0]
        if name == "packing":
            assert after.select("doc_id", "piece").distinct().count() <= after.count()
            assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0
        else:
            assert after.columns == columns
        before = after


def test_repeated_ids_are_one_document(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (None, "a b c d e f g")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pipeline.near_copies(spark, df, SF_DIR)
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 0, 1]


def test_different_texts_under_one_id_all_stay(spark):
    one, two, three = (" ".join(f"{k}{i}" for i in range(9)) for k in "abc")
    rows = [(1, one, "y"), (1, one, "x"), (1, two, "x"), (2, one, "x"), (2, three, "x"), (2, None, "x"), (3, two, "x"), (None, one, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = [tuple(r) for r in pipeline.near_copies(spark, df, SF_DIR).collect()]
    assert sorted(got, key=repr) == sorted([(1, one, "x"), (1, two, "x"), (2, three, "x"), (2, None, "x"), (None, one, "x")], key=repr)


def test_a_group_of_near_copies_is_one_page_to_line_dedup(spark):
    """A third of a source are near copies: their lines stay and one of them is left whole."""
    copy = [" ".join(f"c{i}w{j}" for j in range(12)) for i in range(10)]
    rows = [(i, "\n".join([*copy[:5], f"{copy[5]} edit{i}", *copy[6:], "menu of the site"]), "a", 0) for i in range(30)]
    rows += [(100 + i, "\n".join([" ".join(f"p{i}w{j}" for j in range(40)), "menu of the site"]), "a", 0) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    cleaned = materialize(pipeline.lines(spark, df, SF_DIR))
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    for i, text, _, _ in rows:
        assert texts[i] == text.removesuffix("\nmenu of the site")
    left = {r.doc_id for r in pipeline.near_copies(spark, cleaned, SF_DIR).collect()}
    assert left == {0, *range(100, 160)}


def test_near_copies_leave_their_result_alone_in_the_checkpoint_folder(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words, f"x{i}"])) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert [r.doc_id for r in pipeline.near_copies(spark, df, SF_DIR).collect()] == [0]
    assert len({n for n in os.listdir(folder) if n.startswith("gridtide-")} - before) == 1


def test_sequences_can_be_read_from_the_result(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, None), (2, "four " * 5000)], "doc_id long, text string")
    got = pipeline.packed(spark, df, SF_DIR).collect()
    assert len(got) == 4 and all(len(r.ids) == r.length for r in got)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)


def test_empty_documents_pass_all_stages(spark):
    df = queries.table(spark, SF_DIR, "documents").limit(0)
    for _, stage in pipeline.STAGES:
        df = materialize(stage(spark, df, SF_DIR))
        assert df.count() == 0


def test_filter_on_the_rules_is_not_pushed_into_them(spark):
    df = queries.table(spark, SF_DIR, "documents").limit(50)
    trusted = queries.trusted(spark, SF_DIR)
    got = quality_rules.quality_rules(df, trusted)
    assert got.filter("kept").count() + got.filter("NOT kept").count() == got.count()


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy of the repository without the optional folders still registers the other queries."""
    import shutil

    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"],
        cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)},
    )
    n, has = said.stdout.split()
    assert int(n) > 40 and has == "False"


def test_columns_that_the_operators_use_may_be_in_the_documents(spark):
    clashing = ["size", "rate", "copies", "source_size", "taken", "target", "n_lines", "n_dropped", "row", "_row", "number", "site", "key", "length", "rank"]
    texts = ["some words of a text\nand more", None, "", "x " * 6000, "some words of a text\nand more"]
    rows = [(i, t, "en", None if i == 1 else f"s{i % 2}", 3, *range(len(clashing))) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in clashing))
    for stage in (pipeline.lines, pipeline.near_copies, pipeline.mixture):
        for given in (docs, docs.unionAll(docs)):
            got = stage(spark, given, SF_DIR)
            assert got.columns == docs.columns
            assert all(tuple(r)[5:] == tuple(range(len(clashing))) for r in got.collect())
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    assert {r.doc_id for r in pipeline.packed(spark, docs, SF_DIR).collect()} == set(range(5))
