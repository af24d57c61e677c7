"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept. ``run`` writes every stage's result as Parquet in the shared checkpoint folder and
reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.llm import line_dedup, minhash, mixing, packing, quality_rules
from gridtide.llm.queries import table, trusted
from gridtide.operators.sizes import broadcast_if_small
from gridtide.session import materialize, settled

# Ids of dropped copies are broadcast up to this many (16 MB), beyond it they are joined by shuffle.
SMALL_IDS = 2_000_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, against the texts marked as good.

    NULL and empty texts have no words, so they go; repeated rows are judged alike, a NULL id is
    in no trusted text. Columns may have any names.
    """
    return quality_rules.keep_good(docs, trusted(spark, sf_dir))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the boilerplate lines of their source; ``n_chars``, where there is one, follows the text.

    A NULL text stays, a text whose lines all go is empty. A NULL source is a source. Repeated rows and
    near copies count as one page and are all cleaned. Other columns stay as they are, whatever their names.
    """
    others = [c for c in docs.columns if c != "text"]
    cleaned = line_dedup.drop_boilerplate(docs.select("source", "text", F.struct(*others).alias("_rest")))
    length = F.length("text").cast("long")
    return cleaned.select([
        (F.col("text") if c == "text" else length if c == "n_chars" else F.col(f"_rest.`{c}`")).alias(c) for c in docs.columns
    ])


def _told_apart(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row, number): one row per id and text, the least, numbered by id; rows with a NULL id stay as they are, without a number."""
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    known = packed.filter("doc_id IS NOT NULL")
    once = known.groupBy("doc_id", F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.min("row").alias("row"))
    numbered = once.orderBy("doc_id", "digest").select("row.doc_id", "row.text", "row", F.monotonically_increasing_id().alias("number"))
    return materialize(numbered.unionByName(packed.filter("doc_id IS NULL").withColumn("number", F.lit(None).cast("long"))))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; NULL ids stay.

    Rows that repeat an id and its text are one document, different texts under one id are several.
    NULL and empty texts are copies of nothing. Columns may have any names.
    """
    if docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return _without_copies(docs, "doc_id")
    return _without_copies(_told_apart(docs), "number").select("row.*")


def _without_copies(rows: DataFrame, key: str) -> DataFrame:
    found = settled(rows.sparkSession, lambda: minhash.near_duplicates(rows, key).select(key, "kept"))
    gone = broadcast_if_small(found.filter(~F.col("kept")).select(key), SMALL_IDS)
    return rows.join(gone, key, "left_anti").select(*rows.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, which may be never.

    A NULL source is a source of its own; NULL and empty texts take no words and are kept. Rows that
    repeat are documents each for itself. All columns stay, whatever their names.
    """
    rows = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_document"))
    mixed = mixing.mix(rows, keep=("_document",)).filter("copies > 0").select("_document", "copies")
    return mixed.select("_document", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_document.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their ids, and their places in the sequences.

    NULL and empty texts are one end mark; every row is packed, repeated ones and NULL ids too.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_copies", near_copies),
    ("mixing", mixture),
    ("packing", packed),
]

# Likelihood ratios, signatures, Newton steps and tokenisation cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
