"""Quality rules: counted text statistics, then an n-gram likelihood ratio against trusted text.

Tokens are runs of letters, runs of digits and runs of other signs, letters in
lower case. Each token and each pair of neighbours is hashed into ``buckets``
cells. Two multinomials over the cells, of the trusted texts and of the whole raw
corpus (both smoothed by one count a cell), give every cell a log ratio; a text
scores the mean of its n-grams' ratios. Texts below ``threshold`` are rejected, each
by its own text alone.

Everything is built-in expressions. Cells are counted map-side, so each task sends at
most one row a cell, and the table of ratios has ``buckets`` entries whatever the
size of the corpus. No text is shuffled unless the trusted ids are too many to
broadcast.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.llm.common import words_of
from gridtide.operators.sizes import broadcast_if_small

BUCKETS = 16_384
THRESHOLD = -0.35
MIN_WORDS = 50
# Trusted ids are broadcast up to this many rows (some 40 MB), beyond it they are joined by a shuffle.
SMALL_TRUSTED = 500_000

_TOKENS = r"[\p{L}\p{M}]+|\p{N}+|[^\p{L}\p{M}\p{N}\x20\x09-\x0D]+"
_SIGNS = r"[#*$%&|<>]+"
# Hash and place of a window share one number. Spark cannot hold an array of 2^27 words.
_PLACE_BITS = 27


def with_repeated_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """Adds the number of words in three-word windows found twice or more, first occurrences included.

    Windows are sorted by hash and place; neighbours with equal hashes are compared
    word by word. The array is sorted as plain numbers, so a long text costs
    n log n and nothing is exploded or shuffled.
    """
    w, s, p = F.col(words), F.col("_sorted"), F.col("_places")
    # Fewer than four words hold at most one window.
    last = F.when(F.size(w) >= 4, F.size(w) - 3).otherwise(F.lit(0))
    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.shiftleft(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), _PLACE_BITS)
        .bitwiseOR(i.cast("long")),
    )

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")

    def same(x: Column, y: Column) -> Column:
        words_equal = [F.get(w, place(x) + i) == F.get(w, place(y) + i) for i in range(3)]
        return (F.shiftright(x, _PLACE_BITS) == F.shiftright(y, _PLACE_BITS)) & words_equal[0] & words_equal[1] & words_equal[2]

    def repeated(x: Column, k: Column) -> Column:
        before = (k > 0) & same(F.get(s, k - 1), x)
        after = (k < F.size(s) - 1) & same(x, F.get(s, k + 1))
        return before | after

    df = df.withColumn("_sorted", F.sort_array(windows))
    df = df.withColumn("_places", F.sort_array(F.transform(F.filter(s, repeated), place)))
    covered = F.transform(p, lambda x, j: F.when(j == 0, 3).otherwise(F.least(F.lit(3), x - F.get(p, j - 1))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return df.withColumn(name, total).drop("_sorted", "_places")


def with_statistics(df: DataFrame, text_col: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed. NULL counts as empty."""
    whole = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.trim(x, F.lit(" \t\x0b\x0c\r"))) > 0)
    df = df.withColumns({"_words": words_of(F.col(text_col)), "_lines": lines})
    df = with_repeated_words(df, "_words", "n_repeat_words")
    return df.select(
        *[c for c in df.columns if not c.startswith("_") and c != "n_repeat_words"],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.regexp_replace(whole, _SIGNS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    ).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )


def ngram_cells(tokens: Column, buckets: int) -> Column:
    """Cells of all tokens and of all pairs of neighbours."""
    def cell(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")

    single = F.transform(tokens, lambda t: cell(t))
    pairs = F.when(F.size(tokens) > 1, F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 2), lambda i: cell(F.get(tokens, i), F.get(tokens, i + 1))
    )).otherwise(F.array().cast("array<int>"))
    return F.concat(single, pairs)


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_TOKENS), F.lit(0))


def log_ratios(docs: DataFrame, trusted_ids: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> list[float]:
    """Log of trusted over raw probability of each cell; zeros if there is no trusted text.

    ``trusted_ids`` has one column, ``id``. Counts cover all texts.
    """
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        broadcast_if_small(trusted_ids.select("id").dropna().distinct().withColumn("trusted", F.lit(1)), SMALL_TRUSTED),
        "id", "left",
    )
    tokens = marked.select("trusted", tokens_of(F.col("text")).alias("tokens"))
    cells = tokens.select("trusted", F.explode(ngram_cells(F.col("tokens"), buckets)).alias("cell"))
    counts = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("trusted")).collect()
    raw, target = [1.0] * buckets, [1.0] * buckets
    for cell, r, t in counts:
        raw[cell] += r
        target[cell] += t
    n_raw, n_target = sum(raw), sum(target)
    if n_target == buckets:
        return [0.0] * buckets
    return [math.log(t / n_target) - math.log(r / n_raw) for t, r in zip(target, raw)]


def _judged(
    docs: DataFrame, trusted_ids: DataFrame, id_col: str, text_col: str, buckets: int, threshold: float, row: Column
) -> DataFrame:
    """(row, statistics, ratio, kept); ``row`` travels as one column, so its names cannot clash."""
    ratios = json.dumps([round(x, 6) for x in log_ratios(docs, trusted_ids, id_col, text_col, buckets)])
    table = F.from_json(F.lit(ratios), "array<double>")
    read = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    base = with_statistics(read, "text").withColumn("_tokens", tokens_of(F.col("text")))
    cells = base.withColumn("_cells", ngram_cells(F.col("_tokens"), buckets))
    total = F.aggregate("_cells", F.lit(0.0), lambda acc, c: acc + F.get(table, c))
    ratio = F.when(F.size("_cells") > 0, total / F.size("_cells")).otherwise(F.lit(0.0))
    judged = cells.withColumn("ratio", ratio).drop("text", "_tokens", "_cells").withColumn(
        "kept", ~F.col("base_failed") & (F.col("ratio") >= threshold)
    )
    # A filter on the result stops here; pushed below the statistics it would compute them several times over.
    return judged.select(F.inline_outer(F.array(F.struct("*"))))


def quality_rules(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, kept) per row.

    NULL and empty texts have zeros, ``ratio`` 0 and fail by their number of words.
    Rows with a NULL or repeated id, and repeated rows, are judged each for itself;
    a NULL id is never trusted. Other columns are ignored. An empty table gives an
    empty result.
    """
    judged = _judged(docs, trusted_ids, id_col, text_col, buckets, threshold, F.col(f"`{id_col}`"))
    return judged.withColumnRenamed("row", id_col)


def keep_good(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that ``quality_rules`` keeps."""
    return _judged(docs, trusted_ids, id_col, text_col, buckets, threshold, F.struct("*")).filter("kept").select("row.*")
