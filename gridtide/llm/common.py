"""What several operators share: word splitting, held-out folds, tokenizers, bounded tables on the driver."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The word pattern of all operators; `bytes.split()` cuts at exactly these six characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN), lambda w: w != "")


def fold(doc_id: Column, folds: int) -> Column:
    """Fold of a row: crc32 of its id as text; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


# By application; the archive is served from the driver as long as it runs.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package: its sources go out with the session once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory(prefix="gridtide-sources-")
    archive = os.path.join(folder.name, "gridtide_sources.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for base, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(base, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)


def id_and_bytes(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, text as UTF-8 bytes, …): what the Python side reads, and nothing else."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), *more)


def load_tokenizer(name: str, path: str | None = None):
    """A tokenizer of the `tokenizers` library from ``path``, or from the public vocabulary files by name."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    return Tokenizer.from_file(path)


def special_strings(tokenizer) -> dict[str, int]:
    """Added tokens that are taken out of a text before anything else, with their ids."""
    added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    for token in tokenizer.get_added_tokens_decoder().values():
        if token.normalized or token.single_word or token.lstrip or token.rstrip:
            raise ValueError(f"added token {token.content!r} has options that are not handled")
    return added


def splitter(parts: Iterable[str]):
    """Compiled pattern that cuts a text at the given strings and keeps them, or None without any."""
    import re

    parts = sorted(parts, key=len, reverse=True)
    return re.compile("(" + "|".join(re.escape(p) for p in parts) + ")") if parts else None
