"""Token counts: each distinct pre-token is cut into pieces once, documents only carry frequencies.

A text is cut into pre-tokens (what the tokenizer's own pre-tokenizer yields).
The distinct pre-tokens of the corpus form a table with their piece counts; a
document's count is the sum of frequency times pieces. Token ids of documents are
never made.

Scale: texts are read once. The most frequent pre-tokens of some ``sample_rows``
documents, of at most ``hot_bytes`` characters and no more than ``hot_size`` of them, are
broadcast (so at most ``hot_size * hot_bytes`` characters) and summed where a document is
read. All others leave the task as frequencies per document; their distinct ones are cut
and joined to them by a shuffle, exactly. What the sample holds changes what is shuffled, not the counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridtide.llm.common import id_and_bytes, load_tokenizer, ship_package, special_strings, splitter
from gridtide.session import materialize

HOT_SIZE = 200_000
HOT_BYTES = 64
CACHE_SIZE = 400_000
COUNTS_SIZE = 300_000
SAMPLE_ROWS = 20_000

# The code points with the Unicode property White_Space, as the inside of a
# character class. Pre-tokens never hold
# both white space and, after it, more than the one blank that leads a word.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_CHUNK = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")


class _PreTokens:
    """Pre-tokens of a chunk (white space and the word after it), and of texts."""

    def __init__(self, name: str, path: str | None):
        self.tokenizer = load_tokenizer(name, path)
        if self.tokenizer.normalizer is not None:
            raise ValueError("the vocabulary must not change texts before they are cut")
        self.special = special_strings(self.tokenizer)
        self.cut = splitter(self.special)

    def chunks(self, text: str) -> tuple[list[str], int]:
        """(chunks, number of added tokens in the text)."""
        if self.cut is None or not self.cut.search(text):
            return _CHUNK.findall(text), 0
        out, n = [], 0
        for part in self.cut.split(text):
            if part in self.special:
                n += 1
            else:
                out += _CHUNK.findall(part)
        return out, n

    def pre_tokens(self, chunk: str) -> list[str]:
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)]

    def pieces(self, pre_token: str) -> int:
        return len(self.tokenizer.model.tokenize(pre_token))


_loaded: dict[tuple[str, str | None], _PreTokens] = {}


def _pre_tokens(name: str, path: str | None) -> _PreTokens:
    if (name, path) not in _loaded:
        _loaded[name, path] = _PreTokens(name, path)
    return _loaded[name, path]


def vocabulary(docs: DataFrame, text_col: str, name: str, path: str | None = None) -> DataFrame:
    """(pre_token, n): distinct pre-tokens of all texts, and how often they come."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _pre_tokens(name, path)
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            total: Counter[str] = Counter()
            for chunk, n in counts.items():
                for p in cut.pre_tokens(chunk):
                    total[p] += n
            counts.clear()
            return pa.RecordBatch.from_pydict(
                {"pre_token": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())}
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(cut.chunks(text)[0])
                    if len(counts) > COUNTS_SIZE:
                        yield flush()
        if counts:
            yield flush()

    ship_package(docs.sparkSession)
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "pre_token string, n long")
    return counted.groupBy("pre_token").agg(F.sum("n").alias("n"))


def with_pieces(distinct: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Distinct pre-tokens with the number of pieces that each falls into."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _pre_tokens(name, path)
        for batch in batches:
            pieces = [cut.pieces(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pieces, pa.int32())], names=["pre_token", "pieces"])

    ship_package(distinct.sparkSession)
    return distinct.select("pre_token").mapInArrow(cut_up, "pre_token string, pieces int")


def most_frequent(vocab: DataFrame, size: int) -> DataFrame:
    """The pre-tokens above a frequency that at most ``size`` of them reach.

    The frequency comes from a histogram of eight steps per doubling, so nothing is
    sorted and no task gathers the candidates of all others.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    bins = sorted(vocab.groupBy(step.alias("step")).count().collect(), reverse=True)
    least, total = None, 0
    for at, n in bins:
        total += n
        if total > size:
            break
        least = at
    return vocab.filter(step >= least) if least is not None else vocab.limit(0)


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    path: str | None = None,
    hot_size: int = HOT_SIZE,
    hot_bytes: int = HOT_BYTES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(id_col, n_bytes, n_tokens) of every row.

    NULL and empty texts have no bytes and no tokens. Rows with a NULL or repeated
    id, and repeated rows, are counted each for itself. Other columns are ignored.
    An empty table gives an empty result. Special strings in a text count as their
    one token, as the library does by default.
    """
    total = docs.count()
    sample = docs if total <= sample_rows else docs.sample(sample_rows / total, seed=1)
    seen = materialize(vocabulary(sample, text_col, tokenizer, path).filter(F.length("pre_token") <= hot_bytes))
    found = with_pieces(most_frequent(seen, hot_size), tokenizer, path).toArrow()
    hot = docs.sparkSession.sparkContext.broadcast(dict(zip(found["pre_token"].to_pylist(), found["pieces"].to_pylist())))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, known = _pre_tokens(tokenizer, path), hot.value
        cache: dict[str, tuple[int, tuple[str, ...]]] = {}

        def look(chunk: str) -> tuple[int, tuple[str, ...]]:
            total, rest = 0, []
            for p in cut.pre_tokens(chunk):
                n = known.get(p)
                if n is None:
                    rest.append(p)
                else:
                    total += n
            return total, tuple(rest)

        for batch in batches:
            n_bytes, hot_tokens, rests = [], [], []
            for raw in batch.column(1).to_pylist():
                chunks, total = cut.chunks(raw.decode()) if raw else ((), 0)
                rest: Counter[str] = Counter()
                for chunk in chunks:
                    found = cache.get(chunk)
                    if found is None:
                        if len(cache) >= CACHE_SIZE:
                            cache.clear()
                        found = cache[chunk] = look(chunk)
                    total += found[0]
                    if found[1]:
                        rest.update(found[1])
                n_bytes.append(len(raw or b""))
                hot_tokens.append(total)
                rests.append([{"pre_token": p, "n": n} for p, n in rest.items()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(hot_tokens, pa.int64()),
                    pa.array(rests, pa.list_(pa.struct([("pre_token", pa.string()), ("n", pa.int64())]))),
                ],
                names=["id", "n_bytes", "hot_tokens", "rest"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    read = id_and_bytes(docs, id_col, text_col).mapInArrow(
        frequencies, f"id {id_type}, n_bytes long, hot_tokens long, rest array<struct<pre_token:string,n:long>>"
    )
    # The row number is fixed once it is written, so rows with equal ids stay apart.
    rows = materialize(read.withColumn("row", F.monotonically_increasing_id()))
    rare = rows.select("row", F.inline("rest")).withColumnRenamed("n", "freq")
    summed = (
        rare.join(with_pieces(rare.select("pre_token").distinct(), tokenizer, path), "pre_token")
        .groupBy("row").agg(F.sum(F.col("freq") * F.col("pieces")).alias("rare_tokens"))
    )
    return rows.select("row", "id", "n_bytes", "hot_tokens").join(summed, "row", "left").select(
        F.col("id").alias(id_col), "n_bytes",
        (F.col("hot_tokens") + F.coalesce("rare_tokens", F.lit(0))).alias("n_tokens"),
    )
