"""Phrase collocation mining on a weighted de Bruijn graph.

1. Words are counted per language. A word's id is its 64-bit hash; if two words of a
   language share one, all hash again with another salt.
2. A phrase that is frequent enough consists of such words and of such word pairs, so pieces are cut
   at rare words and, after the pairs are counted, at rare pairs. Which are not rare is told
   by a bitmap of their hashes, of a size that does not grow beyond ``MAX_BITS``: a rare
   one may pass by chance and costs room, nothing else.
3. The longest grams (``longest`` words) are the edges of a de Bruijn graph whose nodes are one
   word shorter; an edge's weight is how often it occurs. Where a piece or a cut
   leaves fewer words, the shorter gram that starts there is counted as the end of flow.
4. A node's count is the weight of the edges that leave it plus the ends in it. Chains
   of nodes joined by edges that carry all the flow of both their nodes are compacted into
   one row, found by pointer jumping and written in segments. Counts of shorter grams
   follow from the compacted nodes and the ends, length by length.
5. Candidates meet the counts of their parts, the weakest cut gives the score, and phrases
   inside a longer candidate that occurs (nearly) as often go.

Scale: texts are read three times and cut into words in Arrow batches; what is shuffled is
combined in each task first. Step 3 shuffles frequent material only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridtide.llm.common import ship_package
from gridtide.operators.sizes import broadcast_if_small
from gridtide.session import materialize

LONGEST = 5
LEAST_COUNT = 100
TOP = 2000
SUBSUMED_PERCENT = 100
MAX_BITS = 1 << 28
BITS_PER_ENTRY = 32
SEGMENT = 512
CHUNK_BYTES = 1 << 20
CACHE_SIZE = 250_000
COUNTS_SIZE = 250_000
KEYS_SIZE = 1 << 20
SMALL_LANGS = 100_000
NO_LANG = "und"

_ID = 8  # bytes of a word's id
_SEED = 42  # the seed of Spark's xxhash64
_PAGE = 1 << 15  # bits that one bitmap_construct_agg holds
_U = np.uint64
_BREAK = b"\xff"  # stands in no UTF-8 text
# A-Z to a-z, piece ends to the break, the tab to a blank.
_TABLE = bytes(
    0xFF if b in b".,;:!?\x0a\x0b\x0c\x0d" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0x7FB5D329728EA185)
    h = (h ^ (h >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U(33))


def word_lists(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The words of texts in turn, with a break after every piece; some megabytes at a time."""
    data = _BREAK.join(texts).translate(_TABLE)
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > CHUNK_BYTES and (cut := data.find(_BREAK, at + CHUNK_BYTES)) >= 0:
            end = cut
        yield data[at:end].replace(_BREAK, b" \xff ").split()
        at = end + 1


def _words_by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Lists of words and breaks, each of one language; about ``CHUNK_BYTES`` of text at a time."""
    held: dict[str, tuple[list[bytes], int]] = {}
    for lang, text in zip(batch.column(0), batch.column(1)):
        if not text.is_valid:
            continue
        lang, text = lang.as_py(), text.as_py()
        some, size = held.get(lang, ([], 0))
        some.append(text)
        held[lang] = some, size + len(text)
        if size + len(text) >= CHUNK_BYTES:
            del held[lang]
            for words in word_lists(some):
                yield lang, words
    for lang, (some, _) in held.items():
        for words in word_lists(some):
            yield lang, words


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    ship_package(docs.sparkSession)
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).cast("binary").alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter[bytes]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, c in counts.items():
                c.pop(_BREAK, None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()).cast(pa.string()), pa.array(list(c.values()), pa.int64())],
                    names=["lang", "word", "n"],
                )
            counts.clear()

        for batch in batches:
            for lang, words in _words_by_lang(batch):
                counts.setdefault(lang, Counter()).update(words)
                if sum(map(len, counts.values())) > COUNTS_SIZE:
                    yield from flush()
        yield from flush()

    counted = texts.mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _id_of(word: Column, salt: str) -> Column:
    """64-bit hash of a word; zero is kept free for the break."""
    h = F.xxhash64(F.concat(word, F.lit(salt)))
    return F.when(h == 0, F.lit(1).cast("long")).otherwise(h)


def _with_ids(counts: DataFrame) -> tuple[DataFrame, str]:
    """The counts with ids that tell all words of a language apart, and the salt that gives them."""
    for i in range(100):
        salt = "" if i == 0 else f"#{i}"
        named = counts.withColumn("id", _id_of(F.col("word"), salt))
        if named.groupBy("lang", "id").count().filter("count > 1").isEmpty():
            return named, salt
    raise ArithmeticError("no salt tells all words apart")


class Bitmap:
    """Which cells of 64-bit keys are taken."""

    def __init__(self, data: np.ndarray):
        self.data, self.mask = data, _U(8 * len(data) - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        cell = keys & self.mask
        return (self.data[cell >> _U(3)] >> (cell & _U(7)).astype(np.uint8)) & 1 > 0

    @classmethod
    def of(cls, keys: DataFrame, max_bits: int = MAX_BITS) -> Bitmap:
        """Of the long column ``key``: some 32 bits a key, at most ``max_bits`` in all."""
        bits = _PAGE
        n = keys.count()
        while bits < min(BITS_PER_ENTRY * n, max_bits):
            bits *= 2
        cell = F.col("key").bitwiseAND(F.lit(bits - 1))
        pages = keys.select(cell.alias("c")).groupBy(F.expr(f"c DIV {_PAGE}").alias("page")).agg(
            F.bitmap_construct_agg(F.expr(f"c % {_PAGE}")).alias("bits")
        )
        data = np.zeros(bits // 8, np.uint8)
        for page, found in pages.collect():
            data[page * (_PAGE // 8):(page + 1) * (_PAGE // 8)] = np.frombuffer(found, np.uint8)
        return cls(data)


class _Ids:
    """Ids of words in turn; zero for breaks and for words that the bitmap does not hold."""

    def __init__(self, frequent: Bitmap, salt: str):
        self.frequent, self.salt = frequent, salt.encode()
        self.known: dict[str, dict[bytes, int]] = {}

    def __call__(self, lang: str, words: list[bytes]) -> np.ndarray:
        known = self.known.setdefault(lang, {_BREAK: 0})
        new = [w for w in set(words) if w not in known]
        if new:
            if sum(map(len, self.known.values())) > CACHE_SIZE:
                self.known = {lang: (known := {_BREAK: 0})}
                new = list(set(words) - {_BREAK})
            hashes = np.array([xxhash.xxh64_intdigest(w + self.salt, _SEED) or 1 for w in new], _U)
            kept = self.frequent.has(hashes ^ _lang_key(lang))
            known.update(zip(new, np.where(kept, hashes, _U(0)).tolist()))
        return np.fromiter(map(known.__getitem__, words), _U, len(words))


def _lang_key(lang: str) -> np.uint64:
    return _U(xxhash.xxh64_intdigest(lang.encode(), _SEED))


def _pair_keys(lang: str, ids: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words; of no meaning where one of them is zero."""
    return _mix(_mix(ids[:-1] ^ _lang_key(lang)) + ids[1:])


def pair_counts(texts: DataFrame, words: Broadcast, salt: str) -> DataFrame:
    """(key, n): how often pairs of frequent words with this hash stand side by side."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _Ids(words.value, salt)
        found: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

        for batch in batches:
            for lang, listed in _words_by_lang(batch):
                ids = ids_of(lang, listed)
                full = ids != 0
                found.append(_pair_keys(lang, ids)[full[:-1] & full[1:]])
                if sum(map(len, found)) > KEYS_SIZE:
                    yield flush()
        if found:
            yield flush()

    return texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, how often each)."""
    h = np.zeros(len(rows), _U)
    for column in rows.T:
        h = _mix(h + column)
    _, first, which, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    if (rows[first][which] == rows).all():
        return rows[first], n
    return np.unique(rows, axis=0, return_counts=True)  # two rows share a hash


def windows(texts: DataFrame, words: Broadcast, pairs: Broadcast, salt: str, longest: int) -> DataFrame:
    """(lang, gram, w): the grams that start somewhere, each as long as cuts allow, of 2 to ``longest`` words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, frequent = _Ids(words.value, salt), pairs.value
        for batch in batches:
            for lang, listed in _words_by_lang(batch):
                ids = ids_of(lang, listed)
                full = ids != 0
                joined = full[:-1] & full[1:]
                joined[joined] = frequent.has(_pair_keys(lang, ids)[joined])
                starts = np.flatnonzero(joined)
                if not len(starts):
                    continue
                # How many further words follow without a cut.
                padded = np.concatenate([joined, np.zeros(longest, bool)])
                run, length = np.ones(len(starts), bool), np.ones(len(starts), np.int64)
                for step in range(longest - 1):
                    run &= padded[starts + step]
                    length += run
                at = np.minimum(starts[:, None] + np.arange(longest), len(ids) - 1)
                rows, n = _distinct_rows(np.where(np.arange(longest) < length[:, None], ids[at], _U(0)))
                inside = rows != 0
                offsets = np.concatenate([[0], np.cumsum(_ID * inside.sum(1))]).astype(np.int32)
                grams = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows[inside].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(rows), pa.string()), grams, pa.array(n.astype(np.int64))], names=["lang", "gram", "w"]
                )

    counted = texts.mapInArrow(count, "lang string, gram binary, w long")
    return counted.groupBy("lang", "gram").agg(F.sum("w").alias("w"))


def _part(gram: str | Column, first: int | Column, words: int | Column) -> Column:
    """``words`` words of a gram from word ``first`` (from 0) on."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.substring(F.col(gram) if isinstance(gram, str) else gram, lit(first) * _ID + 1, lit(words) * _ID)


def _long(gram: str = "gram") -> Column:
    return F.expr(f"octet_length({gram}) DIV {_ID}")


def _chains(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(lang, node, head, place) of the nodes on chains of edges that carry all the flow of both their nodes."""
    size = _long() - 1
    ends = edges.select("lang", "w", _part("gram", 0, size).alias("node"), _part("gram", 1, size).alias("next"))
    flow = nodes.select("lang", F.col("gram").alias("node"), F.col("n").alias("w"))
    full = ends.join(flow, ["lang", "node", "w"]).join(flow.withColumnRenamed("node", "next"), ["lang", "next", "w"])
    # Flow is finite, so a chain ends and never comes back to itself.
    links = materialize(full.select("lang", "node", "next"))
    heads = links.select("lang", "node").join(links.select("lang", F.col("next").alias("node")), ["lang", "node"], "left_anti")
    at = materialize(
        links.select("lang", F.col("next").alias("node"), F.col("node").alias("head"), F.lit(1).cast("long").alias("place"))
        .unionAll(heads.select("lang", "node", F.col("node").alias("head"), F.lit(0).cast("long")))
    )
    while True:
        up = at.select("lang", F.col("node").alias("head"), F.col("head").alias("above"), F.col("place").alias("more"))
        jumped = materialize(
            at.join(up, ["lang", "head"]).select("lang", "node", F.col("above").alias("head"), (F.col("place") + F.col("more")).alias("place"), "more")
        )
        at = jumped.drop("more")
        if jumped.filter("more > 0").isEmpty():
            return at


def _compacted(nodes: DataFrame, chains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((lang, gram, n) of nodes that stand alone, (lang, path, starts, n) of segments of chains, with as many nodes as ``starts``)."""
    alone = nodes.join(chains.select("lang", F.col("node").alias("gram")), ["lang", "gram"], "left_anti").select("lang", "gram", "n")
    with_flow = chains.join(nodes.withColumnRenamed("gram", "node"), ["lang", "node"])
    segments = with_flow.groupBy("lang", "head", F.expr(f"place DIV {SEGMENT}").alias("segment")).agg(
        F.sort_array(F.collect_list(F.struct("place", "node"))).alias("run"), F.max("n").alias("n")
    )
    last = lambda x: F.substring(x.node, -_ID, _ID)
    # A binary has no array_join, so words are added one by one.
    path = F.aggregate(F.slice("run", 2, SEGMENT), F.col("run")[0].node, lambda acc, x: F.concat(acc, last(x)))
    return alone, segments.select("lang", path.alias("path"), F.size("run").alias("starts"), "n")


def gram_counts(grams: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """((lang, gram, n) of all grams of 2 to ``longest`` words that occur ``least`` times, nodes on chains).

    ``grams`` are ``windows``: edges, and shorter grams where flow ends.
    """
    length = _long()
    edges = grams.filter((length == longest) & (F.col("w") >= least))
    found = [edges.select("lang", "gram", F.col("w").alias("n"))]

    def flow(of: DataFrame, words: int) -> DataFrame:
        """Counts of grams of so many words: what flows on, and what ends in them."""
        ends = grams.filter(length == words).select("lang", "gram", F.col("w").alias("n"))
        return materialize(of.unionAll(ends).groupBy("lang", "gram").agg(F.sum("n").alias("n")))

    chains = None
    above = grams.filter(length == longest).select("lang", "gram", F.col("w").alias("n"))
    for words in range(longest - 1, 1, -1):
        if words == longest - 2 and chains is not None:
            above, paths = _compacted(above, chains)
            starts = paths.select("lang", "path", "n", F.explode(F.sequence(F.lit(0), F.col("starts") - 1)).alias("at"))
            inside = starts.select("lang", _part("path", F.col("at"), words).alias("gram"), "n")
        on = above.select("lang", _part("gram", 0, words).alias("gram"), "n")
        if words == longest - 2 and chains is not None:
            on = on.unionAll(inside)
        above = flow(on, words)
        frequent = above.filter(F.col("n") >= least)
        found.append(frequent)
        if words == longest - 1:
            chains = materialize(_chains(frequent, edges))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return materialize(out), chains


def mine_phrases(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    longest: int = LONGEST,
    least: int = LEAST_COUNT,
    top: int = TOP,
    percent: int = SUBSUMED_PERCENT,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase has 2 to ``longest`` words and occurs ``a >= least`` times inside pieces. Its score is the
    least of ``floor(1000 a n / (l r))`` over its cuts, the smallest first part among equals. Phrases inside a longer
    one that occurs ``percent`` per cent as often are left out. Ties of score go to the larger ``a``,
    then to the smaller phrase in byte order. A NULL language is ``und``, together with rows that say so. NULL and empty texts have no words; repeated
    rows count each; texts of any length count whole, their pieces being cut into words some
    megabytes at a time. Other columns are ignored. An empty table gives an empty result.
    """
    context = docs.sparkSession.sparkContext
    texts = _texts(docs, lang_col, text_col)
    vocabulary, salt = _with_ids(materialize(word_counts(texts)))
    frequent = materialize(vocabulary.filter(F.col("n") >= least))
    words = context.broadcast(Bitmap.of(frequent.select(F.col("id").bitwiseXOR(F.xxhash64("lang")).alias("key")), max_bits))
    pairs = materialize(pair_counts(texts, words, salt).filter(F.col("n") >= least).select("key"))
    grams = materialize(windows(texts, words, context.broadcast(Bitmap.of(pairs, max_bits)), salt, longest))
    counts, chains = gram_counts(grams, longest, least)
    totals = broadcast_if_small(vocabulary.groupBy("lang").agg(F.sum("n").alias("n")), SMALL_LANGS)
    scored = _scored(counts, frequent, totals)
    kept = _without_parts(scored, counts, chains, percent)
    return _ranked(kept, frequent, top)


def _little_endian(id_: Column) -> Column:
    """An id as the eight bytes it has in a gram."""
    return F.unhex(F.regexp_replace(F.lpad(F.hex(id_), 2 * _ID, "0"), "(..)(..)(..)(..)(..)(..)(..)(..)", "$8$7$6$5$4$3$2$1"))


def _scored(counts: DataFrame, frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, gram, a, l, r, n, score) of every gram, by its weakest cut."""
    single = frequent.select("lang", _little_endian(F.col("id")).alias("gram"), "n")
    parts = materialize(counts.unionAll(single))
    cuts = counts.select("lang", "gram", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), _long() - 1)).alias("k"))
    left = parts.select("lang", F.col("gram").alias("first"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("gram").alias("rest"), F.col("n").alias("r"))
    met = (
        cuts.withColumn("first", _part("gram", 0, F.col("k"))).withColumn("rest", _part("gram", F.col("k"), _long() - F.col("k")))
        .join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    )
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    score = F.expr(f"(CAST(1000 AS DECIMAL(4, 0)) * {wide('a')} * CAST(n AS DECIMAL(15, 0))) DIV ({wide('l')} * {wide('r')})")
    best = met.groupBy("lang", "gram", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    return materialize(best.select("lang", "gram", "a", "b.l", "b.r", "n", "b.score"))


def _without_parts(scored: DataFrame, counts: DataFrame, chains: DataFrame, percent: int) -> DataFrame:
    """The grams that stand inside no longer one that is nearly as frequent."""
    # A node on a chain stands in an edge that occurs as often.
    short = scored.join(chains.select("lang", F.col("node").alias("gram")), ["lang", "gram"], "left_anti")
    size = _long()
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda k: F.transform(F.sequence(F.lit(0), size - k), lambda i: F.struct(i.alias("i"), k.alias("k"))),
    ))
    inside = counts.filter(size > 2).select("lang", F.col("n").alias("outer"), "gram", F.explode(spans).alias("s"))
    most = inside.groupBy("lang", _part("gram", F.col("s.i"), F.col("s.k")).alias("gram")).agg(F.max("outer").alias("outer"))
    kept = short.join(most, ["lang", "gram"], "left")
    return kept.filter(F.col("outer").isNull() | (100 * F.col("outer") < percent * F.col("a"))).drop("outer")


def _ranked(kept: DataFrame, frequent: DataFrame, top: int) -> DataFrame:
    """The first ``top`` grams of each language, as words."""
    named = frequent.select("lang", _little_endian(F.col("id")).alias("id"), "word")
    words = kept.select("lang", "gram", F.explode(F.sequence(F.lit(0), _long() - 1)).alias("i")).withColumn("id", _part("gram", F.col("i"), 1))
    phrases = words.join(named, ["lang", "id"]).groupBy("lang", "gram").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x.word), " ").alias("phrase")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.join(phrases, ["lang", "gram"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
