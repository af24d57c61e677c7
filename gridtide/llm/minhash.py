"""MinHash near-dedup: one-permutation hashing, optimal densification, bands, stars.

1. A text becomes the sorted set of its 64-bit word-shingle hashes. One pass over
   the set gives ``bands * rows`` bins by the leading bits of the hash; the least
   hash of a bin is its value. An empty bin borrows from the first filled bin on
   its own fixed pseudo-random walk (optimal densification).
2. Texts with one and the same set collapse into a class, so exact copies cost one
   edge each.
3. ``rows`` bins form a band. Classes that agree in a band share a bucket. Within a
   bucket only a star is compared: every class with the centre, so a bucket of m
   classes has m - 1 candidates. The centre is the class whose buckets hold the most
   classes, which for copies edited apart is what they were copied from.
4. Candidates are confirmed on the full sets.
5. What is left of a bucket without its centre is looked at again if it holds several
   components. Buckets with more than ``SMALL`` classes left are split by further bins of
   the same signature (each band has a row of its own of ``STEP`` more for each of ``LEVELS``
   levels) and starred again, so a level costs at most its members. Small buckets, and what a last level leaves,
   are starred from further classes, few at first, four times as many from round to round, each one once,
   until no bucket holds two components. In splits and in further stars a pair is a candidate only
   if one-bit sketches of its signatures agree as far as near copies' do, so few full sets are moved.
6. Large buckets that hold several components even then are taken uncut: their classes are joined exactly, by
   prefixes of the full sets, so what the splits parted is not lost.

Recall: two texts of similarity s miss all buckets with (1 - s^rows)^bands, by default 1e-6
at the similarity asked for. In a small bucket a sketch loses a pair with 3e-7 (five standard deviations);
in a large one none is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridtide.llm.common import id_and_bytes
from gridtide.llm.components import connected_components, merged_components
from gridtide.session import compacted, materialize

WORDS = 5
PERCENT = 80
# A pair at the similarity asked for agrees in a band with this chance at least, and misses all bands with that one.
BAND_CHANCE = 0.19
MISS = 1e-6
CENTRES = 3
SMALL = 24
STEP = 3
LEVELS = 6
BLOCK = 1000
# Candidates that are confirmed in one partition at most; each brings two sets.
FEW_EDGES = 10_000
# Candidates whose classes are broadcast at most (some 32 MB), so that no other class's set is moved.
SMALL_EDGES = 250_000
SKETCH_WORDS = 6
SKETCH_SIGMAS = 5.0
# Sets that fill fewer bins have theirs looked up instead of walked to.
FEW_BINS = 32

_U = np.uint64
_WALK = 64


def band_plan(percent: int) -> tuple[int, int]:
    """(bands, rows) for a similarity: as many rows as ``BAND_CHANCE`` allows, and the bands that ``MISS`` asks for."""
    s = min(percent, 99) / 100
    rows = max(1, math.floor(math.log(BAND_CHANCE) / math.log(s)))
    return math.ceil(math.log(MISS) / math.log(1 - s**rows)), rows


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixing step (the finaliser of splitmix64)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


def _powers(x: int, n: int) -> np.ndarray:
    """x^0 to x^(n - 1) modulo 2^64."""
    out = np.full(n, x, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BLOCK = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_UP, _DOWN = _powers(_BASE, _BLOCK), _powers(_inverse(_BASE), _BLOCK)
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
# A number for each byte, the same for A-Z as for a-z; none for white space.
_LETTERS = _mix(np.arange(256, dtype=np.uint64) + _U(1 << 50))
_LETTERS[65:91] = _LETTERS[97:123]
_LETTERS[_SPACE] = 0


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of ``data``, A-Z as a-z, and where the words start.

    A polynomial of mixed bytes, taken from running sums over blocks that end between words. Only
    a word longer than a block is hashed by itself.
    """
    text = np.frombuffer(data, np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(text):
        part = text[at:at + _BLOCK]
        space = _SPACE[part]
        if at + _BLOCK < len(text):
            last = len(part) - 1 - int(space[::-1].argmax())
            if not space[last]:
                cuts = (data.find(c, at + _BLOCK) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
                end = min((c for c in cuts if c >= 0), default=len(text))
                hashes.append(np.array([xxhash.xxh64_intdigest(data[at:end].lower())], np.uint64))
                starts.append(np.array([at]))
                at = end
                continue
            part, space = part[:last + 1], space[:last + 1]
        edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LETTERS[part] * _UP[:len(part)], out=sums[1:])
        hashes.append(_mix((sums[edge[1::2]] - sums[edge[::2]]) * _DOWN[edge[::2]]))
        starts.append(edge[::2] + at)
        at += len(part)
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


class Shingler:
    """Sorted distinct hashes of the ``n``-word shingles of texts; all words of a text as one if there are fewer."""

    def __init__(self, n: int):
        self.n = n
        self.factors = [_U(f) for f in _mix(np.arange(1, n + 1, dtype=np.uint64)) | _U(1)]

    def sets(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The sets of all texts one after the other, and where each begins (and the last ends)."""
        data = b"\n".join([t or b"" for t in texts])
        lengths = np.array([len(t or b"") + 1 for t in texts], np.int64)
        h, starts = word_hashes(data)
        first = np.append(np.searchsorted(starts, np.cumsum(lengths) - lengths), len(h))
        words = np.diff(first)
        m = max(0, len(h) - self.n + 1)
        total = np.zeros(len(h), np.uint64)
        for i, f in enumerate(self.factors):
            total[:m] += h[i:i + m] * f
        total = _mix(total)
        size = np.where(words > 0, np.maximum(words - self.n + 1, 1), 0)
        for k in np.flatnonzero((words > 0) & (words < self.n)):
            # As many words as there are, told apart from any longer shingle by their number.
            short = h[first[k]:first[k + 1]] * np.array(self.factors[:words[k]])
            total[first[k]] = _mix(short.sum(keepdims=True) + _mix(words[k:k + 1].astype(np.uint64)))[0]
        for k in np.flatnonzero(size > 1):
            total[first[k]:first[k] + size[k]].sort()
        place = np.arange(len(h))
        owner = np.repeat(np.arange(len(texts)), words)
        offset = place - first[owner]
        new = offset < size[owner]
        new[1:] &= (total[1:] != total[:-1]) | (offset[1:] == 0)
        kept = total[new]
        return kept, np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(texts)))]).astype(np.int64)

    def __call__(self, text: bytes | None) -> np.ndarray:
        return self.sets([text])[0]


def _in_blocks(texts: list[bytes | None], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of texts that hold ``most`` bytes about, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"") + 1
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


@lru_cache(maxsize=4)
def signer_of(bands: int, rows: int) -> Signer:
    return Signer(bands, rows)


class Signer:
    """Band hashes of shingle sets."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        i = np.arange(self.bins, dtype=np.uint64)
        # The leading bits of a hash choose the bin: bin i starts where hash * bins / 2^64 reaches i.
        self.starts = (np.arange(self.bins, dtype=object) * (1 << 64) // self.bins).astype(np.uint64)
        walk = np.arange(1, _WALK + 1, dtype=np.uint64)
        self.walk = (_mix(i[:, None] * _U(1 << 20) + walk[None, :]) % _U(self.bins)).astype(np.int64)

    @cached_property
    def first_steps(self) -> np.ndarray:
        """[bin, other]: at which step the walk of a bin comes to the other one first."""
        bins = np.arange(self.bins)
        first, step = np.full((self.bins, self.bins), -1, np.int32), 0
        left = first.size
        while left:
            source = self._step(bins, step)
            new = first[bins, source] < 0
            first[bins[new], source[new]] = step
            left -= int(new.sum())
            step += 1
        return first

    def _step(self, bins: np.ndarray, step: int) -> np.ndarray:
        """Where the walk of each bin is after so many steps."""
        if step < _WALK:
            return self.walk[bins, step]
        return (_mix(bins.astype(np.uint64) * _U(1 << 20) + _U(step + 1)) % _U(self.bins)).astype(np.int64)

    def signatures(self, hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """One row of bins per set, sets being given as by ``Shingler.sets``; none may be empty."""
        n = len(begins) - 1
        bins = np.searchsorted(self.starts, hashes, "right") - 1
        cell = np.repeat(np.arange(n) * self.bins, np.diff(begins)) + bins
        least = np.diff(cell, prepend=-1) != 0
        out, filled = np.zeros(n * self.bins, np.uint64), np.zeros(n * self.bins, bool)
        out[cell[least]] = hashes[least]
        filled[cell[least]] = True
        open_ = ~filled
        for i in np.flatnonzero(np.bincount(cell[least] // self.bins, minlength=n) < FEW_BINS):
            # Long walks would lead to the few bins that are filled, so these are looked up.
            row = slice(i * self.bins, (i + 1) * self.bins)
            known = np.flatnonzero(filled[row])
            out[row] = np.where(filled[row], out[row], out[row][known][self.first_steps[:, known].argmin(1)])
            open_[row] = False
        empty = np.flatnonzero(open_)
        step = 0
        while len(empty):
            of = empty % self.bins
            source = empty - of + self._step(of, step)
            found = filled[source]
            out[empty[found]] = out[source[found]]
            empty = empty[~found]
            step += 1
        return out.reshape(n, self.bins)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        return self.signatures(hashes, np.array([0, len(hashes)]))[0]

    def further(self, bins: np.ndarray) -> np.ndarray:
        """For each band and level one hash of ``STEP`` more bins, taken from anywhere in the signature."""
        cell = np.arange(self.bands * LEVELS * STEP, dtype=np.uint64)
        chosen = bins[(_mix(cell + _U(1 << 40)) % _U(self.bins)).astype(np.int64)].reshape(-1, STEP)
        total = np.zeros(len(chosen), np.uint64)
        for r in range(STEP):
            total = _mix(total * _U(0x9E3779B97F4A7C15) + chosen[:, r])
        return total

    def sketch(self, bins: np.ndarray) -> np.ndarray:
        """One bit of each of the first bins, in ``SKETCH_WORDS`` words; bins are used again if there are too few."""
        bits = (_mix(bins) & _U(1)).astype(np.uint8)
        return np.packbits(np.resize(bits, 64 * SKETCH_WORDS)).view(np.uint64)

    def band_hashes(self, hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """One row of band hashes per set."""
        bins = self.signatures(hashes, begins).reshape(-1, self.bands, self.rows)
        total = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), bins.shape[:2])
        for r in range(self.rows):
            total = _mix(total * _U(0x9E3779B97F4A7C15) + bins[:, :, r])
        return total


def _signed(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """(id, n_shingles, set_key, band hashes) per row; set_key is NULL without a shingle."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, signer = Shingler(words), signer_of(bands, rows)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _in_blocks(texts):
                hashes, begins = shingles.sets(texts[start:end])
                sizes = np.diff(begins)
                some = sizes > 0
                keys = [xxhash.xxh128_digest(hashes[i:j].tobytes()) if j > i else None for i, j in zip(begins[:-1], begins[1:])]
                found = signer.band_hashes(hashes, np.append(begins[:-1][some], len(hashes))).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()), mask=pa.array(~some))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists],
                    names=["id", "n_shingles", "set_key", "bands"],
                )

    return id_and_bytes(docs, id_col, text_col).mapInArrow(sign, "id long, n_shingles long, set_key binary, bands array<long>")


def _full_sets(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame, words: int) -> DataFrame:
    """(node, set) of the documents whose id is in ``nodes``; read again from the texts."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _in_blocks(texts):
                hashes, begins = shingles.sets(texts[start:end])
                keys = [xxhash.xxh128_digest(hashes[i:j].tobytes()) for i, j in zip(begins[:-1], begins[1:])]
                sets = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(keys, pa.binary()), sets], names=["id", "set_key", "hashes"]
                )

    texts = id_and_bytes(docs, id_col, text_col)
    wanted = texts.join(nodes.withColumnRenamed("rep", "id"), "id", "left_semi")
    return wanted.mapInArrow(shingle, "id long, set_key binary, hashes array<long>").dropDuplicates(["set_key"]).drop("id")


def _near_enough(common: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """100 * common >= percent * (n_a + n_b - common), said so that ``common`` is worked out once."""
    return (100 + percent) * common >= percent * (n_a + n_b)


def _of_edges(sets: DataFrame, edges: DataFrame, candidates: int) -> DataFrame:
    """The ``sets`` of the classes in ``edges``; all of them where there are many candidates."""
    if candidates > SMALL_EDGES:
        return sets
    nodes = edges.select(F.col("a").alias("set_key")).union(edges.select("b")).distinct()
    return sets.join(F.broadcast(nodes), "set_key", "left_semi")


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b, rep_a, rep_b, n_a, n_b) whose full sets are near enough.

    The member's set is fetched first and then meets the centre's, so a centre's
    set is not sent once per member.
    """
    members = edges.join(sets.select(F.col("set_key").alias("b"), F.col("hashes").alias("h_b")), "b")
    pairs = members.join(sets.select(F.col("set_key").alias("a"), F.col("hashes").alias("h_a")), "a")
    common = F.size(F.array_intersect("h_a", "h_b")).cast("long")
    return pairs.filter(_near_enough(common, F.col("n_a"), F.col("n_b"), percent)).select("rep_a", "rep_b")


def _star(buckets: DataFrame, centres: DataFrame, percent: int, alike: Column | None = None) -> DataFrame:
    """Candidate edges from the centres of each bucket to its other classes, by size alone or by their sketches too."""
    more = [] if alike is None else ["sketch"]
    ends = buckets.select("key", F.col("set_key").alias("b"), F.col("rep").alias("rep_b"), "n", *more)
    edges = ends.join(centres, "key").filter(
        (F.col("a") != F.col("b"))
        & (100 * F.least("n_a", "n") >= percent * F.greatest("n_a", "n"))
        & (F.lit(True) if alike is None else alike)
    )
    return edges.select("a", "b", "rep_a", "rep_b", "n_a", F.col("n").alias("n_b")).distinct()


def _refined(sets: DataFrame, bands: int, rows: int) -> DataFrame:
    """(set_key, further, sketch) of classes whose full sets are given."""

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = signer_of(bands, rows)
        for batch in batches:
            further, sketches = [], []
            for values in batch.column(1):
                bins = signer.signature(values.values.to_numpy().view(np.uint64))
                further.append(signer.further(bins).view(np.int64))
                sketches.append(signer.sketch(bins).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(further, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                names=["set_key", "further", "sketch"],
            )

    return sets.select("set_key", "hashes").mapInArrow(refine, "set_key binary, further array<long>, sketch array<long>")


def _alike(percent: int, bins: int) -> Column:
    """Sketches of two classes (``sketch``, ``sketch_a``) differ in no more bits than near copies' may.

    A bit of a near copy agrees with (1 + s) / 2; a sketch has as many independent bits as the smaller
    set has shingles at most.
    """
    bits = 64 * SKETCH_WORDS
    apart = (1 - percent / 100) / 2
    different = sum((F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("sketch_a")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    independent = F.least(F.col("n"), F.col("n_a"), F.lit(min(bits, bins)))
    return different <= bits * (apart + SKETCH_SIGMAS * F.sqrt(F.lit(apart * (1 - apart)) / independent))


def _open(left: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, with their ``component``, the ``main`` one of the bucket and its ``members``."""
    labelled = left.join(parts, left.rep == parts.node, "left").withColumn("component", F.coalesce("component", "rep")).drop("node")
    inside = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("inside"))
    several = inside.groupBy("key").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("inside").alias("members"),
        F.max_by("component", F.struct("inside", "component")).alias("main"),
    ).filter("parts > 1").drop("parts")
    return labelled.join(several, "key")


def _centres(buckets: DataFrame, *more: str) -> DataFrame:
    """(key, a, rep_a, n_a, …): the most crowded class of each bucket, the smaller id among equals."""
    weight = F.struct("crowd", (-F.col("rep")).alias("r"), "set_key", "rep", "n", *more)
    return buckets.groupBy("key").agg(F.max(weight).alias("c")).select(
        "key", F.col("c.set_key").alias("a"), *[F.col(f"c.{x}").alias(f"{x}_a") for x in ("rep", "n", *more)]
    )


def _shared(classes: DataFrame) -> DataFrame:
    """(key, short, members): the band hashes that two classes and more have, with a short hash of each class that has them.

    All band hashes are shuffled here, once, for the count and for what is kept by it.
    """
    banded = classes.select(F.xxhash64("set_key").alias("short"), F.explode("bands").alias("key")).repartition("key")
    crowded = banded.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("short").alias("first"), F.max("short").alias("last")
    ).filter("first < last").select("key", "members")
    return banded.join(crowded.hint("shuffle_hash"), "key")


def _buckets(classes: DataFrame, bands: int) -> DataFrame:
    """(key, set_key, rep, n, members, band) of the buckets that hold two classes and more.

    Two classes of one short hash stand in each other's buckets too, where they are compared as any others.
    ``band`` follows from the bucket, which is all that is asked of it.
    """
    shared = materialize(_shared(classes))
    named = classes.select(F.xxhash64("set_key").alias("short"), "set_key", "rep", "n")
    band = F.pmod("key", F.lit(bands)).cast("int").alias("band")
    return shared.join(named, "short").select("key", "set_key", "rep", "n", "members", band)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int | None = None,
    rows: int | None = None,
    centres: int = CENTRES,
    small: int = SMALL,
) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) per row.

    ``component_id`` is the smallest id that can be reached by links, itself
    included; ``kept`` says that it is the row's own. NULL and empty texts and
    texts of white space have no shingles and are linked with nothing. Rows that
    repeat an id count as one document: they share their links. A NULL id links
    with nothing, has a NULL component and is kept. A very long text is one set like any other. An empty table gives an empty
    result; other columns are ignored. Ids must be integers. Without ``bands`` and ``rows`` they follow from ``percent``.
    """
    if bands is None or rows is None:
        bands, rows = band_plan(percent)
    signed = materialize(_signed(docs, id_col, text_col, words, bands, rows))
    usable = signed.filter(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    classes = materialize(
        usable.groupBy("set_key").agg(
            F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
        )
    )
    buckets = materialize(_buckets(classes, bands))
    crowd = materialize(buckets.groupBy("set_key").agg(F.sum("members").alias("crowd")))
    buckets = buckets.drop("members")
    centre = materialize(_centres(buckets.join(crowd, "set_key")))
    edges, candidates = compacted(_star(buckets, centre, percent), FEW_EDGES)
    parts = None
    if candidates:
        nodes = edges.select(F.col("rep_a").alias("rep")).union(edges.select(F.col("rep_b"))).distinct()
        links, _ = compacted(_confirmed(edges, _full_sets(docs, id_col, text_col, nodes, words), percent))
        parts = connected_components(links, "rep_a", "rep_b")
        # The first centre of a bucket has met all its classes.
        left = buckets.join(centre.select("key", "a"), "key").filter(F.col("set_key") != F.col("a")).drop("a")
        left, open_rows = compacted(_open(left, parts).drop("component", "main", "members").join(crowd, "set_key"))
        if open_rows:
            # The sets of these classes are written once for all that follows.
            sets, _ = compacted(_full_sets(docs, id_col, text_col, left.select("rep").distinct(), words), size=F.size("hashes"))
            refined = _refined(sets, bands, rows)
            left, _ = compacted(left.join(refined, "set_key").withColumn("further", F.slice("further", F.col("band") * LEVELS + 1, LEVELS)).drop("band"))
            left, parts, large = _split(left, parts, sets, percent, small, bands * rows)
            parts = _more_stars(left, parts, sets, percent, centres, bands * rows)
            parts = _by_prefix(large, parts, sets, percent)
    # A row's class stands for it; an id with several sets joins their classes.
    members = materialize(usable.join(classes.select("set_key", "rep"), "set_key").select("id", "rep"))
    firsts = members.groupBy("id").agg(F.min("rep").alias("rep"), F.max("rep").alias("last"))
    several = materialize(firsts.filter("rep <> last").select("id", F.col("rep").alias("first")))
    if not several.isEmpty():
        joined = members.join(several, "id").filter("rep <> first").select("first", "rep").distinct()
        parts = connected_components(joined, "first", "rep") if parts is None else merged_components(parts, joined, "first", "rep")
    found = firsts.select(F.col("id").alias("node"), "rep")
    if parts is not None:
        found = found.join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
            "node", F.coalesce("component", "rep").alias("rep")
        )
    return (
        signed.join(found, signed.id == found.node, "left")
        .select(
            F.col("id").alias(id_col), "n_shingles", F.coalesce("rep", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))
    )


def _split(left: DataFrame, parts: DataFrame, sets: DataFrame, percent: int, small: int, bins: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is left when buckets are split by further bins, level by level, until they are small; the components by then; and the large buckets uncut.

    A split parts classes that no star has joined, and a sketch may lose a pair; ``_by_prefix`` looks at the uncut buckets for those.
    """
    rest, uncut = [], None
    for level in range(LEVELS):
        open_, _ = compacted(_open(left, parts).select(*left.columns, "members"))
        rest.append(open_.filter(F.col("members") <= small).drop("members"))
        large = open_.filter(F.col("members") > small).drop("members")
        uncut = large if uncut is None else uncut
        if large.isEmpty():
            left = None
            break
        keyed = large.withColumn("key", F.xxhash64("key", F.lit(level), F.col("further")[level]))
        shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > 1).select("key")
        buckets, _ = compacted(keyed.join(shared, "key"))
        centre, _ = compacted(_centres(buckets, "sketch"))
        edges, candidates = compacted(_star(buckets, centre, percent, _alike(percent, bins)), FEW_EDGES)
        more, links = compacted(_confirmed(edges, _of_edges(sets, edges, candidates), percent)) if candidates else (edges, 0)
        if links:
            parts = merged_components(parts, more, "rep_a", "rep_b")
        left = buckets.join(centre.select("key", "a"), "key").filter(F.col("set_key") != F.col("a")).drop("a")
    if left is not None:
        rest.append(left)
    out = rest[0]
    for part in rest[1:]:
        out = out.unionByName(part)
    return out.drop("further"), parts, uncut


def _by_prefix(large: DataFrame, parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components with every link between classes of the ``large`` buckets that still hold several components.

    An exact join of the full sets. Each set is put in one order: shingles of one component alone first,
    then the others by frequency. Two near sets of different components first meet in a shingle
    behind which both still hold as many as they must have in common, which only the front of a set's
    other shingles can be; the smaller set's front is shorter still. Sets that meet there are confirmed. A shingle of many fronts is
    joined in blocks of ``BLOCK`` smaller sets.
    """
    open_, rows = compacted(_open(large, parts).select("set_key", "rep", "n", "component").distinct(), size=F.col("n"))
    if not rows:
        return parts
    held = open_.join(sets, "set_key").select("set_key", "component", F.explode("hashes").alias("shingle"))
    shared = held.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("often"), F.min("component").alias("first"), F.max("component").alias("last")
    ).filter("first < last").select("shingle", "often")
    ordered = held.join(shared, "shingle").groupBy("set_key").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("order"))
    front = F.size("order") - F.ceil(percent * F.col("n") / 100).cast("int") + 1
    fronts = ordered.join(open_, "set_key").withColumn("front", front).filter("front > 0").select(
        "set_key", "rep", "n", "component", F.size("order").alias("size"), F.posexplode(F.slice("order", 1, F.col("front"))).alias("at", "s")
    )
    behind = F.col("size") - F.col("at")
    ends = materialize(fronts.select(
        F.col("s.shingle").alias("shingle"), "set_key", "rep", "n", "component", behind.alias("behind"),
        ((100 + percent) * behind >= 2 * percent * F.col("n")).alias("smaller"),
    ))
    met = ends.groupBy("shingle").agg(
        F.count_if("smaller").alias("smaller_sets"), F.min("component").alias("first"), F.max("component").alias("last")
    ).filter("smaller_sets > 0 AND first < last").select("shingle", F.ceil(F.col("smaller_sets") / BLOCK).alias("blocks"))
    ends = ends.join(met, "shingle")
    few = ends.filter("smaller").select(
        "shingle", F.pmod(F.xxhash64("set_key"), "blocks").alias("block"), F.col("set_key").alias("a"), F.col("rep").alias("rep_a"),
        F.col("n").alias("n_a"), F.col("component").alias("component_a"), F.col("behind").alias("behind_a"),
    )
    all_ = ends.select(
        "shingle", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("set_key").alias("b"),
        F.col("rep").alias("rep_b"), F.col("n").alias("n_b"), "component", "behind",
    )
    pairs = few.join(all_, ["shingle", "block"]).filter(
        (F.col("component_a") != F.col("component"))
        & ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))))
        & ((100 + percent) * F.least("behind_a", "behind") >= percent * (F.col("n_a") + F.col("n_b")))
    )
    edges, candidates = compacted(pairs.select("a", "b", "rep_a", "rep_b", "n_a", "n_b").distinct(), FEW_EDGES)
    more, links = compacted(_confirmed(edges, _of_edges(sets, edges, candidates), percent)) if candidates else (edges, 0)
    return merged_components(parts, more, "rep_a", "rep_b") if links else parts


def _more_stars(left: DataFrame, parts: DataFrame, sets: DataFrame, percent: int, centres: int, bins: int) -> DataFrame:
    """Components with the links that further stars find in what is ``left`` of the buckets.

    A class that was chosen is a centre in all its buckets that still hold several
    components and then leaves them. Its buckets hold what it was not compared with
    only if that is connected to it, so nothing is compared in vain later on.
    """
    by_crowd = Window.partitionBy("key").orderBy(F.desc("crowd"), "rep", "set_key")
    while True:
        open_, rows = compacted(_open(left, parts))
        if not rows:
            return parts
        chosen = open_.filter("component <> main").withColumn("_r", F.row_number().over(by_crowd)).filter(
            F.col("_r") <= centres
        ).select("set_key", F.lit(True).alias("centre")).distinct()
        marked, _ = compacted(open_.join(chosen, "set_key", "left"))
        ends = marked.select("key", F.col("set_key").alias("b"), F.col("rep").alias("rep_b"), "n", "component", "centre", "sketch")
        stars = marked.filter("centre").select(
            "key", F.col("set_key").alias("a"), F.col("rep").alias("rep_a"), F.col("n").alias("n_a"),
            F.col("component").alias("component_a"), F.col("sketch").alias("sketch_a"),
        )
        edges, candidates = compacted(
            ends.join(stars, "key").filter(
                (F.col("component") != F.col("component_a"))
                & (F.col("centre").isNull() | (F.col("a") < F.col("b")))
                & (100 * F.least("n_a", "n") >= percent * F.greatest("n_a", "n"))
                & _alike(percent, bins)
            ).select("a", "b", "rep_a", "rep_b", "n_a", F.col("n").alias("n_b")).distinct(),
            FEW_EDGES,
        )
        more, links = compacted(_confirmed(edges, _of_edges(sets, edges, candidates), percent)) if candidates else (edges, 0)
        if links:
            parts = merged_components(parts, more, "rep_a", "rep_b")
        left = marked.filter("centre IS NULL").select("key", "set_key", "rep", "n", "crowd", "sketch")
        centres *= 4
