"""Best-fit packing by patterns fitted with non-negative least squares.

Texts are tokenised and cut into pieces of at most ``capacity`` tokens. The
histogram of piece lengths (``capacity`` numbers at most) is all that reaches the
driver. Lengths are taken in units of ``unit`` tokens; every combination of up to
``max_parts`` units that fills a sequence is a pattern, and non-negative least
squares says how often each should repeat to use up the histogram. The repeats
are rounded down and filled with exact lengths, the last place of a pattern with
the longest piece that still fits; what is left is packed best-fit, longest first.

Scale: the plan is a list of (length, from rank, to rank, sequences), at most a few
per length and pattern, whatever the size of the corpus. Pieces are written once. Only
their row number, length and order are ranked, from counts per (length, slice) and a row number within the
slice, so a length that most documents share is spread over many tasks; the places are joined to the pieces by row number.
Workers yield batches of ``BATCH_BYTES`` of ids and remember words up to ``CACHE_BYTES``.
"""

from __future__ import annotations

import bisect
import json
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridtide.llm.common import id_and_bytes, load_tokenizer, ship_package, special_strings, splitter
from gridtide.session import materialize

CAPACITY = 4096
END_ID = 1
UNIT = 64
MAX_PARTS = 4
SLICE_ROWS = 5_000
CACHE_BYTES = 48 << 20
BATCH_BYTES = 4 << 20
# What an entry of a cache takes beside its two byte strings, about.
_ENTRY_BYTES = 170

PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long"


# A vocabulary of this shape makes the pre-tokens of ``_PRETOKEN`` out of ASCII and letters of Latin-1: those are composed
# already and have one small letter each. Pre-tokens go to the model byte by byte.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xDF-\xF6\xF8-\xFF]+|[0-9]|[^\x09-\x0D\x20a-z0-9\xDF-\xF6\xF8-\xFF]+")
_OTHERS = re.compile(r"[^\x00-\x7F\xC0-\xD6\xD8-\xF6\xF8-\xFF]")
# The characters that stand for bytes: the bytes' own if they can be seen, else the next from U+0100 on.
_SEEN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LEVEL = dict(zip((b for b in range(256) if b not in _SEEN), range(256, 512)))


class _Cache(dict):
    """Byte strings by strings, emptied when it holds ``CACHE_BYTES``."""

    held = 0

    def put(self, key: bytes | str, value: bytes) -> None:
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        self[key] = value
        self.held += len(key) + len(value) + _ENTRY_BYTES


class WordIds:
    """Ids of the words of a text as little-endian 32-bit bytes, each distinct word tokenised once.

    For vocabularies that write all letters small and whose pre-tokens hold no white space and end
    between a letter or digit and a sign: then the ids of a text are those of its words, and of their signs, in turn. Others are refused.
    """

    def __init__(self, name: str, path: str | None):
        self.tokenizer = load_tokenizer(name, path)
        self.special = {s.encode(): np.uint32(i).tobytes() for s, i in special_strings(self.tokenizer).items()}
        self.cut = splitter(s.decode() for s in self.special)
        self.words, self.stems = _Cache(), _Cache()
        probe = self._encode("a b")
        if probe != self._encode("a") + self._encode(" \n b "):
            raise ValueError("the vocabulary does not drop white space")
        if any(self._encode(w) != self._encode(w.lower()) for w in ("THE", "Zebra", "QxY")):
            raise ValueError("the vocabulary tells capitals from small letters")
        if any(self._encode("the" + s) != self._encode("the") + self._encode(s) for s in (".,", "!?", ";:", "#*", "$%", "&|", "<>")):
            raise ValueError("the vocabulary does not part words from signs")
        # Plain lower-case letters are one pre-token, which the model can take at once.
        self.plain = np.array([t.id for t in self.tokenizer.model.tokenize("zebra")], "<u4").tobytes() == self._encode("zebra")
        self.pretokens = _Pretokens(self.tokenizer.model) if self._is_plain_shape() else None

    def _is_plain_shape(self) -> bool:
        """Whether the vocabulary is of the shape that ``_PRETOKEN`` is for."""
        said = json.loads(self.tokenizer.to_str())
        split = {"type": "Split", "pattern": {"Regex": _PIECES}, "behavior": "Removed", "invert": True}
        levels = (said["pre_tokenizer"] or {}).get("pretokenizers", [])
        return (
            (said["normalizer"] or {}).get("normalizers") == _NORMAL and len(levels) == 2 and levels[0] == split
            and levels[1]["type"] == "ByteLevel" and not levels[1]["add_prefix_space"] and not levels[1]["use_regex"]
            and said["post_processor"] is None and said["truncation"] is None and said["padding"] is None
            and said["model"]["type"] == "BPE" and not said["model"]["dropout"]
        )

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _stem(self, stem: bytes) -> bytes:
        found = self.stems.get(stem)
        if found is None:
            if self.plain and stem.isascii() and stem.isalpha() and stem.islower():
                found = np.array([t.id for t in self.tokenizer.model.tokenize(stem.decode())], "<u4").tobytes()
            else:
                found = self._encode(stem.decode())
            self.stems.put(stem, found)
        return found

    def _word(self, word: bytes) -> bytes:
        if not word.isascii():
            return self._stem(word)
        lower = word.lower()
        stem = lower.rstrip(b".,;:!?#*$%&|<>")
        # Between a letter or digit and a sign pre-tokens always end.
        if stem and len(stem) < len(lower) and stem[-1:].isalnum():
            return self._stem(stem) + self._stem(lower[len(stem):])
        return self._stem(lower)

    def _words(self, text: bytes) -> bytes:
        if self.pretokens is not None and (text.isascii() or not _OTHERS.search(text.decode())):
            return b"".join(map(self.pretokens.__getitem__, _PRETOKEN.findall(text.decode().lower())))
        parts, known = text.split(), self.words
        try:
            return b"".join([known[w] for w in parts])
        except KeyError:
            out = []
            for w in parts:
                found = known.get(w)
                if found is None:
                    known.put(w, found := self._word(w))
                out.append(found)
            return b"".join(out)

    def ids(self, text: bytes) -> bytes:
        if self.cut is None or not any(s in text for s in self.special):
            return self._words(text)
        parts = (p.encode() for p in self.cut.split(text.decode()))
        return b"".join(self.special[p] if p in self.special else self._words(p) for p in parts)


class _Pretokens(_Cache):
    """Ids by pre-token, from the model alone."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize

    def __missing__(self, pretoken: str) -> bytes:
        written = pretoken.encode().decode("latin-1").translate(_BYTE_LEVEL)
        ids = [t.id for t in self.tokenize(written)]
        self.put(pretoken, found := struct.pack(f"<{len(ids)}I", *ids))
        return found


_loaded: dict[tuple[str, str | None], WordIds] = {}


def word_ids(name: str, path: str | None) -> WordIds:
    if (name, path) not in _loaded:
        _loaded[name, path] = WordIds(name, path)
    return _loaded[name, path]


def tokenised_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32[, ids]): token ids and the end mark, cut at ``capacity``.

    A NULL or empty text is the end mark alone.
    """
    end = np.uint32(end_id).tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_ids(tokenizer, path)
        for batch in batches:
            rows, pieces, starts, lengths, crcs, ids = [], [], [], [], [], []
            size = 0

            def made() -> pa.RecordBatch:
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                ]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
                    names.append("ids")
                for listed in (rows, pieces, starts, lengths, crcs, ids):
                    listed.clear()
                return pa.RecordBatch.from_arrays(columns, names=names)

            for row, raw in enumerate(batch.column(1)):
                data = tokens.ids(raw.as_py() or b"") + end
                for i, at in enumerate(range(0, len(data), step)):
                    part = data[at:at + step]
                    rows.append(row)
                    pieces.append(i)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    crcs.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
                    size += len(part)
                    if size >= BATCH_BYTES:
                        yield made()
                        size = 0
            if rows:
                yield made()

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, {PIECE_SCHEMA}" + ", ids array<int>" * with_ids
    return id_and_bytes(docs, id_col, text_col).mapInArrow(cut, schema).withColumnRenamed("id", id_col)


def patterns(units: int, max_parts: int) -> list[tuple[int, ...]]:
    """All ways to fill ``units`` with at most ``max_parts`` parts, parts in falling order."""
    out = []

    def grow(left: int, most: int, parts: tuple[int, ...]) -> None:
        if left == 0:
            out.append(parts)
        elif len(parts) < max_parts:
            for p in range(min(left, most), 0, -1):
                if p * (max_parts - len(parts)) >= left:
                    grow(left - p, p, (*parts, p))

    grow(units, units, ())
    return out


def nnls(a: np.ndarray, b: np.ndarray, steps: int = 3000) -> np.ndarray:
    """x >= 0 that makes ``|a x - b|`` small: accelerated projected gradient steps."""
    x = y = np.zeros(a.shape[1])
    scale = 1.0 / max(np.linalg.norm(a, 2) ** 2, 1e-12)
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - scale * (a.T @ (a @ y - b)))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        step = new - x
        if step @ (y - new) > 0:  # the momentum points uphill: start it anew
            t_new = 1.0
        y = new + (t - 1) / t_new * step
        x, t = new, t_new
    return x


class _Supply:
    """Counts by exact length, with the longest length that fits a space."""

    def __init__(self, histogram: dict[int, int]):
        self.left = {k: int(v) for k, v in histogram.items() if v > 0}
        self.keys = sorted(self.left)

    def longest(self, space: int, least: int = 1) -> int | None:
        i = bisect.bisect_right(self.keys, space) - 1
        return self.keys[i] if i >= 0 and self.keys[i] >= least else None

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.keys.pop(bisect.bisect_left(self.keys, length))


def _most(parts: list[int], supply: _Supply) -> int:
    return min(supply.left[p] // parts.count(p) for p in set(parts))


def plan_packing(
    histogram: dict[int, int], capacity: int = CAPACITY, unit: int = UNIT, max_parts: int = MAX_PARTS
) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths that share a sequence, number of such sequences)] that use up the histogram."""
    supply, plan = _Supply(histogram), []

    def put(parts: list[int], n: int) -> None:
        for p in parts:
            supply.take(p, n)
        plan.append((tuple(parts), n))

    if full := supply.left.get(capacity):
        put([capacity], full)
    units = -(-capacity // unit)
    rounded = np.zeros(units)
    for length, n in supply.left.items():
        rounded[-(-length // unit) - 1] += n
    if rounded.any():
        ways = [p for p in patterns(units, max_parts) if len(p) > 1]
        a = np.zeros((units, len(ways)))
        for j, way in enumerate(ways):
            for p in way:
                a[p - 1, j] += 1
        scale = rounded.max()
        # Long pieces have fewer places to go, so their misfit weighs more.
        weight = np.sqrt(np.arange(1, units + 1) / units)[:, None]
        repeats = np.floor(nnls(a * weight, (rounded / scale) * weight[:, 0]) * scale + 1e-9).astype(np.int64)
        for j in np.argsort([-w[0] for w in ways], kind="stable"):
            left = int(repeats[j])
            while left > 0:
                parts, space, used = [], capacity, defaultdict(int)
                for i, p in enumerate(ways[j]):
                    last = i == len(ways[j]) - 1
                    length = supply.longest(space if last else p * unit, 1 if last else (p - 1) * unit + 1)
                    if length is None or used[length] >= supply.left[length]:
                        break
                    parts.append(length)
                    used[length] += 1
                    space -= length
                if len(parts) < len(ways[j]):
                    break
                n = min(left, _most(parts, supply))
                put(parts, n)
                left -= n
    while supply.keys:
        parts, space = [], capacity
        used: dict[int, int] = defaultdict(int)
        length = supply.longest(space)
        while length is not None:
            parts.append(length)
            used[length] += 1
            space -= length
            length = supply.longest(space)
            while length is not None and used[length] >= supply.left[length]:
                length = supply.longest(length - 1)
        put(parts, _most(parts, supply))
    return plan


def _places(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, offset), sorted by rank."""
    by_length: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for parts, n in plan:
        offset = 0
        for p in parts:
            by_length[p].append((taken[p], sequence, offset))
            taken[p] += n
            offset += p
        sequence += n
    return {k: np.array(v, np.int64) for k, v in by_length.items()}


def ranked(pieces: DataFrame, order: list[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``pieces`` with their rank (from 0) within their length.

    The number of slices follows from the largest count, so no slice holds much
    more than ``slice_rows`` rows; their counts, not their rows, are added up.
    """
    largest = pieces.groupBy("length").count().agg(F.max("count")).first()[0] or 0
    slices = -(-largest // slice_rows) or 1
    cut = pieces.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    counts = cut.groupBy("length", "_slice").count()
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "length", "_slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("length", "_slice").orderBy(*order)
    numbered = cut.withColumn("_n", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["length", "_slice"]).withColumn(
        "rank", F.col("_before") + F.col("_n")
    ).drop("_slice", "_n", "_before")


def pack(
    pieces: DataFrame, order: list[str], capacity: int = CAPACITY, unit: int = UNIT, max_parts: int = MAX_PARTS
) -> DataFrame:
    """``pieces`` (with ``length`` of 1 to ``capacity``) and their ``sequence_id`` and ``offset``.

    ``order`` are columns that tell pieces apart; rows equal in all of them are
    interchangeable. The columns of ``pieces`` are kept. An empty table gives an
    empty result.
    """
    ship_package(pieces.sparkSession)
    if "_row" in pieces.columns:
        raise ValueError("there is a column _row already")
    # The row number is fixed once it is written.
    pieces = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()))
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    if any(k is None or k < 1 or k > capacity for k in histogram):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    places = pieces.sparkSession.sparkContext.broadcast(_places(plan_packing(histogram, capacity, unit, max_parts)))
    frame = ranked(pieces.select("_row", "length", *order), order).select("_row", "length", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = places.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                runs = table[int(length)]
                run = np.searchsorted(runs[:, 0], ranks[rows], "right") - 1
                sequence[rows] = runs[run, 1] + ranks[rows] - runs[run, 0]
                offset[rows] = runs[run, 2]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(sequence), pa.array(offset)], names=["_row", "sequence_id", "offset"])

    placed = frame.mapInArrow(place, "_row long, sequence_id long, offset long")
    return pieces.join(placed, "_row").drop("_row")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, **options) -> DataFrame:
    """Documents to packed pieces: (id_col, piece, start, length, ids_crc32[, ids], sequence_id, offset).

    NULL and empty texts are one end mark, texts longer than ``capacity`` are cut into pieces of it. Every row is packed, repeated rows and
    NULL ids as well; other columns are ignored. ``options`` go to ``tokenised_pieces``.
    """
    capacity = options.get("capacity", CAPACITY)
    pieces = tokenised_pieces(docs, id_col, text_col, with_ids=with_ids, **options)
    return pack(pieces, [id_col, "piece", "ids_crc32"], capacity)
