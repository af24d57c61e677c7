"""Byte-level BPE encoding and decoding, by a rank queue over a hierarchical bitmap.

A text falls into pre-tokens (the matches of the vocabulary's pattern). Pre-tokens a
worker has not met are laid end to end, with barriers between them, as one linked list
of byte tokens. Every neighbouring pair that the vocabulary can merge stands in the
bucket of its merge rank, by its position in the list. A bitmap, with bitmaps of its
words above it, says which buckets hold anything; its first set bit is the next rank to
merge. A merge changes the two pairs beside it, which go to the buckets of their new
ranks; what they leave behind in old buckets is stale and is skipped when met. A list of
m bytes costs O(m log m) however long a single pre-token is.

Scale: texts are read once and nothing is shuffled. A worker remembers pre-tokens up to
``CACHE_BYTES`` and returns ids in batches of ``BATCH_IDS``.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from gridtide.llm.common import id_and_bytes, ship_package
from gridtide.llm.tokens import WHITE_SPACE

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK_BYTES = 1 << 20
CACHE_BYTES = 80 << 20
TEXT_BYTES = 1 << 20
BATCH_IDS = 1 << 18
# What an entry of the cache takes beside its two byte strings, about.
_ENTRY_BYTES = 220

_WORD_BITS = 8
_PAIR_BITS = 24
_BARRIER = -1
_NO_RANK = 1 << _PAIR_BITS
# From so many positions on a bucket is worked on as arrays.
_FEW = 24

# White space and what follows it up to the next white space. No pre-token crosses the end of a chunk.
_CHUNK = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")


class RankQueue:
    """Buckets of positions by rank, with a hierarchical bitmap of the ranks whose bucket holds something."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []
        n = ranks
        while True:
            n = (n + (1 << _WORD_BITS) - 1) >> _WORD_BITS
            self.levels.append([0] * n)
            if n <= 1:
                break

    def open(self, rank: int, positions: list[int]) -> None:
        """A new bucket; one that is there takes positions by itself."""
        self.buckets[rank] = positions
        for level in self.levels:
            word, bit = rank >> _WORD_BITS, rank & ((1 << _WORD_BITS) - 1)
            before = level[word]
            level[word] = before | (1 << bit)
            if before:
                return
            rank = word

    def first(self) -> int | None:
        """The least rank whose bucket holds something."""
        word = 0
        for level in reversed(self.levels):
            bits = level[word]
            if not bits:
                return None
            word = (word << _WORD_BITS) + (bits & -bits).bit_length() - 1
        return word

    def take(self, rank: int) -> list[int]:
        """The bucket's positions from left to right; the bucket is gone."""
        at = rank
        for level in self.levels:
            word, bit = at >> _WORD_BITS, at & ((1 << _WORD_BITS) - 1)
            level[word] &= ~(1 << bit)
            if level[word]:
                break
            at = word
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return bucket


def read_ranks(name: str, path: str | None) -> dict[bytes, int]:
    """Byte strings and their ranks, from ``path`` or from the public vocabulary files by name."""
    import public_tokenizers

    with open(path or public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class BytePairs:
    """A vocabulary of byte strings with ranks, which are also their ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        if max(ranks.values()) >= 1 << _PAIR_BITS:
            raise ValueError("the vocabulary's ranks are too large")
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.byte_pairs = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int32)
        # (left, right) -> rank of both together, for every cut of every token into two tokens
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << _PAIR_BITS | right] = rank
        # The same for many pairs at once; a key above all others keeps it from being empty.
        self.pair_keys = np.array([*sorted(self.pairs), np.iinfo(np.int64).max], np.int64)
        self.pair_ranks = np.array([self.pairs.get(k, -1) for k in self.pair_keys.tolist()], np.int64)
        # `\s` means the characters with the property White_Space, whatever the pattern's engine takes it for.
        spaces = f"[{WHITE_SPACE}]"
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"\s", spaces).replace(r"\S", f"[^{WHITE_SPACE}]"))

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if it is none."""
        keys = left << _PAIR_BITS | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit bytes; all merged in one linked list."""
        line = _Line(self, pieces)
        while (rank := line.queue.first()) is not None:
            positions = line.queue.take(rank)
            if len(positions) < _FEW:
                line.merge_in_turn(rank, positions)
            else:
                line.merge_at_once(rank, positions)
        return line.ids()


class _Line:
    """Pieces as one linked list of tokens, with their pairs in a rank queue.

    The arrays are worked on whole for buckets of many positions and through their memory views,
    which are as quick as lists, for buckets of few.
    """

    def __init__(self, vocabulary: BytePairs, pieces: list[bytes]):
        self.vocabulary = vocabulary
        # A barrier after every piece; it is no token, so no pair holds it.
        self.ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        raw = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8)
        n = len(raw)
        self.token = vocabulary.single[raw]
        self.token[self.ends] = _BARRIER
        found = vocabulary.byte_pairs[raw[:-1], raw[1:]].astype(np.int64)
        found[self.ends[:-1]] = -1
        found[self.ends - 1] = -1
        self.rank_at = np.append(found, -1)
        self.after, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        self.queue = RankQueue(vocabulary.size)
        self._push(np.flatnonzero(self.rank_at >= 0))
        self.views = tuple(map(memoryview, (self.token, self.rank_at, self.after, self.before)))

    def _push(self, positions: np.ndarray) -> None:
        """Positions to the buckets of the ranks they have now."""
        ranks = self.rank_at[positions]
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        bounds = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        listed, buckets = positions.tolist(), self.queue.buckets
        for a, b in zip(bounds, bounds[1:]):
            if a < b:
                rank = int(ranks[a])
                if rank in buckets:
                    buckets[rank] += listed[a:b]
                else:
                    self.queue.open(rank, listed[a:b])

    def merge_in_turn(self, rank: int, positions: list[int]) -> None:
        """Merge the pairs of this rank from left to right, as far as no pair of the same or a lower rank appears."""
        token, rank_at, after, before = self.views
        pair, buckets, open_ = self.vocabulary.pairs.get, self.queue.buckets, self.queue.open
        for at, i in enumerate(positions):
            if rank_at[i] != rank:
                continue  # stale
            j = after[i]
            k = after[j]
            h = before[i]
            token[i] = rank
            token[j] = rank_at[j] = -1
            after[i] = k
            before[k] = i
            least = _NO_RANK
            new = pair(rank << _PAIR_BITS | token[k], -1)
            rank_at[i] = new
            if new >= 0:
                if new in buckets:
                    buckets[new].append(i)
                else:
                    open_(new, [i])
                least = new
            if h >= 0:
                new = pair(token[h] << _PAIR_BITS | rank, -1)
                rank_at[h] = new
                if new >= 0:
                    if new in buckets:
                        buckets[new].append(h)
                    else:
                        open_(new, [h])
                    if new < least:
                        least = new
            if least <= rank:  # comes before the rest of this bucket
                rest = positions[at + 1:]
                if rank in buckets:
                    buckets[rank] += rest
                elif rest:
                    open_(rank, rest)
                return

    def merge_at_once(self, rank: int, positions: list[int]) -> None:
        """The same for many positions: those that do not touch each other in one go, unless a pair appears that comes first."""
        token, lookup = self.token, self.vocabulary.ranks_of
        i = np.array(positions)
        fresh = self.rank_at[i] == rank
        fresh[1:] &= i[1:] != i[:-1]
        i = i[fresh]
        if not len(i):
            return
        j = self.after[i]
        k = self.after[j]
        h = self.before[i]
        right = lookup(np.int64(rank), token[k])
        left = np.where(h >= 0, lookup(token[h], np.int64(rank)), -1)
        near = (j[:-1] == i[1:]) | (k[:-1] == i[1:])
        early = ((right >= 0) & (right <= rank)) | ((left >= 0) & (left <= rank))
        if early.any() or (near.any() and 0 <= self.vocabulary.pairs.get(rank << _PAIR_BITS | rank, -1) <= rank):
            self.merge_in_turn(rank, i.tolist())
            return
        if near.any():
            touching = np.append(near, False)
            touching[1:] |= near
            self.merge_in_turn(rank, i[touching].tolist())
            alone = ~touching
            # A neighbour of what was merged in turn may have got another token.
            i, j, k, h = i[alone], j[alone], k[alone], self.before[i[alone]]
            right = lookup(np.int64(rank), token[k])
            left = np.where(h >= 0, lookup(token[h], np.int64(rank)), -1)
        token[i] = rank
        token[j] = -1
        self.rank_at[j] = -1
        self.after[i] = k
        self.before[k] = i
        self.rank_at[i] = right
        inner = h >= 0
        self.rank_at[h[inner]] = left[inner]
        self._push(np.concatenate([i[right >= 0], h[left >= 0]]))

    def ids(self) -> list[bytes]:
        # What was merged away is -1 as well; barriers are those at the ends of pieces.
        alive = self.token >= 0
        bounds = np.cumsum(alive)[self.ends].tolist()
        found = self.token[alive].astype("<i4").tobytes()
        return [found[4 * a:4 * b] for a, b in zip([0, *bounds], bounds)]


class Encoder:
    """Texts to ids, remembering the ids of chunks.

    What is remembered lies in two generations. When the younger is full the older is
    forgotten, so chunks that keep coming stay.
    """

    def __init__(self, vocabulary: BytePairs):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks, as little-endian 32-bit bytes."""
        ranks, split = self.vocabulary.ranks, self.vocabulary.pattern.findall
        learnt: dict[str, bytes] = {}
        single: dict[str, bytes] = {}
        several: dict[str, list[bytes]] = {}
        for chunk in chunks:
            # Letters with at most a blank before them are one pre-token.
            if chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha()):
                piece = chunk.encode()
            else:
                pieces = [p.encode() for p in split(chunk)]
                if len(pieces) > 1:
                    several[chunk] = pieces
                    continue
                piece = pieces[0]
            rank = ranks.get(piece)
            if rank is None:
                single[chunk] = piece
            else:
                learnt[chunk] = rank.to_bytes(4, "little")
        found: dict[bytes, bytes] = {}
        block = set(single.values())
        for pieces in several.values():
            for piece in pieces:
                rank = ranks.get(piece)
                if rank is None:
                    block.add(piece)
                else:
                    found[piece] = rank.to_bytes(4, "little")
        listed = list(block)
        for a, b in _spans(list(map(len, listed)), BLOCK_BYTES):
            found.update(zip(listed[a:b], self.vocabulary.merge(listed[a:b])))
        learnt.update(zip(single, map(found.__getitem__, single.values())))
        for chunk, pieces in several.items():
            learnt[chunk] = b"".join([found[p] for p in pieces])
        return learnt

    def _remember(self, found: dict[str, bytes]) -> None:
        if self.held > CACHE_BYTES // 2:
            self.older, self.known, self.held = self.known, {}, 0
        self.known.update(found)
        self.held += sum(map(len, found)) + sum(map(len, found.values())) + _ENTRY_BYTES * len(found)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit bytes."""
        cut = [_CHUNK.findall(t) for t in texts]
        missing = set().union(*cut).difference(self.known)
        if missing:
            again = {c: self.older[c] for c in missing if c in self.older}
            self._remember(again | self._learn([c for c in missing if c not in again]))
        known, older = self.known, self.older
        try:
            return [b"".join(map(known.__getitem__, chunks)) for chunks in cut]
        except KeyError:  # the generations have just changed
            return [b"".join([known[c] if c in known else older[c] for c in chunks]) for chunks in cut]


# One per worker and vocabulary, so that what a worker has learnt serves its next task.
_loaded: dict[tuple[str, str | None, str | None], Encoder] = {}


def encoder(name: str, path: str | None, pattern: str | None) -> Encoder:
    key = (name, path, pattern)
    if key not in _loaded:
        import public_tokenizers

        _loaded[key] = Encoder(BytePairs(read_ranks(name, path), pattern or public_tokenizers.PATTERN))
    return _loaded[key]


def _spans(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes come to at most ``most``; a larger row is a run of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _lists(column: pa.ListArray) -> Iterator[list[int] | None]:
    """The lists of a column, without an object of Arrow for each number."""
    offsets = column.offsets.to_pylist()
    numbers = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    listed = numbers.to_pylist() if numbers.null_count else numbers.to_numpy().tolist()
    for a, b, valid in zip(offsets, offsets[1:], column.is_valid().to_pylist()):
        yield listed[a - offsets[0]:b - offsets[0]] if valid else None


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    path: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """(id_col, n_tokens, ids) of every row; ``path`` and ``pattern`` default to the public vocabulary and its pattern.

    NULL and empty texts have no ids. Rows with a NULL or repeated id, and repeated
    rows, are encoded each for itself; a text of any length is encoded whole, also if it
    is one pre-token. Other columns are ignored. An empty table gives an empty result.
    Special strings in a text are ordinary text.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary, path, pattern)
        for batch in batches:
            texts = batch.column(1)
            sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in texts]
            for a, b in _spans(sizes, TEXT_BYTES):
                found = bpe.encode([(t or b"").decode() for t in texts.slice(a, b - a).to_pylist()])
                counts = np.array([len(f) // 4 for f in found], np.int64)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts), ids], names=["id", "n_tokens", "ids"])

    id_type = docs.schema[id_col].dataType.simpleString()
    read = id_and_bytes(docs, id_col, text_col)
    return read.mapInArrow(encode, f"id {id_type}, n_tokens long, ids array<int>").withColumnRenamed("id", id_col)


def decode_ids(
    encoded: DataFrame,
    ids_col: str = "ids",
    out_col: str = "decoded",
    vocabulary: str = VOCABULARY,
    path: str | None = None,
) -> DataFrame:
    """``encoded`` with the bytes that each row's ids stand for in ``out_col``, which must be a new name.

    NULL ids give NULL, no ids no bytes. Bytes need not be text: ids may stop inside a
    character. An id that the vocabulary lacks, or a NULL among the ids, is an error.
    """
    if out_col in encoded.columns:
        raise ValueError(f"there is a column {out_col} already")
    ship_package(encoded.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        string = {rank: token for token, rank in read_ranks(vocabulary, path).items()}.__getitem__
        for batch in batches:
            column = batch.column(ids_col)
            sizes = [4 * len(x) if x.is_valid else 0 for x in column]
            for a, b in _spans(sizes, 4 * BATCH_IDS):
                rows = [None if ids is None else b"".join(map(string, ids)) for ids in _lists(column.slice(a, b - a))]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(rows, pa.binary())], names=[*batch.schema.names, out_col])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in encoded.dtypes), f"`{out_col}` binary"])
    return encoded.mapInArrow(decode, schema)


def digest(ids_col: str = "ids"):
    """SHA-256 of the decimal ids joined by one space, in lower-case hex."""
    return F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), " ").cast("binary"), 256)
