"""Hard-negative mining by slots between the positives' scores.

For every anchor its first positives are found. Each positive opens a window of scores,
from ``percent`` per cent of its own score up to it, and wants the best negatives in it.
Windows of one anchor overlap, so they are not searched one by one: the positives' scores,
the windows' upper limits, cut all scores into disjoint slots. A task keeps the top k
of every (anchor, slot) it sees, tasks' lists are combined to the top k, and the lists of
an anchor from slot j downwards, laid one after the other, are the best scores up to
limit j, of which the first k inside the window are the answer of positive j.

Scale: anchors go out in blocks of at most ``ANCHOR_CELLS`` numbers, each block is
scored against all rows where they lie, in matrix products. A block's rows are read twice,
for positives and for negatives, and are never shuffled; what is shuffled is k rows for each
anchor, slot and task. The work is anchors times rows, which is what is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridtide.llm.common import ship_package
from gridtide.session import materialize

POSITIVES = 5
NEGATIVES = 5
PERCENT = 80
STEPS = 256
# Numbers in the anchors that are broadcast at once (32 MB as doubles), and in one product of scores.
ANCHOR_CELLS = 4 << 20
SCORE_CELLS = 2 << 20
# Whole numbers up to here are exact as doubles, in any order of adding.
_EXACT = 1 << 53

_TOP_SCHEMA = "anchor int, slot int, score long, vec_id long"


def eligible(vectors: DataFrame, id_col: str, label: Column, vector_col: str, steps: int = STEPS) -> DataFrame:
    """(vec_id, label, v): rows that take part, components in whole steps of ``1 / steps``.

    Left out are rows with a NULL id, label or vector, and vectors with a NULL or
    non-finite component.
    """
    x = F.col(vector_col)
    finite = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(steps)) * c.cast("double")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), x.alias("_x")).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("_x").isNotNull()
    ).withColumnRenamed("_x", vector_col).filter(finite).select("vec_id", "label", whole.alias("v"))


class _Block:
    """Anchors of one block, by the length of their vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]):
        self.ids, self.labels = ids, labels
        sizes = np.array([len(v) for v in vectors], np.int64)
        self.by_size = {
            int(s): (at := np.flatnonzero(sizes == s), np.array([vectors[i] for i in at], np.int64).reshape(len(at), s))
            for s in np.unique(sizes)
        }


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of their vectors) of the vectors of each length."""
    column = batch.column("v")
    offsets = np.asarray(column.offsets)
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for s in np.unique(sizes):
        rows = np.flatnonzero(sizes == s)
        yield rows, flat[offsets[rows][:, None] + np.arange(s)[None, :]].reshape(len(rows), s)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact whole inner products of the rows of ``a`` with those of ``b``."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 62:
        return a @ b.T
    raise ArithmeticError("inner products pass 64 bits")


def _first(anchor, slot, score, vec_id, k: int) -> np.ndarray:
    """Indices of the ``k`` best rows of every (anchor, slot): higher scores, then smaller ids; equal rows once."""
    order = np.lexsort((vec_id, -score, slot, anchor))
    a, s, c, v = anchor[order], slot[order], score[order], vec_id[order]
    if not len(order):
        return order
    group = np.r_[True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])]
    new = group | np.r_[True, (c[1:] != c[:-1]) | (v[1:] != v[:-1])]
    order, group = order[new], group[new]
    start = np.flatnonzero(group)
    place = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    return order[place < k]


class _Kept:
    """Top ``k`` of each (anchor, slot) of what was offered so far."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k = k
        self.rows = tuple(np.empty(0, np.int64) for _ in range(4))
        # The k-th score of a full slot: lower ones need not be looked at.
        self.floor = np.full((anchors, slots), np.iinfo(np.int64).min)

    def offer(self, *rows: np.ndarray) -> None:
        both = tuple(np.concatenate(x) for x in zip(self.rows, rows))
        best = _first(*both, self.k)
        self.rows = anchor, slot, score, _ = tuple(x[best] for x in both)
        last = np.flatnonzero(np.r_[(anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1]), True][:len(anchor)])
        first = np.r_[0, last[:-1] + 1] if len(last) else last
        full = last - first + 1 == self.k
        self.floor[anchor[last[full]], slot[last[full]]] = score[last[full]]

    def batch(self) -> pa.RecordBatch:
        anchor, slot, score, vec_id = self.rows
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int32()), pa.array(slot, pa.int32()), pa.array(score), pa.array(vec_id)],
            names=["anchor", "slot", "score", "vec_id"],
        )


def _best(rows: DataFrame, block, limits, k: int) -> DataFrame:
    """(anchor, slot, score, vec_id): top ``k`` of all rows for each anchor of the block and slot.

    Without ``limits`` the rows of the anchor's label are looked at, in one slot. With
    them (per anchor, falling, -1 where there is none) those of other labels; the slot
    of a score is the number of limits it does not pass, and it must reach the least score of a window.
    """

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: _Block = block.value
        upper, least = limits.value if limits is not None else (None, None)
        slots = 1 if upper is None else upper.shape[1] + 1
        kept = _Kept(len(anchors.ids), slots, k)
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
            for rows_at, matrix in _matrices(batch):
                if matrix.shape[1] not in anchors.by_size:
                    continue
                all_at, vectors = anchors.by_size[matrix.shape[1]]
                step = max(1, SCORE_CELLS // len(rows_at))
                for start in range(0, len(all_at), step):
                    at = all_at[start:start + step]
                    score = _scores(vectors[start:start + step], matrix)
                    same = anchors.labels[at][:, None] == labels[rows_at][None, :]
                    if upper is None:
                        # An id stands for one item, so an anchor is no partner of its own id.
                        wanted = same & (anchors.ids[at][:, None] != ids[rows_at][None, :]) & (score >= kept.floor[at, 0][:, None])
                    else:
                        wanted = ~same & (score <= upper[at, 0][:, None]) & (score >= least[at][:, None])
                    row, col = np.nonzero(wanted)
                    if not len(row):
                        continue
                    anchor, found = at[row], score[row, col]
                    if upper is None:
                        slot = np.zeros(len(row), np.int64)
                    else:
                        slot = (found[:, None] <= upper[anchor]).sum(1)
                        high = found >= kept.floor[anchor, slot]
                        anchor, found, slot, col = anchor[high], found[high], slot[high], col[high]
                    kept.offer(anchor, slot, found, ids[rows_at][col])
        yield kept.batch()

    seen = rows.mapInArrow(combine, _TOP_SCHEMA)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    # Equal rows share a rank, and a row that several tasks have met stays once.
    return seen.withColumn("_r", F.dense_rank().over(order)).filter(F.col("_r") <= k).drop("_r").distinct()


def _block_results(rows: DataFrame, anchors: pa.Table, positives: int, negatives: int, percent: int) -> DataFrame:
    """Result rows of one block of anchors."""
    spark = rows.sparkSession
    context = spark.sparkContext
    vectors = [np.array(v, np.int64) for v in anchors["v"].to_pylist()]
    ids = anchors["vec_id"].to_numpy()
    block = context.broadcast(_Block(ids, anchors["label"].to_numpy(), vectors))
    # At most ``positives`` rows per anchor of the block reach the driver, and go out again as limits.
    found = _best(rows, block, None, positives).toArrow().sort_by([("anchor", "ascending"), ("score", "descending"), ("vec_id", "ascending")])
    anchor, score, vec_id = (found[c].to_numpy() for c in ("anchor", "score", "vec_id"))
    start = np.searchsorted(anchor, np.arange(len(ids)))
    place = np.arange(len(anchor)) - start[anchor]
    lowest = np.iinfo(np.int64).min
    upper = np.full((len(ids), positives), lowest)
    upper[anchor, place] = score
    # The least score of any window; windows of negative scores are empty.
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, anchor[score >= 0], -(-percent * score[score >= 0] // 100))
    limits = context.broadcast((upper, least))
    best = _best(rows, block, limits, negatives)
    # Slots from the highest down, scores falling: what stands from slot j on is the list up to limit j.
    falling = F.sort_array(F.collect_list(F.struct("slot", (-F.col("score")).alias("score"), "vec_id")))
    lists = best.groupBy("anchor").agg(falling.alias("falling"))
    windows = spark.createDataFrame(
        pa.table({
            "anchor": pa.array(anchor, pa.int32()), "anchor_id": pa.array(ids[anchor], pa.int64()), "slot": pa.array(place + 1, pa.int32()),
            "positive_id": pa.array(vec_id, pa.int64()), "positive_score": pa.array(score, pa.int64()),
        })
    )
    met = lists.join(F.broadcast(windows), "anchor")
    inside = F.slice(
        F.filter("falling", lambda x: (x.slot >= F.col("slot")) & (-100 * x.score >= percent * F.col("positive_score"))), 1, negatives
    )
    return met.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("at", "n")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("n.vec_id").alias("negative_id"),
        "positive_score", (-F.col("n.score")).alias("negative_score"),
    )


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label: Column | None = None,
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: int = PERCENT,
    anchor_cells: int = ANCHOR_CELLS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id`` and ``label``; ``label`` defaults to the column of that
    name. Rows with a NULL id, label or vector, or with a NULL or non-finite component,
    take no part. Ties of score go to the smaller id. An id stands for one item:
    rows that repeat it are no positives of it, and a repeated row counts once. Vectors of
    another length than the anchor's are not compared with it. Anchors without positives
    or without negatives in a window have no rows, nor has an empty table. Other columns are ignored.
    Products that pass 64 bits are an error.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = materialize(eligible(vectors, id_col, F.col("label") if label is None else label, vector_col))
    anchors = rows.filter(is_anchor).dropDuplicates(["vec_id", "label", "v"])
    cells = anchors.agg(F.sum(F.size("v") + 1)).first()[0] or 0
    blocks = -(-cells // anchor_cells)
    if not blocks:
        return spark.createDataFrame([], RESULT)
    if blocks == 1:
        return _block_results(rows, anchors.toArrow(), positives, negatives, percent)
    dealt = materialize(anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)).cast("int")))
    found = [
        materialize(_block_results(rows, dealt.filter(F.col("block") == b).drop("block").toArrow(), positives, negatives, percent))
        for b in range(blocks)
    ]
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result
