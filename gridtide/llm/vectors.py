"""Embedding near-dedup with an inverted-list product-quantisation index.

1. Equal vectors of a label collapse into a class, so exact copies are compared once.
2. Coarse centroids and codebooks of the residuals' subspaces are trained on a bounded
   sample of unit vectors. Every class is indexed: its list (nearest centroid), the
   codes of its residual, and the length of what the codes leave out.
3. A class probes every list that can hold a partner. Partners lie within
   ``r = sqrt(2 - 2 * least)`` of it, and a list begins at the plane halfway between two
   centroids, so lists whose plane is farther than r are left out and none is missed.
4. In a probed list the distance to the coded vectors comes from a table of
   distances to the codebook entries. It differs from the true one by at most the
   length left out, so what is farther than r plus that length is no partner.
5. What remains is ranked by the exact cosine in double precision.

Scale: a list of a label is cut into blocks of at most some ``block_rows`` indexed and
as many probing classes, each one group of a shuffle; a block returns sums and one edge
per class to the smallest one it is connected to, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridtide.llm.common import ship_package
from gridtide.llm.components import connected_components
from gridtide.session import materialize

LEAST_COSINE = 0.98
# Vectors the index is trained on, in expectation, and the most numbers they hold.
SAMPLE_ROWS, SAMPLE_NUMBERS = 20_000, 4_000_000
LIST_ROWS, MAX_LISTS = 4000, 4096
SUBSPACES, CODES = 8, 64
BLOCK_ROWS = 2000
SLACK = 1e-6


def _kmeans(x: np.ndarray, k: int, seed: int, steps: int = 12) -> np.ndarray:
    k = min(k, len(x))
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(steps):
        nearest = _squares(x, c).argmin(1)
        n = np.bincount(nearest, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, nearest, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0.0)


@dataclass
class PqIndex:
    """Coarse centroids and, per subspace, (columns, codebook) of the residuals, for vectors of one dimension."""

    centroids: np.ndarray
    books: list[tuple[slice, np.ndarray]]

    @property
    def dimension(self) -> int:
        return self.centroids.shape[1]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, length left out) of unit vectors."""
        lists = _squares(x, self.centroids).argmin(1)
        residual = x - self.centroids[lists]
        codes = np.stack([_squares(residual[:, s], b).argmin(1) for s, b in self.books], 1).astype(np.uint8)
        coded = np.concatenate([b[codes[:, m]] for m, (_, b) in enumerate(self.books)], 1)
        return lists, codes, np.linalg.norm(residual - coded, axis=1)

    def probes(self, x: np.ndarray, radius: float) -> np.ndarray:
        """(vector, list) mask of the lists that come within ``radius`` of a vector."""
        d = _squares(x, self.centroids)
        home = d.argmin(1)
        between = np.sqrt(_squares(self.centroids, self.centroids))[home]
        plane = (d - d[np.arange(len(x)), home][:, None]) / np.maximum(2 * between, 1e-12)
        mask = plane <= radius + SLACK
        mask[np.arange(len(x)), home] = True
        return mask

    def distances(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """(query, coded vector) distances by table lookup, for the list ``at``."""
        residual = x - self.centroids[at]
        total = np.zeros((len(x), len(codes)))
        for m, (s, b) in enumerate(self.books):
            total += _squares(residual[:, s], b)[:, codes[:, m]]
        return np.sqrt(total)


def train_index(sample: np.ndarray, lists: int, seed: int = 11) -> PqIndex:
    centroids = _kmeans(sample, lists, seed)
    residual = sample - centroids[_squares(sample, centroids).argmin(1)]
    edges = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
    return PqIndex(centroids, [
        (slice(a, b), _kmeans(residual[:, a:b], CODES, seed + a + 1)) for a, b in zip(edges[:-1], edges[1:])
    ])


def _unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(vector: Column) -> Column:
    """Every component there and finite, and one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _indexed(classes: DataFrame, index, radius: float) -> DataFrame:
    """(label, dim, list, data, …): each class once as data in its list, and once as query in every list it probes."""
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            table = batch.to_pandas()
            out = []
            for dim, part in table.groupby("dim"):
                x = _unit(part["v"].tolist())
                rows = part[["label", "dim", "cid", "rep", "n"]].reset_index(drop=True)
                if index is not None and dim == index.dimension:
                    lists, codes, rest = index.encode(x)
                    who, where = np.nonzero(index.probes(x, radius))
                    codes = [c.tobytes() for c in codes]
                else:  # vectors of an uncommon dimension form one list and are compared exactly
                    lists, rest, codes = np.zeros(len(x), int), np.full(len(x), np.inf), [b""] * len(x)
                    who, where = np.arange(len(x)), np.zeros(len(x), int)
                data = rows.assign(list=lists, data=True, v=list(x), codes=codes, rest=rest)
                query = rows.iloc[who].assign(list=where, data=False, v=list(x[who]), codes=None, rest=0.0)
                out += [data, query]
            frame = pd.concat(out) if out else None
            if frame is not None:
                yield pa.RecordBatch.from_pandas(frame, schema=_ARROW, preserve_index=False)

    return classes.mapInArrow(run, _INDEXED)


_INDEXED = "label string, dim int, cid long, rep long, n long, list int, data boolean, v array<double>, codes binary, rest double"
_ARROW = pa.schema([
    ("label", pa.string()), ("dim", pa.int32()), ("cid", pa.int64()), ("rep", pa.int64()), ("n", pa.int64()), ("list", pa.int32()),
    ("data", pa.bool_()), ("v", pa.list_(pa.float64())), ("codes", pa.binary()), ("rest", pa.float64()),
])


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """``rows`` with the block (data part, query part) they meet in; a part meets every part of the other side."""
    cell = ["label", "dim", "list"]
    sizes = rows.groupBy(*cell).agg(
        F.ceil(F.count(F.when(F.col("data"), 1)) / block_rows).cast("int").alias("data_parts"),
        F.ceil(F.count(F.when(~F.col("data"), 1)) / block_rows).cast("int").alias("query_parts"),
    ).filter((F.col("data_parts") > 0) & (F.col("query_parts") > 0))
    cut = rows.join(sizes, cell)
    own = F.pmod(F.xxhash64("cid"), F.when(F.col("data"), F.col("data_parts")).otherwise(F.col("query_parts"))).cast("int")
    others = F.sequence(F.lit(0), F.when(F.col("data"), F.col("query_parts")).otherwise(F.col("data_parts")) - 1)
    cut = cut.withColumn("own", own).withColumn("other", F.explode(others))
    return cut.select(
        *rows.columns, F.when(F.col("data"), F.col("own")).otherwise(F.col("other")).alias("data_part"),
        F.when(F.col("data"), F.col("other")).otherwise(F.col("own")).alias("query_part"),
    )


def block_links(
    data: np.ndarray, codes: list, rest: np.ndarray, query: np.ndarray, at: int, index, least: float, radius: float
) -> tuple[np.ndarray, np.ndarray]:
    """(query rows, data rows) of all pairs with at least the cosine ``least``."""
    if index is not None and data.shape[1] == index.dimension:
        coded = np.frombuffer(b"".join(codes), np.uint8).reshape(len(data), -1)
        q, d = np.nonzero(index.distances(query, at, coded) <= radius + rest[None, :] + SLACK)
    else:
        q, d = (x.ravel() for x in np.indices((len(query), len(data))))
    keep = np.empty(len(q), bool)
    for i in range(0, len(q), 100_000):
        part = slice(i, i + 100_000)
        keep[part] = np.einsum("ij,ij->i", query[q[part]], data[d[part]]) >= least
    return q[keep], d[keep]


def vector_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = LEAST_COSINE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id_col, n_links, component_id, kept) per row.

    Only rows with equal labels that are not NULL are compared. Vectors that are
    NULL, empty, zero or hold a NULL or a number that is not finite, and rows with a
    NULL id, link with nothing and are kept; vectors of different dimension are never
    linked. Each row counts as a link of the others, repeated rows too; rows that
    repeat an id share their component. An empty table gives an empty result. Ids
    must be integers.
    """
    ship_package(vectors.sparkSession)
    radius = float(np.sqrt(2 - 2 * least))
    rows = materialize(vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    ))
    usable = rows.filter(_usable(F.col("v")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    classes = materialize(
        usable.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
        .withColumns({"dim": F.size("v"), "cid": F.monotonically_increasing_id()})
    )
    common = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    index = None
    if common:
        dim, n = common
        cells = 1 << 20
        wanted = min(SAMPLE_ROWS, SAMPLE_NUMBERS // dim)
        share = min(cells, -(-cells * wanted // n))
        sample = classes.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("v"), F.lit(cells)) < share))
        found = sample.select("v").toArrow()["v"].to_pylist()
        if found:
            index = train_index(_unit(sorted(found)), max(1, min(MAX_LISTS, n // LIST_ROWS)))
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        data, query = block[block["data"]], block[~block["data"]]
        out = pd.DataFrame({"cid": pd.Series(dtype="int64"), "rep": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "least_rep": pd.Series(dtype="int64")})
        if data.empty or query.empty:
            return out
        x, y = np.stack(data["v"].to_list()), np.stack(query["v"].to_list())
        q, d = block_links(
            x, data["codes"].to_list(), data["rest"].to_numpy(), y, int(data["list"].iloc[0]), shared.value, least, radius
        )
        q_cid, d_cid = query["cid"].to_numpy(), data["cid"].to_numpy()
        q_rep, d_rep = query["rep"].to_numpy(), data["rep"].to_numpy()
        other = q_cid[q] != d_cid[d]
        q, d = q[other], d[other]
        if not len(q):
            return out
        links = np.bincount(q, weights=data["n"].to_numpy()[d], minlength=len(y)).astype(np.int64)
        # The smallest class each one is connected to within the block.
        q_low, d_low = q_rep.copy(), d_rep.copy()
        while True:
            before = q_low.copy(), d_low.copy()
            np.minimum.at(q_low, q, d_low[d])
            np.minimum.at(d_low, d, q_low[q])
            if (before[0] == q_low).all() and (before[1] == d_low).all():
                break
        q_on, d_on = np.unique(q), np.unique(d)
        return pd.DataFrame({
            "cid": np.concatenate((q_cid[q_on], d_cid[d_on])),
            "rep": np.concatenate((q_rep[q_on], d_rep[d_on])),
            "links": np.concatenate((links[q_on], np.zeros(len(d_on), np.int64))),
            "least_rep": np.concatenate((q_low[q_on], d_low[d_on])),
        })

    blocks = _blocks(materialize(_indexed(classes.select("label", "dim", "cid", "rep", "n", "v"), index, radius)), block_rows)
    # An id that is repeated may stand for several classes, so links are summed by class.
    found = materialize(
        blocks.groupBy("label", "dim", "list", "data_part", "query_part")
        .applyInPandas(compare, "cid long, rep long, links long, least_rep long")
    )
    same = usable.join(classes.select("label", "v", "rep", "n").filter("n > 1"), ["label", "v"]).select(F.col("rep").alias("a"), F.col("id").alias("b"))
    components = connected_components(found.select(F.col("rep").alias("a"), F.col("least_rep").alias("b")).distinct().union(same))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    per_class = classes.join(links, "cid", "left").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    return (
        rows.join(per_class, ["label", "v"], "left").join(components, rows.id == components.node, "left")
        .select(
            F.col("id").alias(id_col),
            F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))
    )
