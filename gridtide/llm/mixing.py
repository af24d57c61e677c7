"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, how often the mix takes it. Among all rates that give
each source its target number of words, the ones closest to 1 in relative entropy
are ``exp(theta * size)``, held at ``MAX_COPIES``, with one multiplier ``theta`` per
source (sizes in units of the source's mean). The multipliers solve the convex dual by
Newton steps, safeguarded by a bracket. Rates become copies: the whole part of the
rate, and one more for the share of documents that the fractions add up to.

Scale: rates depend on source and size alone, so the Newton steps run over the table of
(source, size, documents), which is counted map-side once and written out. Sources
are numbered by a range sort and partition offsets, not in one task. Documents are
rounded within slices of a source, so a source with a third of all rows is spread.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridtide.session import materialize

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
NEWTON_STEPS = 60
TOLERANCE = 1e-7
SLICE_ROWS = 5_000


def word_count(text: Column) -> Column:
    """Number of words: places where a word begins."""
    spaced = F.concat(F.lit(" "), F.coalesce(text, F.lit("")))
    return F.regexp_count(spaced, F.lit(r"[\x20\x09-\x0D][^\x20\x09-\x0D]")).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``number``, the place (from 0) of ``source`` by code point, NULL last.

    Sorted by range; the driver adds up one count per partition.
    """
    order = [F.col("source").asc_nulls_last()]
    sorted_ = sources.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    sorted_ = materialize(sorted_)
    counts = dict(sorted_.groupBy("_part").count().collect())
    parts = sorted(counts)
    before = list(itertools.accumulate([0, *(counts[p] for p in parts)]))
    if not parts:
        return sorted_.drop("_part").withColumn("number", F.lit(0).cast("long"))
    start = F.create_map(*[F.lit(x) for p, b in zip(parts, before) for x in (p, b)])
    within = Window.partitionBy("_part").orderBy(*order)
    return sorted_.withColumn("number", start[F.col("_part")] + F.row_number().over(within) - 1).drop("_part")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """(source, docs, source_size, target): shares by weight, held at ``most`` times the source's words.

    What held sources cannot take is shared again by weight among the others until
    none is above. ``level`` (words per unit of weight) rises from step to step, so
    each step holds at least one more source or ends.
    """
    sources = numbered(
        sizes.groupBy("source").agg(F.sum("docs").alias("docs"), F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    )
    shares = F.array(*[F.lit(float(w)) for w in weights])
    sources = materialize(
        sources.withColumn("weight", F.get(shares, (F.col("number") % len(weights)).cast("int")))
        .withColumn("cap", most * F.col("source_size").cast("double"))
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        held = F.col("weight") * level > F.col("cap")
        capped, free = sources.agg(
            F.coalesce(F.sum(F.when(held, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~held, F.col("weight")))
        ).first()
        new = (total - capped) / free if free else level
        if new <= level * (1 + 1e-12):
            break
        level = new
    return sources.select(
        "source", "docs", "source_size", F.least(F.col("weight") * level, F.col("cap")).alias("target")
    )


def rate_of(size: Column, theta: Column, mean: Column, most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(theta * size / mean, F.lit(50.0))))


def tilts(sizes: DataFrame, targets: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """(source_key, docs, source_size, target, mean, theta): the dual's solution for every source.

    A Newton step on the logarithm of the words taken is one aggregation over
    (source, size, docs) for all sources at once. A step that leaves the bracket
    found so far is replaced by its middle. A source at its cap has no ``theta``
    (all its documents go in ``most`` times); one without words keeps 0.
    """
    cells = materialize(sizes.filter(F.col("size") > 0).select(_key(F.col("source")).alias("source_key"), "size", F.col("docs").alias("n")))
    solved = F.col("source_size") * float(most) <= F.col("target") * (1 + 1e-12)
    state = materialize(targets.select(
        _key(F.col("source")).alias("source_key"), "docs", "source_size", "target",
        F.greatest(F.col("source_size") / F.col("docs"), F.lit(1.0)).alias("mean"),
        F.when(~solved | (F.col("source_size") == 0), F.lit(0.0)).alias("theta"),
        F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"),
        (solved | (F.col("source_size") == 0)).alias("done"),
    ))
    theta, lo, hi = F.col("theta"), F.col("lo"), F.col("hi")
    for _ in range(NEWTON_STEPS):
        open_ = state.filter(~F.col("done")).select("source_key", "mean", "theta")
        rate = rate_of(F.col("size"), theta, F.col("mean"), most)
        words = F.col("n") * F.col("size") * rate
        sums = cells.join(open_, "source_key").groupBy("source_key").agg(
            F.sum(words).alias("f"),
            F.sum(F.when(rate < most, words * F.col("size") / F.col("mean")).otherwise(F.lit(0.0))).alias("slope"),
        )
        miss = F.log("f") - F.log("target")
        newton = F.greatest(F.least(-miss * F.col("f") / F.col("slope"), 1 + 2 * F.abs(theta)), -1 - 2 * F.abs(theta))
        low, high = F.when(miss < 0, theta).otherwise(lo), F.when(miss > 0, theta).otherwise(hi)
        moved = theta + F.when(F.col("slope") > 0, newton).otherwise(-F.signum(miss) * (1 + 2 * F.abs(theta)))
        inside = (moved > low) & (moved < high)
        next_ = F.when(F.col("done") | (F.abs(miss) <= TOLERANCE), theta).when(inside, moved).otherwise((low + high) / 2)
        state = materialize(state.join(sums, "source_key", "left").select(
            "source_key", "docs", "source_size", "target", "mean",
            next_.alias("theta"), low.alias("lo"), high.alias("hi"),
            (F.col("done") | (F.abs(miss) <= TOLERANCE)).alias("done"),
        ))
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.drop("lo", "hi", "done")


def _key(source: Column) -> Column:
    # NULL is a source of its own; the mark keeps it apart from any text.
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MAX_COPIES,
    slice_rows: int = SLICE_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id_col, *keep, size, source_size, target, rate, copies, taken) per row.

    Size is the number of words; NULL and empty texts have none and take no words.
    A NULL source is a source of its own, numbered last. Each row is a document,
    repeated rows and NULL ids too; which of several equal rows gets an extra copy
    does not matter, so results are the same in every run. Columns of ``keep`` are
    carried along, others ignored. An empty table gives an empty result.

    Rounding: fractions are added up along the documents of a slice of the source in
    order of size, and a document gets a copy where the sum passes a whole number.
    The words of a slice so differ from what its rates say by about one document.
    """
    rows = docs.select(
        F.struct(F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("order"),
    )
    if not keep:  # narrow rows are written once instead of reading all texts again
        rows = materialize(rows)
    sizes = materialize(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")))
    solved = tilts(sizes, source_targets(sizes, weights, most), most)
    rated = rows.withColumn("source_key", _key(F.col("source"))).join(solved, "source_key")
    rate = F.coalesce(rate_of(F.col("size"), F.col("theta"), F.col("mean"), most), F.lit(float(most)))
    slices = F.greatest(F.ceil(F.col("docs") / slice_rows), F.lit(1))
    rated = rated.withColumns({"rate": rate, "slice": F.pmod(F.xxhash64("order"), slices)})
    fraction = F.col("rate") - F.floor("rate")
    start = F.pmod(F.xxhash64("source_key", "slice"), F.lit(1 << 20)) / float(1 << 20)
    ordered = Window.partitionBy("source_key", "slice").orderBy("size", "order", "row")
    upto = F.sum(fraction).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    before = F.coalesce(F.sum(fraction).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    extra = F.floor(upto + start) - F.floor(before + start)
    copies = F.least(F.floor("rate") + extra, F.lit(most)).cast("long")
    return rated.withColumn("copies", copies).select(
        "row.*", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
