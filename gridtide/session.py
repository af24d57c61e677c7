"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Needed for right results: payload times are text in UTC without an offset.
TIME_ZONE = "UTC"

_DEFAULTS = {
    "spark.sql.session.timeZone": TIME_ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "gridtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC and adaptive execution on; ``conf`` overrides any setting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Set the session time zone the operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder and make sure the context uses it.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="gridtide-checkpoint-")
    context.setCheckpointDir(named)
    return named


# Folders written inside the innermost open ``scratch`` block.
_open_blocks: list[list[str]] = []


def _write_out(df: DataFrame, reader: SparkSession | None = None) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/gridtide-{uuid.uuid4()}"
    df.write.parquet(path)
    return (reader or spark).read.schema(df.schema).parquet(path), path


def _remove(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage like a checkpoint does, survives lost executors, and unlike
    a checkpoint keeps column pruning, filter pushdown and size statistics. Like
    a checkpoint it stays in the folder, except inside a ``scratch`` block.
    """
    written, path = _write_out(df)
    if _open_blocks:
        _open_blocks[-1].append(path)
    return written


# Frames of at most so many rows are worked on in one partition by ``compacted``.
FEW_ROWS = 50_000


def compacted(df: DataFrame, most: int = FEW_ROWS, size: Column | None = None) -> tuple[DataFrame, int]:
    """``materialize`` of ``df``, in one partition if it holds few rows, and the number of its rows.

    Frames in one partition are joined and grouped without a shuffle, so a round over a small remainder costs
    one short task a step instead of one for each shuffle partition. More than ``most`` rows, or rows whose ``size``
    adds up to more than a hundred times as much, stay spread.
    """
    written = materialize(df)
    rows, total = written.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.lit(0) if size is None else size), F.lit(0))).first()
    return (written.coalesce(1) if rows <= most and total <= 100 * most else written), rows


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``materialize`` writes inside the block is removed at its end.

    For jobs that end in a write of their own; a frame that leaves the block must
    not rest on what was written in it.
    """
    _open_blocks.append([])
    try:
        yield
    finally:
        for path in _open_blocks.pop():
            _remove(spark, path)


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``materialize`` of what ``build`` returns; what it materialized on the way is removed once that is written."""
    with scratch(spark):
        written, path = _write_out(build())
    if _open_blocks:
        _open_blocks[-1].append(path)
    return written


@contextmanager
def staged(df: DataFrame, reader: SparkSession | None = None) -> Iterator[DataFrame]:
    """``materialize`` for the length of a block; the files are removed after it. ``reader`` is a session to read by, if not the frame's own."""
    spark = df.sparkSession
    written, path = _write_out(df, reader)
    try:
        yield written
    finally:
        _remove(spark, path)
