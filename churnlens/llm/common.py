"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.session import ensure_checkpoint_dir


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def col_of(name: str) -> Column:
    """A top-level column by its literal name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut and a
    lost executor re-reads files. The schema is given, so an empty table works."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(col_of(name).cast("string"), F.lit(""))


def text_slices(rec: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each (a longer text stands
    alone), so that what a task holds doesn't depend on how long the rows are."""
    sizes = pc.fill_null(pc.binary_length(rec.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most, prepend=0)).tolist()
    for a, b in zip([0, *cuts], [*cuts, rec.num_rows]):
        if b > a:
            yield rec.slice(a, b - a)


@contextmanager
def tidy(*caches: dict):
    """Around a task's work in Python: workers live on for other tasks and stages, so at
    its end caches are emptied and freed memory goes back to the system."""
    try:
        yield
    finally:
        for cache in caches:
            cache.clear()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other C libraries have none
        if trim:
            trim(0)


BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most_rows`` rows (of a few bytes);
    beyond that a plain join side, which Spark shuffles. The result is the same."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
