"""Partitioned snapshot table (S4): one partition per anchor, written once.

Snapshots are written ``partitionBy`` their anchor with dynamic partition overwrite, so a
run replaces the partitions of its own anchors and no other. After the write, the anchors
are noted beside the table; an anchor without a note was cut off in the middle and is
written again, one with a note is skipped. Reads see noted anchors only, as a partition
filter, so other partitions aren't listed into the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ANCHOR = "SNAPSHOT"


class SnapshotTable:
    """Snapshots at ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def committed(self) -> list[dt.date]:
        """The anchors that are written whole."""
        try:
            notes = self.spark.read.schema(f"{ANCHOR} date").parquet(f"{self.path}-commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r[0] for r in notes.distinct().collect())  # a row an anchor

    def missing(self, anchors: Sequence[dt.date]) -> list[dt.date]:
        done = set(self.committed())
        return [a for a in anchors if a not in done]

    def write(self, snapshots: DataFrame, anchors: Sequence[dt.date]) -> None:
        """Replace the partitions of ``anchors`` by their rows in ``snapshots``."""
        rows = snapshots.where(F.col(ANCHOR).isin(list(anchors))).repartition(ANCHOR, F.pmod(F.xxhash64(*snapshots.columns), F.lit(16)))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(ANCHOR).parquet(self.path)
        notes = self.spark.createDataFrame([(a,) for a in anchors], f"{ANCHOR} date")
        notes.coalesce(1).write.mode("append").parquet(f"{self.path}-commits")

    def write_missing(self, anchors: Sequence[dt.date], build: Callable[[list[dt.date]], DataFrame]) -> list[dt.date]:
        """Build and write the anchors that aren't there yet; returns them."""
        missing = self.missing(anchors)
        if missing:
            self.write(build(missing), missing)
        return missing

    def read(self, schema: T.StructType, anchors: Sequence[dt.date] | None = None) -> DataFrame:
        """The committed snapshots (of ``anchors``), with the columns in ``schema``'s order."""
        done = self.committed()
        wanted = [a for a in done if anchors is None or a in set(anchors)]
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path).where(F.col(ANCHOR).isin(wanted)).select(*schema.names)
