"""Exact dedup with a persistent digest index (operator 5).

The index is a Parquet table of one row per distinct text, bucketed and sorted by
the SHA-256 of the text. New data is first reduced to its distinct digests (partial
aggregation, so a text that a third of the rows share never meets in one task as
rows), then a sort-merge anti-join against the index finds the unseen digests, and
those are appended. The index side of every join needs no shuffle: it is read by
bucket, and only distinct digests meet it; rows are joined to what their own batch's
digests found. Only DataFrame operations are used.

The caller names each batch. Digests that a batch has appended aren't earlier ones to that
same batch, and are appended once: a batch that runs again, after its rows were lost or in
the middle of its append, appends what is missing and gives the same result. A marker
tells that a batch is complete; then its append is skipped. The number of buckets is
written beside the table and checked when a path is opened again.

Defined results
* a null text counts as empty; empty texts are equal to each other;
* within one batch the row with the largest id stays, a null id being the smallest;
* rows repeated verbatim (same id, same text) leave exactly one row;
* a text already in the index from an earlier batch keeps the earlier row: every
  row of the new batch with that text is a duplicate;
* a batch name stands for one set of rows: other rows under a complete batch's name are
  looked up and not appended;
* an empty table gives an empty report and leaves the index as it is;
* a text of any length is one digest of 32 bytes; texts are moved by ``keep_new`` only, to
  return them;
* other columns of the input, whatever their names, are not touched.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import col_of, free_name, shared_path, staged, text_or_empty

INDEX_DDL = "digest BINARY, keep_id BIGINT, keep_copies BIGINT, group_size BIGINT, batch STRING"
LEAST = -(2**63)


def digest_of(text_col: str):
    return F.unhex(F.sha2(text_or_empty(text_col).cast("binary"), 256))


class DigestIndex:
    """A bucketed, sorted table of digests at ``path``; reopening a path continues it.

    ``buckets`` is fixed when the table is made: about one bucket for each 100 MB of
    digests expected (a digest row takes some 60 bytes). When a path is opened again the
    number is read; another one given is an error.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or shared_path(spark, "digest-index")
        known = [r.buckets for r in self._notes("layout", "buckets int")]
        if known and buckets not in (None, known[0]):
            raise ValueError(f"{self.path} has {known[0]} buckets, not {buckets}")
        self.buckets = known[0] if known else buckets or 32
        if not known:
            self._note("layout", [(self.buckets,)], "buckets int")
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({INDEX_DDL}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def _notes(self, kind: str, ddl: str) -> list:
        """What is written beside the table, under ``kind``."""
        try:
            return self.spark.read.schema(ddl).parquet(f"{self.path}-{kind}").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _note(self, kind: str, rows: list[tuple], ddl: str) -> None:
        self.spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{self.path}-{kind}")

    def batches(self) -> set[str]:
        """The names of the batches that are complete."""
        return {r.batch for r in self._notes("batches", "batch string")}

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def groups(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(digest, id, n): the rows of ``df`` by text and id. Spread over all tasks even
        if one text holds a third of the rows, for its rows differ in their ids."""
        return (
            df.select(col_of(id_col).cast("bigint").alias("id"), digest_of(text_col).alias("digest"))
            .groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n"))
        )

    def append_new(self, groups: DataFrame, batch: str) -> None:
        """Append the digests that the index does not have yet, as of ``batch``."""
        if batch in self.batches():
            return
        rank = F.coalesce("id", F.lit(LEAST))
        fresh = groups.groupBy("digest").agg(
            F.max("id").alias("keep_id"),
            F.max_by("n", rank).alias("keep_copies"),
            F.sum("n").alias("group_size"),
        )
        (
            fresh.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
            .withColumn("batch", F.lit(batch))
            .repartition(self.buckets, "digest")
            .write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
            .option("path", self.path).mode("append").saveAsTable(self.table)
        )
        self._note("batches", [(batch,)], "batch string")

    def entries(self, groups: DataFrame) -> DataFrame:
        """The index's entries for the digests of ``groups``: the index is read by bucket
        and not shuffled. They are staged, so that adaptive execution can split a join of
        them with the rows of a hot text."""
        return staged(groups.select("digest").distinct().join(self.read().hint("merge"), "digest"), "entries")

    def report(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Ingest ``df`` as one batch; a row for each of its rows: id, keep_id, group_size,
        kept, text_sha256 (column ``id`` has the input's id). A job that may run again
        gives the batch a name; without one it is a new batch each time."""
        batch = batch or uuid.uuid4().hex
        groups = staged(self.groups(df, id_col, text_col), "digests")
        self.append_new(groups, batch)
        joined = groups.join(self.entries(groups), "digest")
        copy = F.explode(F.sequence(F.lit(1).cast("bigint"), col_of("n"))).alias("copy")
        return joined.select("*", copy).select(
            "id",
            "keep_id",
            "group_size",
            ((F.col("batch") == batch) & col_of("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def keep_new(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Ingest ``df`` as one batch and return its rows that stay, with all their columns."""
        batch = batch or uuid.uuid4().hex
        groups = staged(self.groups(df, id_col, text_col), "digests")
        self.append_new(groups, batch)
        digest, key, copies = (free_name(df, x) for x in ("_digest", "_key", "_copies"))
        mine = self.entries(groups).where(F.col("batch") == batch).select(
            F.col("digest").alias(digest), F.col("keep_id").alias(key), F.col("keep_copies").alias(copies)
        )
        rows = df.withColumn(digest, digest_of(text_col)).join(mine, digest).where(
            col_of(id_col).cast("bigint").eqNullSafe(col_of(key))
        )
        once = rows.where(col_of(copies) == 1)
        repeated = rows.where(col_of(copies) > 1).dropDuplicates([digest])
        return once.unionByName(repeated).select(*[col_of(c) for c in df.columns])

    def drop(self) -> None:
        """Forget the table's name; the files at ``path`` stay (it is an external table)."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
