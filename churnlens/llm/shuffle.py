"""Global shuffle into shards: two-pass external shuffle (operator 8).

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded hash and
writes each with its bucket and place; sizes are counted from what was written. Pass 2 takes one bucket at a time, puts it into a fixed order, runs a Fisher-Yates
shuffle of it (numpy's ``Generator.permutation``) and writes it. The buckets, one
after another, are a uniform permutation of all records; shard k takes the positions
from floor(k N / S) to floor((k+1) N / S), so shard sizes differ by at most one row
(law ``rows``) and a bucket is written into one or two neighbouring shards.

The hash takes the id and the record's place in the scan (partition and row number).
The place tells repeated rows apart: a null id or one record repeated a million times
still spreads over all buckets. The place is taken once, as pass 1 writes it, so the input
may be any table, also one that a repartition or a join deals out anew each time it runs.
For the same files and split settings the result is the same for the same seed, also when
tasks run again after an executor is lost.

Defined results: a null text has no bytes; an empty table gives no shards and an
empty result; the whole record is kept in a struct ``record``, so its column names
can clash with nothing; a text longer than a bucket makes that bucket longer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from churnlens.llm.common import col_of, shared_path, text_or_empty

BUCKET_BYTES = 16 << 20  # UTF-8 bytes of text in a bucket: with its Arrow copies, well inside a worker
ROW_OVERHEAD = 16


def record_bytes(text_col: str):
    return F.octet_length(text_or_empty(text_col)).cast("long") + F.lit(ROW_OVERHEAD)


def external_shuffle(df: DataFrame, n_shards: int, seed: int = 0, path: str | None = None,
                     id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``df`` as ``n_shards`` shuffled shards (folders ``shard=k``) and return the
    written table: record (struct of the input's columns), slot, shard."""
    spark = df.sparkSession
    path = path or shared_path(spark, "shards")
    n_bytes = df.agg(F.sum(record_bytes(text_col))).first()[0] or 0  # for the number of buckets only
    n_buckets = max(1, -(-n_bytes // bucket_bytes))

    keyed = df.select(F.struct(*[col_of(c) for c in df.columns]).alias("record"),
                      col_of(id_col).alias("_id"), F.monotonically_increasing_id().alias("_place"))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "_id", "_place"), F.lit(n_buckets)).alias("_bucket")
    scattered = shared_path(spark, "scattered")
    keyed.select("record", "_place", bucket).write.option("compression", "zstd").parquet(scattered)
    schema = T.StructType([T.StructField("record", df.schema), T.StructField("_place", T.LongType()), T.StructField("_bucket", T.LongType())])
    records = spark.read.schema(schema).parquet(scattered)
    counts = records.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    n_rows = records.count()
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))

    schema = T.StructType([records.schema["record"], T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])

    def fisher_yates(key: tuple, rows: pa.Table, start: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("_place").to_numpy(), kind="stable")
        order = order[np.random.default_rng([seed, key[0].as_py()]).permutation(len(order))]
        at = np.arange(len(order), dtype=np.int64) + (start.column("_start")[0].as_py() if len(order) else 0)
        shard = ((at + 1) * n_shards - 1) // max(n_rows, 1)
        slot = at - shard * n_rows // n_shards
        return pa.table({"record": rows.column("record").take(pa.array(order)), "slot": slot, "shard": shard.astype(np.int32)})

    shuffled = records.groupBy("_bucket").cogroup(starts.groupBy("_bucket")).applyInArrow(fisher_yates, schema)
    shuffled.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path)
