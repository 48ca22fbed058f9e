"""Stage materialisation (S5): write an intermediate to the shared
checkpoint folder as parquet and read it back, cutting the lineage.

The folder comes from ``spark.checkpoint.dir`` (the cluster's shared
storage); only a local session without the setting gets a scratch folder of
its own (see ``session.ensure_checkpoint_dir``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from churnlens.session import ensure_checkpoint_dir


def new_path(spark: SparkSession, name: str) -> str:
    """A folder name of its own under the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/churnlens-stage/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

