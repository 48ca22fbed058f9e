"""Session helpers.

The library never creates a global session; jobs take the caller's
``SparkSession``. ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_scratch: dict[str, str] = {}  # application id -> its scratch folder (local sessions only)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and bench rely on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("churnlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CHURNLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for stages and checkpoints.

    On a cluster ``spark.checkpoint.dir`` names a folder that all executors
    share; without it a job stops here. Only a ``local`` session without the
    setting gets a scratch folder: one for the application, removed at exit.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        sc = spark.sparkContext
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = _scratch.get(sc.applicationId)
        if path is None:
            path = _scratch[sc.applicationId] = tempfile.mkdtemp(prefix="churnlens-ckpt-")
            atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(path)
    return path
