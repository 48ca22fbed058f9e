"""Stage folder: one per application, none of our own on a cluster."""

import pytest

from churnlens.session import ensure_checkpoint_dir
from churnlens.sources.stage import stage


class Cluster:
    """What the helper reads of a session on a cluster."""

    def __init__(self, master, path=None):
        self.conf = {"spark.checkpoint.dir": path} if path else {}
        self.sparkContext = self
        self.master, self.applicationId, self.dirs = master, "app", []

    def setCheckpointDir(self, path):
        self.dirs.append(path)


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"])
def test_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster(master))
    shared = Cluster(master, "hdfs:///shared")
    assert ensure_checkpoint_dir(shared) == "hdfs:///shared" and shared.dirs == ["hdfs:///shared"]


def test_one_folder_per_local_application(spark):
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)


def test_stage_cuts_the_lineage(spark):
    df = stage(spark.range(5).selectExpr("id * 2 AS x"), "t")
    assert sorted(r.x for r in df.collect()) == [0, 2, 4, 6, 8]
    assert "Range" not in df._jdf.queryExecution().toString()
    empty = stage(spark.range(0), "t")
    assert empty.count() == 0 and empty.columns == ["id"]
