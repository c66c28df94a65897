import pytest

from ploidlake import runtime


class Elsewhere:
    """A session on a cluster, as far as the folder's choice looks at it."""

    def __init__(self, folder=None, master="spark://host:7077"):
        self.conf = self.sparkContext = self
        self.folder, self.master = folder, master

    def get(self, name, default=None):
        return self.folder

    def getConf(self):
        return self


def test_a_cluster_without_shared_folder_is_refused():
    for master in ("spark://host:7077", "yarn", "k8s://https://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            runtime.shared_folder(Elsewhere(master=master))
        assert runtime.shared_folder(Elsewhere("hdfs:///steps/", master)) == "hdfs:///steps"
    assert runtime.shared_folder(Elsewhere(master="local[4]")).startswith("file:///")


def test_partition_bound_reads_the_plan(spark):
    a = spark.range(0, 100, 1, 7)
    assert runtime.partition_bound(a) == 7
    small = spark.createDataFrame([(1,)], "id bigint")
    assert runtime.partition_bound(a.join(small.hint("broadcast"), "id")) == 7
    assert runtime.partition_bound(a.unionByName(a).repartition(5).unionByName(a)) == 12
    assert runtime.partition_bound(a.groupBy((a.id % 3).alias("r")).count()) == 4
