"""Where jobs keep what they write between steps, and how they read tables.

Steps that cut lineage write Parquet below the shared folder named by ``spark.checkpoint.dir``; every executor can read
it, so a lost executor costs only the tasks it was running. A folder of this machine is used only where the setting is
absent and every executor runs on this machine (a ``local`` master), as in tests; it is removed when the interpreter
ends. On a cluster without the setting, operators that write stages refuse to run.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _own_folder() -> str:
    path = tempfile.mkdtemp(prefix="ploidlake-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, or one of our own where none is set and all executors are on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share: steps are written there")
    return _own_folder()


class Stages:
    """Tables that one call of an operator writes in the shared folder.

    ``write`` materialises a DataFrame and returns the table read back, with a plan that starts at its files. ``drop``
    deletes tables no later step reads. What a returned DataFrame still reads stays in place.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self.last = 0

    def write(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        self.last += 1
        path = f"{self.root}/{self.last:04d}"
        writer = df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._stage_path = path
        return back

    def drop(self, *tables: DataFrame | None) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = getattr(table, "_stage_path", None)
            if path:
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partition_bound(df: DataFrame) -> int:
    """How many partitions ``df`` has at most, read off its plan; no stage is run to find out."""
    return max(1, _partitions(df._jdf.queryExecution().executedPlan()))


def _partitions(node) -> int:
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _partitions(node.executedPlan())
    if name == "BroadcastExchange":  # goes to every task and adds none
        return 0
    if name == "Exchange":
        return node.outputPartitioning().numPartitions()
    children = node.children()
    if not children.size():
        return node.execute().getNumPartitions()
    below = [_partitions(children.apply(i)) for i in range(children.size())]
    return sum(below) if name == "Union" else max(below)


def fresh(taken: list[str], name: str) -> str:
    """``name``, or it with underscores until no column (compared without case) has it."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name += "_"
    return name
