"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

import tidelake.llm
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this subpackage travel to executors by value, so that a cluster
# needs no copy of the repository on its workers' import path.
cloudpickle.register_pickle_by_value(tidelake.llm)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as the cluster has slots.

    A scan that already has enough splits is returned as it is, without a shuffle.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the session names none and all runs on this machine (tests, a laptop) a temporary one is set;
    a cluster's executors couldn't see it, so there that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidelake-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read again, and where.

    The files survive the loss of any executor.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut ``df``'s lineage through the shared folder."""
    return written(df, label)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete what ``written`` wrote, when nothing reads it any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Keys with more rows than this, and than the HOT_KEYS-th part of all rows, are looked up by broadcast.
HOT_ROWS, HOT_KEYS = 20_000, 100_000


def lookup(rows: DataFrame, found: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` and, from ``found`` (one row a key; its ``n`` is the key's count in ``rows``), its other columns; other rows go.

    Rows of frequent keys stay where they are: at most ``HOT_KEYS`` keys can have more
    than that part of the ``total`` rows, so those are broadcast, and no task gets all rows of one.
    """
    limit = max(HOT_ROWS, total // HOT_KEYS)
    if total <= limit:  # no key can be frequent
        return rows.join(found.drop("n"), key)
    hot, rare = F.broadcast(found.where(F.col("n") > limit).drop("n")), found.where(F.col("n") <= limit).drop("n")
    return rows.join(hot.select(key), key, "left_anti").join(rare, key).unionByName(rows.join(hot, key))


def worker_state() -> dict:
    """A dictionary that lives as long as a Python worker process does."""
    name = "_tidelake_worker_state"
    module = sys.modules.get(name)
    if module is None:
        module = sys.modules[name] = types.ModuleType(name)
        module.state = {}
    return module.state


def batches_of(column, budget: int):
    """Index ranges of an Arrow binary or string column, of about ``budget`` bytes each."""
    start, used = 0, 0
    for i, value in enumerate(column):
        used += len(value)
        if used >= budget:
            yield start, i + 1
            start, used = i + 1, 0
    if start < len(column):
        yield start, len(column)
