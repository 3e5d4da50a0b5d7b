"""Intermediate tables in the shared folder of the cluster.

A written table cuts the lineage (a lost executor re-reads files instead of
recomputing 100 TB), and its real size on disk is known to the planner: a small
one is broadcast under ``spark.sql.autoBroadcastJoinThreshold`` and a large one
is sort-merge joined, with no hint from us.

The tables of a session lie in one folder of their own, which is removed when the
program ends or ``release`` is called.  ``discard`` removes single tables before that.
"""

from __future__ import annotations

import atexit
import uuid
from weakref import WeakKeyDictionary

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, or for local sessions a folder of the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"


def session_dir(spark: SparkSession) -> str:
    """The folder of this session, removed at exit."""
    path = f"{shared_dir(spark)}/watchledger/{spark.sparkContext.applicationId}"
    if path not in _owned:
        _owned.add(path)
    return path


_owned: set[str] = set()
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables of the session; frames that read them are of no use afterwards."""
    for path in list(_owned):
        _delete(spark, path)
        _owned.discard(path)


def discard(*tables: DataFrame) -> None:
    """Remove the files of written tables that no frame reads any more; frames that are not written tables are left alone."""
    for table in tables:
        if path := _paths.pop(table, None):
            _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _release_at_exit() -> None:
    try:
        if SparkContext._active_spark_context is not None and SparkContext._active_spark_context._jsc is not None:
            release(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate())
    except Exception:  # the JVM is gone: nothing can be removed any more
        pass


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the session's folder."""
    return f"{session_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return the table read back from its files."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table
