"""Tables in the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="pulsevault-")


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset a temporary folder does for a session that runs in this process
    only, as in tests; on a cluster that is an error, as no folder of one machine is seen by the others."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_folder()


def shared_path(spark: SparkSession, label: str) -> str:
    """A path that nothing uses yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """df written as Parquet and read again: its rows are computed once and outlive executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
