"""Tables in the folder that the cluster shares, for results that several steps read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir. Only a local session may do without that setting."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="kinweave-")
    return f"{root.rstrip('/')}/kinweave-{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """df written once and read back, so that what reads it twice doesn't compute it twice."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *steps: Callable) -> list:
    """What the steps return, run at once: steps of many short jobs leave cores idle."""
    with ThreadPool(len(steps)) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda f: f()), steps, chunksize=1)
