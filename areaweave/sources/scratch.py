"""Where intermediate files go: the shared folder the session names, and how long shuffles are kept."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def named_root(spark: SparkSession) -> str | None:
    """The folder the session or its context names, if any."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    return named or spark.sparkContext.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`. There is no default: on a cluster executors could not see one
    another's files in a folder of their own."""
    named = named_root(spark)
    if not named:
        raise RuntimeError(f"set {_SETTING} to a folder all executors share")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder for one run."""
    return f"{scratch_root(spark)}/areaweave/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def run_folder(root: str) -> str:
    """A folder for one run's row dumps, named by the time it started."""
    return f"{root.rstrip('/')}/{datetime.now():%Y_%m_%d_%H_%M_%S}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within, each query's shuffle files go when it ends. Else they stay until the driver's memory
    is cleaned up, and those of all steps of a job add up. A query that is run again shuffles again."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)
