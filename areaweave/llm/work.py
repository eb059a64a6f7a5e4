"""Helpers shared by the operators: intermediate tables and free column names."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from areaweave.sources.scratch import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return visible(spark).read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: cuts the lineage, and what
    was computed survives the loss of any executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most `limit` bytes of text; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def give_back() -> None:
    """Return what this Python worker no longer uses. Workers outlive their tasks and stand beside
    those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that gives memory back when its rows are through."""
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return wrapped


def free_name(taken: Iterable[str], wanted: str) -> str:
    """`wanted`, with underscores in front until it clashes with no column."""
    low = {name.lower() for name in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def visible(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package from where the driver has it. On a
    cluster it is installed on the executors or given with `--py-files`."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        joined = os.pathsep.join([root, *filter(None, paths)])
        spark.sparkContext.environment["PYTHONPATH"] = joined
    return spark
