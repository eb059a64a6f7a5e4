"""Session settings the jobs are meant to run with; a session made elsewhere works too."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Sizes, not counts, decide how many tasks a shuffle gets: it starts with many partitions,
# which are merged up to, or split down to, the advisory size once their sizes are known.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle further on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of each expression takes longer than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(
    name: str, master: str | None = None, partitions: int = 4000, **extra: str
) -> SparkSession:
    """`partitions`: initial shuffle partitions, a few per core of the cluster. `extra`:
    further settings, with `__` for the dots in their names."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        **{key.replace("__", "."): value for key, value in extra.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
