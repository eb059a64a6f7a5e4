"""Namespaces of one run: names nobody else uses, and their clean-up.

A run's tables lie in a namespace named by the time it started, in the shared scratch folder. Results that
read them are lazy, so a run cannot remove its own; `drop_runs` removes those old enough.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession

from areaweave.sources.published import stamp, stamped_at
from areaweave.sources.scratch import scratch_path
from areaweave.sources.tables import create_namespace

PREFIX = "areaweave_run_"


def run_namespace(spark: SparkSession) -> str:
    """A new namespace for one run."""
    name = f"{PREFIX}{stamp()}"
    create_namespace(spark, name, scratch_path(spark, "tables"))
    return name


def drop_runs(spark: SparkSession, older_than: timedelta) -> list[str]:
    """Remove the namespaces of runs that started longer ago, with all their tables."""
    limit = datetime.now(UTC) - older_than
    names = [row[0] for row in spark.sql(f"SHOW DATABASES LIKE '{PREFIX}*'").collect()]
    gone = sorted(n for n in names if (at := stamped_at(n, PREFIX)) and at <= limit)
    for name in gone:
        spark.sql(f"DROP DATABASE `{name}` CASCADE")
    return gone
