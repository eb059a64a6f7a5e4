"""Published tables: a name that always stands for one whole version of a table.

Every version is a table of its own, `<name>__v<time>_<mark>`, written beside the ones before. Publishing points
the name, a catalog view, at the new version in one catalog step: readers that were opened before
keep reading the files of theirs, later ones see the new version, nobody sees half of one, and a
write that fails leaves the name as it was. Bucketing and file layout are read through the view.

Old versions stay until `drop_old` removes them, which is for whoever knows that no reader is left;
until then `roll_back` can point the name at one again. Key statistics (`operators.key_stats`) belong to a version and go
with it.

A plain table of the wanted name becomes the first version. That is the one case with two catalog
steps, and Spark moves the files of a managed table with its name.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

Approval = Callable[[DataFrame], Mapping[str, str]]

_MARK = "__v"
_OWN = "areaweave."
_STAMP = "%Y%m%d%H%M%S%f"


def stamp() -> str:
    """The time, then a mark of its own: names sort by time and never meet."""
    return f"{datetime.now(UTC):{_STAMP}}_{uuid.uuid4().hex[:8]}"


def stamped_at(name: str, prefix: str) -> datetime | None:
    """When a name made of `prefix` and a stamp was made; None for other names."""
    found = re.match(re.escape(prefix) + r"(\d{20})_[0-9a-f]{8}", name)
    return datetime.strptime(found[1], _STAMP).replace(tzinfo=UTC) if found else None


def _split(spark: SparkSession, name: str) -> tuple[str, str]:
    parts = name.replace("`", "").split(".")
    return (parts[0], parts[1]) if len(parts) > 1 else (spark.catalog.currentDatabase(), parts[0])


def quoted(spark: SparkSession, name: str) -> str:
    return ".".join(f"`{part}`" for part in _split(spark, name))


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(spark, name)}").collect()
    return {r.key.removeprefix(_OWN): r.value for r in rows if r.key.startswith(_OWN)}


def current(spark: SparkSession, name: str) -> str | None:
    """The version table the name stands for; None if it is no published name."""
    if not spark.catalog.tableExists(quoted(spark, name)):
        return None
    return _properties(spark, name).get("version")


def notes(spark: SparkSession, name: str) -> dict[str, str]:
    """What was kept with the version the name stands for; empty if it is no published name."""
    version = current(spark, name)
    return _properties(spark, version) if version else {}


def versions(spark: SparkSession, name: str) -> list[str]:
    """All stored versions, oldest first."""
    space, table = _split(spark, name)
    prefix = f"{table.lower()}{_MARK}"
    rows = spark.sql(f"SHOW TABLES IN `{space}` LIKE '{prefix}*'").collect()
    return sorted(f"{space}.{r.tableName}" for r in rows
                  if stamped_at(r.tableName, prefix) and r.tableName.count("__") == prefix.count("__"))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(properties: Mapping[str, str]) -> str:
    return ", ".join(f"'{_OWN}{key}' = {_text(value)}" for key, value in properties.items())


def point(spark: SparkSession, name: str, version: str) -> None:
    """Let the name stand for a stored version."""
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(spark, name)} "
              f"TBLPROPERTIES ({_listed({'version': version})}) "
              f"AS SELECT * FROM {quoted(spark, version)}")


def _version_name(spark: SparkSession, name: str) -> str:
    space, table = _split(spark, name)
    return f"{space}.{table.lower()}{_MARK}{stamp()}"


def _take_over(spark: SparkSession, name: str) -> None:
    """Make a plain table the first version; a view that is no published name is left alone."""
    space, table = _split(spark, name)
    kind = spark.catalog.getTable(quoted(spark, name)).tableType
    if kind == "VIEW":
        raise ValueError(f"{name} is a view of something else")
    first = _version_name(spark, name)
    spark.sql(f"ALTER TABLE {quoted(spark, name)} RENAME TO {quoted(spark, first)}")
    point(spark, name, first)


def publish(df: DataFrame, name: str, layout: Sequence[str] = (), key: str | None = None,
            buckets: int | None = None,
            approve: Approval | None = None) -> DataFrame:
    """Write `df` as the next version of a table and point the name at it.

    `layout`: columns whose ranges the files are cut by and sorted in, the table's key last, so
    that a value many rows share still spreads over several files and tasks. `key`, `buckets`: one
    file per bucket, which spares joins on the key their shuffle; other tables need the same number.
    `approve` is called with the rows as stored, before the name moves: what it returns is kept
    with that version (`notes`), and if it raises the version goes and the name stays where it was.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(quoted(spark, name)) and current(spark, name) is None:
        _take_over(spark, name)
    version = _version_name(spark, name)
    if buckets:
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    elif layout:
        writer = df.repartitionByRange(*layout).sortWithinPartitions(*layout).write
    else:
        writer = df.write
    try:
        writer.mode("errorifexists").option("compression", "zstd").saveAsTable(version)
        if approve and (kept := approve(spark.table(quoted(spark, version)))):
            spark.sql(f"ALTER TABLE {quoted(spark, version)} SET TBLPROPERTIES ({_listed(kept)})")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(spark, version)}")
        raise
    point(spark, name, version)
    return spark.table(quoted(spark, name))


def roll_back(spark: SparkSession, name: str, version: str | None = None) -> str:
    """Point the name at `version`, or at the one before the current."""
    stored = versions(spark, name)
    if version is None:
        before = [v for v in stored if v < (current(spark, name) or "")]
        if not before:
            raise ValueError(f"{name} has no earlier version")
        version = before[-1]
    if version not in stored:
        raise ValueError(f"{version} is no version of {name}")
    point(spark, name, version)
    return version


def drop_old(spark: SparkSession, name: str, keep: int = 1,
             older_than: timedelta = timedelta(0)) -> list[str]:
    """Remove versions with their files and key statistics: all but the current one, the `keep`
    latest others and those younger than `older_than`. Returns what was removed."""
    space, table = _split(spark, name)
    now = current(spark, name)
    others = [v for v in versions(spark, name) if v != now]
    limit = datetime.now(UTC) - older_than
    gone = [v for v in others[:max(0, len(others) - keep)]
            if stamped_at(v.split(".")[1], f"{table.lower()}{_MARK}") <= limit]
    for version in gone:
        for row in spark.sql(f"SHOW TABLES IN `{space}` LIKE '{version.split('.')[1]}__*'").collect():
            spark.sql(f"DROP TABLE `{space}`.`{row.tableName}`")
        spark.sql(f"DROP TABLE {quoted(spark, version)}")
    return gone
