"""Equi-joins on one key that stay spread out when a key, or NULL, is very frequent.

Inner, semi and anti joins need no help: Spark drops or splits skewed partitions of
either useful side at run time (AQE), and turns a side it has measured as small into a
broadcast. What AQE cannot split are the null-extended side of an outer join and the
pile of NULL keys that outer joins have to keep. Those two cases are handled here.
No size is assumed and nothing is hinted: broadcasts are left to Spark's size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.operators.key_stats import SLOT_ROWS

_SLOT, _OTHER, _SLOTS, _MET = "__slot", "__other_slot", "__slots", "__met"


def _quoted(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def _no_slot(key: str) -> str:
    """Always 0, but not visibly so: a slot the optimizer knows to be constant would leave
    the join keys and turn into a filter, and NULL keys would pile up again."""
    return f"pmod(xxhash64(`{key}`), 1)"


def _slot_if_null(key: str, columns: Sequence[str]) -> str:
    """Spreads rows without a key by what else they hold; they match nothing in any slot."""
    return (f"CASE WHEN `{key}` IS NULL THEN xxhash64({', '.join(_quoted(columns))}) "
            f"ELSE {_no_slot(key)} END")


def _named(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(f"`{key}`").isNotNull())


def _nameless(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(f"`{key}`").isNull())


def outer_chain(tables: Sequence[tuple[DataFrame, str]], how: str) -> DataFrame:
    """Outer joins of tables with differently named keys; all keys stay in the result.

    `tables`: (rows, key). A `left` chain matches every table on the first one's key, a `full`
    chain each on the key of the table before it. For tables with at most a few rows per key.

    Rows without a key match nothing. They are set aside once, from the base tables, and come back
    in a union, in the tasks that read them, so that the joins see keys only: a left chain keeps
    the partitioning of its first join, or of the buckets, to the end. In a full chain a row that
    the table before did not have gets a NULL key on the way; it is dealt out by the keys it has.
    """
    full = how.startswith("full")
    (first, key), *rest = tables
    joined = _named(first, key)
    for i, (df, own) in enumerate(rest):
        on = tables[i][1] if full else key
        side, same = _named(df, own), F.col(f"`{on}`") == F.col(f"`{own}`")
        if full and i:
            known = [k for _, k in tables[:i + 1]]
            joined = joined.withColumn(_SLOT, F.expr(_slot_if_null(on, known)))
            side = side.withColumn(_OTHER, F.expr(_no_slot(own)))
            same = same & (F.col(_SLOT) == F.col(_OTHER))
        joined = joined.join(side, same, how).drop(_SLOT, _OTHER)
    for df, own in tables if full else tables[:1]:
        joined = joined.unionByName(_nameless(df, own), allowMissingColumns=True)
    return joined


def outer_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str
) -> DataFrame:
    """Left or full outer join on two differently named keys; both keys stay in the result."""
    return outer_chain([(left, left_key), (right, right_key)], how)


def split_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    frequent: DataFrame | None = None,
    unique: Sequence[str] = (),
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """`left LEFT JOIN right USING (key)` for a right side with frequent keys.

    `frequent`: the right table's key statistics (`key`, `rows`), as stored with exactly these
    rows; nothing is counted here. A key of n rows gets n / `slot_rows` slots: its rows are dealt
    out over them by the right table's unique columns, so that equal values elsewhere do not
    keep rows together, and the left rows of that key are repeated once per slot. A repeated
    left row that meets no partner in its slot is dropped again: its key is counted on the
    right, so it has partners elsewhere. Every other row behaves as in the plain join, and
    left rows without a key are spread. Result: key, left columns, right columns.
    """
    own = [f"`{c}`" for c in left.columns if c != key]
    others = [f"`{c}`" for c in right.columns if c != key]
    named, slots = right.where(f"`{key}` IS NOT NULL"), f"CAST(NULL AS INT) AS {_SLOTS}"
    if frequent is not None:
        counted = frequent.selectExpr(
            f"`key` AS `{key}`", f"CAST(ceil(rows / {slot_rows}) AS INT) AS {_SLOTS}").where(
            f"{_SLOTS} > 1")
        left, named = (df.join(counted, key, "left") for df in (left, named))
        slots = _SLOTS
    deal = ", ".join(_quoted(unique or right.columns))
    dealt = named.selectExpr("*", *([slots] if frequent is None else [])).selectExpr(
        f"`{key}`", *others,
        f"CASE WHEN {_SLOTS} IS NULL THEN {_no_slot(key)} "
        f"ELSE pmod(xxhash64({deal}), {_SLOTS}) END AS {_SLOT}",
        f"true AS {_MET}")
    repeated = left.selectExpr("*", *([slots] if frequent is None else [])).selectExpr(
        f"`{key}`", *own, _SLOTS,
        f"explode(CASE WHEN {_SLOTS} IS NULL THEN "
        f"array({_slot_if_null(key, [c for c in left.columns if c != _SLOTS])}) "
        f"ELSE sequence(0L, {_SLOTS} - 1L) END) AS {_SLOT}")
    return (
        repeated.join(dealt, [key, _SLOT], "left")
        .where(f"{_MET} IS NOT NULL OR {_SLOTS} IS NULL")
        .selectExpr(f"`{key}`", *own, *others)
    )


def left_join_unique(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """`left LEFT JOIN right USING (key)` where the right side has one row per key."""
    columns = [key, *(c for c in (*left.columns, *right.columns) if c != key)]
    met = _named(left, key).join(right, key, "left").select(*[F.col(f"`{c}`") for c in columns])
    return met.unionByName(_nameless(left, key), allowMissingColumns=True)


def without_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is NULL or not among the parent's keys (an anti join).

    The parent is reduced to its distinct keys before it is shuffled; rows without a key are
    never among them and pass by.
    """
    keys = parent.select(F.col(f"`{key}`")).distinct()
    lone = _named(child, key).join(keys, key, "left_anti")
    return lone.select(*[F.col(f"`{c}`") for c in child.columns]).union(_nameless(child, key))


def with_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is among the parent's keys (a semi join)."""
    return child.join(parent.select(key), key, "left_semi").select(*child.columns)
