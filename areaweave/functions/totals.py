"""Sums and means of DOUBLE columns that, where they can, do not depend on the order of addition.

Percentages and indexes have few decimals. A group whose values all survive the cast to an exact
decimal is added in decimals, so a rerun with other partitions, or after lost executors, gives
the same digits. A group with any other value, very small or very large, is added as it is.
"""

from __future__ import annotations

EXACT = "DECIMAL(18, 6)"


def steady_sum(c: str) -> str:
    survives = f"coalesce(CAST(try_cast({c} AS {EXACT}) AS DOUBLE) = {c}, {c} IS NULL)"
    return (
        f"CASE WHEN bool_and({survives}) THEN CAST(sum(try_cast({c} AS {EXACT})) AS DOUBLE) "
        f"ELSE sum({c}) END"
    )


def steady_avg(c: str) -> str:
    return f"{steady_sum(c)} / count({c})"
