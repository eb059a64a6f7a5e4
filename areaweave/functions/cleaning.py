"""SQL expressions that clean one source field.

Each function takes a column name (or expression) and returns Spark SQL text for
`selectExpr` / `F.expr`. Text, because a table is often dozens of such expressions and
sending them as one statement is much quicker than building each from column calls.
"""

from __future__ import annotations

from areaweave.fixed_values import AREA_PREFIX, NOT_AVAILABLE, SUPPRESSED, ZIP_LENGTH


def marked_to_double(c: str, *markers: str) -> str:
    """Read a text measure as DOUBLE, each marker character standing for zero.

    Every occurrence is replaced, so a minus sign is lost: '-5.2' reads as 5.2. That
    is how the published tables were made. Other text fails the (ANSI) cast.
    """
    text = f"CAST({c} AS STRING)"  # a column without markers may have loaded as a number
    for marker in markers or (SUPPRESSED,):
        text = f"replace({text}, '{marker}', '0')"
    return f"CAST({text} AS DOUBLE)"


def text_measure_to_double(c: str) -> str:
    """A measure that carries both the suppressed and the not-available marker."""
    return marked_to_double(c, NOT_AVAILABLE, SUPPRESSED)


def blank_to_double(c: str) -> str:
    """Read an amount as DOUBLE where blanks stand for zero ('   ' -> 000 -> 0.0)."""
    return marked_to_double(c, " ")


def or_zero(c: str, sql_type: str) -> str:
    """The value in its sink type, NULL as zero."""
    return f"coalesce(CAST({c} AS {sql_type}), CAST(0 AS {sql_type}))"


def area_code(name: str) -> str:
    """'ZCTA5 00716' -> '00716'; NULL stays NULL."""
    return f"substr({name}, {len(AREA_PREFIX) + 1})"


def pad_code(c: str, length: int = ZIP_LENGTH) -> str:
    """Left-pad with zeros to `length`; a longer code is kept whole (lpad would cut it)."""
    text = f"CAST({c} AS STRING)"
    return f"CASE WHEN length({text}) < {length} THEN lpad({text}, {length}, '0') ELSE {text} END"


def five_digit_zip(c: str) -> str:
    """ZIP+4 -> ZIP; shorter codes are kept as they are."""
    return f"substr({c}, 1, {ZIP_LENGTH})"
