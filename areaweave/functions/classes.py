"""SQL expressions that classify an area from its bracket columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def _strings(names: Sequence[str]) -> str:
    return ", ".join(f"'{name}'" for name in names)


def class_sums(brackets: Sequence[str], sizes: Mapping[str, int]) -> dict[str, str]:
    """Add up consecutive brackets: {class: number of brackets} -> {class: sum}.

    Added left to right, so that the doubles equal those of any other engine that
    evaluates the same sum.
    """
    if sum(sizes.values()) != len(brackets):
        raise ValueError("class sizes must cover the brackets exactly")
    sums, start = {}, 0
    for label, size in sizes.items():
        sums[label] = " + ".join(brackets[start : start + size])
        start += size
    return sums


def largest_label(labels: Sequence[str]) -> str:
    """Name of the largest column; the first declared wins a tie."""
    values = ", ".join(labels)
    place = f"array_position(array({values}), greatest({values}))"
    return f"elt(CAST({place} AS INT), {_strings(labels)})"


def weighted_index(brackets: Sequence[str], weights: Sequence[float], scale: float) -> str:
    """Sum of bracket x weight over `scale`, added in bracket order starting from zero."""
    terms = (f"{b} * {w}D" for b, w in zip(brackets, weights, strict=True))
    return f"(0.0D + {' + '.join(terms)}) / {scale}D"


def ranked_labels(labels: Sequence[str]) -> str:
    """All columns as (v, i, label) structs, largest value first.

    On a tie the later declared column ranks higher, hence its position is the second
    sort field. The sort is within one row, over a dozen elements.
    """
    entries = (f"struct({n} AS v, {i} AS i, '{n}' AS label)" for i, n in enumerate(labels))
    return f"sort_array(array({', '.join(entries)}), false)"


def nth_label(ranked: str, rank: int) -> str:
    """Label at a rank (from 0) of `ranked_labels`; NULL unless its value is positive."""
    return f"CASE WHEN {ranked}[{rank}].v > 0 THEN {ranked}[{rank}].label END"
