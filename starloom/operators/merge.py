"""Inner equi-join with data-frame merge semantics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.names import column


def merge(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    null_safe: bool = False,
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Join on equally named keys, which appear once in the result.

    Null keys match nothing, or each other with ``null_safe``: then every null row of
    one side meets every one of the other. Other columns that share a name get the
    suffixes. No side is hinted: Catalyst broadcasts one only under its size
    threshold, and adaptive execution splits hot keys.
    """
    keys = [on] if isinstance(on, str) else list(on)
    clashing = (set(left.columns) & set(right.columns)) - set(keys)

    def renamed(name: str, suffix: str) -> str:
        return name + suffix if name in clashing else name

    right_key = {key: f"__right_{place}" for place, key in enumerate(keys)}
    left_names = [renamed(name, suffixes[0]) for name in left.columns]
    right_names = [renamed(name, suffixes[1]) for name in right.columns if name not in keys]
    if len(set(left_names + right_names)) < len(left_names + right_names):
        raise ValueError(f"suffixes {suffixes} do not make the column names distinct")

    left_side = left.select(
        *[column(name).alias(renamed(name, suffixes[0])) for name in left.columns]
    )
    right_side = right.select(
        *[
            column(name).alias(right_key.get(name, renamed(name, suffixes[1])))
            for name in right.columns
        ]
    )
    # Where one side has no nulls, plain equality finds the same pairs more cheaply.
    may_match_null = {
        key: null_safe and left.schema[key].nullable and right.schema[key].nullable
        for key in keys
    }
    matches = [
        column(key).eqNullSafe(F.col(right_key[key]))
        if may_match_null[key]
        else column(key) == F.col(right_key[key])
        for key in keys
    ]
    joined = left_side.join(right_side, reduce(lambda a, b: a & b, matches), "inner")
    return joined.drop(*right_key.values())
