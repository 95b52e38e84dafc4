"""Joins on keys that may be missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def join_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join group facts back to rows; the group of missing keys counts as one group.

    No broadcast hint: the optimizer broadcasts the group side when its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits a hot key otherwise.
    """
    right = groups.withColumnsRenamed({k: f"_join_{k}" for k in by})
    condition = reduce(lambda a, b: a & b,
                       [rows[k].eqNullSafe(right[f"_join_{k}"]) for k in by])
    return rows.join(right, condition, how).drop(*[f"_join_{k}" for k in by])
