"""Join-strategy helpers.

A broadcast is only forced after the side has been written and counted (or
when it is a one-row aggregate). Everything else is left to AQE, which
converts a sort-merge join to a broadcast join only after it has measured the
real size of the small side at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outletlab.session import cut_lineage

BROADCAST_ROWS = 200_000


def broadcast_counted(df: DataFrame, name: str, max_rows: int = BROADCAST_ROWS, required: bool = False) -> DataFrame:
    """``df`` written once and marked for broadcast if it has at most
    ``max_rows`` rows. A larger one is returned as stored, so that the planner
    shuffles, or refused when ``required``: then the caller knows a bound (days
    of a calendar, codes of a country) and a shuffle on the key would gather
    the fact rows in a few tasks."""
    stored = cut_lineage(df, name)
    rows = stored.count()
    if rows <= max_rows:
        return F.broadcast(stored)
    if required:
        raise ValueError(f"{name} has {rows} rows; at most {max_rows} can be broadcast")
    return stored


def null_safe_keys(left: DataFrame, right: DataFrame, keys, suffix: str = "__r"):
    """Rename ``keys`` on the right side and return (right, join condition)
    matching NULL to NULL (NULL strata form a group of their own)."""
    right = right.withColumnsRenamed({k: f"{k}{suffix}" for k in keys})
    cond = [left[k].eqNullSafe(right[f"{k}{suffix}"]) for k in keys]
    return right, cond
