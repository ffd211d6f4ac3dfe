"""Joins with a side that is expected to be small, and single values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def attach(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join a derived dimension. Adaptive execution broadcasts it if it turns out small, else it is a
    sort-merge join whose hot keys are split at run time."""
    return fact.join(dim, on, how)


def value_of(df: DataFrame, *exprs: Column) -> Column:
    """A total of ``df`` as a column: one expression gives its value, several give a struct.

    It is a scalar subquery, computed once and usable in filters that reach the scan.
    """
    named = df.agg(*exprs)
    return (named if len(exprs) == 1 else named.select(F.struct(*named.columns))).scalar()


def by_day(df: DataFrame, daily: DataFrame, how: str = "left", on: str = "date") -> DataFrame:
    """Join a table with one row per day. It is bounded by the calendar (some 36,500 rows a
    century), so it is broadcast."""
    return df.join(F.broadcast(daily), on, how)
