"""Open-ended closed ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_range(value: Column, low: Column, high: Column) -> Column:
    """``low <= value <= high``, where a null bound leaves its side open.

    A null value passes only if both sides are open. NaN sorts above every
    number, so it passes any lower bound and no upper bound.
    """
    return (low.isNull() | (value >= low)) & (high.isNull() | (value <= high))


def no_bound_to_null(bound: Column, sentinel: float) -> Column:
    """Null where the bound holds the sentinel for "not checked"."""
    return F.nullif(bound, F.lit(float(sentinel)))
