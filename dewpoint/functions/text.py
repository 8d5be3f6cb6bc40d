"""Number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_places(value: Column) -> Column:
    """The value as text with two decimals, as C's and Python's ``%.2f`` print it.

    ``format_number`` rounds the stored binary value (39.955 gives 39.95), whereas
    ``format_string('%.2f')`` rounds its shortest decimal text (39.96).
    """
    plain = F.call_function("format_number", value, F.lit("0.00"))
    infinite = F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf"))
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(F.abs(value) == F.lit(float("inf")), infinite)
        .otherwise(plain)
    )
