"""Column functions: values in, columns out."""

from dewpoint.functions.exact import exact_average, exponent_group, in_units, parts_of
from dewpoint.functions.ranges import in_range, no_bound_to_null
from dewpoint.functions.text import two_places

__all__ = [
    "exact_average",
    "exponent_group",
    "in_range",
    "in_units",
    "no_bound_to_null",
    "parts_of",
    "two_places",
]
