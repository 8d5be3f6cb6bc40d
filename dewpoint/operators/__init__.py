"""DataFrame operators; each works on batch and streaming frames alike."""

from dewpoint.operators.alerts import match_rules, shape_alerts
from dewpoint.operators.codec import (
    decode_alerts,
    decode_readings,
    encode_alerts,
    encode_readings,
)
from dewpoint.operators.rules import clean_rules, default_rules, load_rules, read_rules
from dewpoint.operators.stats import (
    count_by_code,
    counts_row,
    each_once,
    format_alerts,
    format_counts,
    running_counts,
)
from dewpoint.operators.windows import sliding_averages

__all__ = [
    "clean_rules",
    "count_by_code",
    "counts_row",
    "decode_alerts",
    "decode_readings",
    "default_rules",
    "each_once",
    "encode_alerts",
    "encode_readings",
    "format_alerts",
    "format_counts",
    "load_rules",
    "match_rules",
    "read_rules",
    "running_counts",
    "shape_alerts",
    "sliding_averages",
]
