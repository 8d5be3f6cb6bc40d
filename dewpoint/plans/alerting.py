"""From messages to windows to alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame

from dewpoint.operators import decode_readings, match_rules, shape_alerts, sliding_averages
from dewpoint.schemas import WATERMARK, WINDOW_SIZE, WINDOW_SLIDE


def windows_of(
    messages: DataFrame,
    *,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str = WATERMARK,
    measured: bool = False,
) -> DataFrame:
    """Window averages of JSON reading messages."""
    return sliding_averages(decode_readings(messages), size, slide, watermark, measured)


def alerts_of(
    windows: DataFrame, rules: DataFrame, now: Column | datetime | None = None
) -> DataFrame:
    """Alerts of window averages under a cleaned rule table."""
    return shape_alerts(match_rules(windows, rules), now)
