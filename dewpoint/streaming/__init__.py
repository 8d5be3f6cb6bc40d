"""Streaming jobs: the only place where queries are started and awaited."""

from dewpoint.streaming.jobs import (
    ledger_counts,
    run,
    start_fan_out,
    start_monitor,
    start_running_counts,
    start_separate,
)
from dewpoint.streaming.state import open_windows
from dewpoint.streaming.watch import BatchMeasurements, read_measurements, supervise

__all__ = [
    "BatchMeasurements",
    "ledger_counts",
    "open_windows",
    "read_measurements",
    "run",
    "start_fan_out",
    "start_monitor",
    "start_running_counts",
    "start_separate",
    "supervise",
]
