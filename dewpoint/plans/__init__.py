"""Whole computations composed from the operators; nothing here starts a query."""

from dewpoint.plans.alerting import alerts_of, windows_of
from dewpoint.plans.events import event_messages, event_readings

__all__ = ["alerts_of", "event_messages", "event_readings", "windows_of"]
