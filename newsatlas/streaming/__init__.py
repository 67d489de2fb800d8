"""Structured Streaming versions of the polling cycle and of the time-critical analyses."""

from newsatlas.streaming.bursts import breaking_hours, escalation_windows
from newsatlas.streaming.counts import country_slices, first_seen, slice_counts
from newsatlas.streaming.cycle import ingest, read_slices, refresh, refresh_increments
from newsatlas.streaming.sessions import mention_bursts
from newsatlas.streaming.stateful import escalation_speeds, first_hours

__all__ = ["breaking_hours", "country_slices", "escalation_speeds", "escalation_windows", "first_hours", "first_seen",
           "ingest", "mention_bursts", "read_slices", "refresh", "refresh_increments", "slice_counts"]
