"""Operators: parse, dedupe, upsert, pivot, analytics and planning."""

from stationday.operators import analytics, dedupe, merge, parse, pivot, planning  # noqa: F401
