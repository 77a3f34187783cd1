"""Structured Streaming: incremental upsert of newly arrived files."""

from stationday.streaming.incremental import (
    IncrementalRun,
    incremental_upsert,
    observation_stream,
    skip_existing_files,
)

__all__ = ["IncrementalRun", "incremental_upsert", "observation_stream", "skip_existing_files"]
