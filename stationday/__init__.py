"""stationday: daily station measurements on Spark.

Raw JSON records are loaded into staging tables with one VARIANT column,
parsed into typed, deduplicated observations and station metadata, kept
current by keyed upserts (full refresh, batch upsert, or incrementally from
newly arrived files with Structured Streaming), pivoted into one row per
(day, station) and summarised per station and day.

Everything is expressed with DataFrames and Spark SQL; no Python UDF runs
in any hot path.
"""

from stationday.config import PipelineConfig, work_dir

__all__ = ["PipelineConfig", "work_dir"]
