"""The ordered run of all stages.

``refresh``: load, then overwrite stations, observations and daily temps
from the whole staging tables, then upsert analytics.
``upsert``: load what is given, then merge the stations and observations of
every unfinished load (this one and what stopped runs left), recompute the
daily temps of the date partitions they touched (all when the table is empty)
and upsert analytics for them and for the days of stations that only now
arrived.
The incremental stream (``stationday.streaming``) is the third mode; an
outside scheduler calls :func:`run_pipeline` and the stream in turn.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from stationday.config import PipelineConfig
from stationday.plans import progress
from stationday.plans.stages import (
    StageResult,
    Tables,
    analytics_stage,
    load_raw,
    pivot_stage,
    setup,
    transform_observations,
    transform_stations,
    validate_tables,
)


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, weather_path=None, station_path=None,
                 kind: str = "array", mode: str = "upsert", parse_mode: str = "strict",
                 dedupe_refresh: bool = False) -> list[StageResult]:
    if mode not in ("upsert", "refresh"):
        raise ValueError("mode must be 'upsert' or 'refresh'")
    t = setup(spark, cfg)
    out: list[StageResult] = []
    if weather_path is not None or station_path is not None:
        out.append(load_raw(spark, cfg, weather_path, station_path, kind))
    if mode == "refresh":
        loads = {step: progress.pending(spark, t, step) for step in progress.STEPS}
        out.append(transform_stations(spark, cfg, mode, parse_mode))
        out.append(transform_observations(spark, cfg, mode, parse_mode, dedupe=dedupe_refresh))
        out.append(pivot_stage(spark, cfg, mode="refresh"))
        out.append(analytics_stage(spark, cfg))
        for step, ids in loads.items():
            progress.mark(spark, t, ids, step)
    else:
        for step, stage in (("stations", transform_stations), ("observations", transform_observations)):
            loads = progress.pending(spark, t, step)
            out.append(stage(spark, cfg, mode, parse_mode, loads=loads) if loads else
                       StageResult(step, "skipped: no staged rows"))
            progress.mark(spark, t, loads, step)
        out += run_downstream(spark, t)
    out.append(validate_tables(spark, cfg))
    return out


def run_downstream(spark: SparkSession, t: Tables) -> list[StageResult]:
    """Daily temps and analytics of all loads that have not had them."""
    loads = progress.pending(spark, t, "downstream")
    if not loads:
        return [StageResult(s, "skipped: nothing touched") for s in ("daily_temps", "analytics")]
    touched = progress.periods(spark, t, loads)
    out = [pivot_stage(spark, t.cfg, touched),
           analytics_stage(spark, t.cfg, touched, progress.new_stations(spark, t, loads))]
    progress.mark(spark, t, loads, "downstream")
    return out
