"""Pipeline stages: load, stations, observations, daily temps, analytics.

Each stage is one lazy plan ending in a single write. Where the reference
materialises work tables, counts and shows between steps, here the only
other jobs are small ones: the upsert's narrow touched-partition aggregate
(skipped when the stage already knows its partitions), ``isEmpty`` gates, and
the rows that record how far each load has come (``plans/progress.py``).
Periods go from stage to stage as small tables, never through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.config import PipelineConfig
from stationday.operators.analytics import station_analytics
from stationday.functions.registry import register_sql_functions
from stationday.operators.merge import (
    coalesce_source_target,
    in_partitions,
    kept_values,
    merge_into,
    touched_partitions,
)
from stationday.operators.parse import parse_observations, parse_stations
from stationday.operators.pivot import daily_temps
from stationday.schemas import (
    LOAD_ID,
    LOAD_LOG,
    LOAD_PERIODS,
    LOAD_PROGRESS,
    LOAD_STATIONS,
    OBSERVATION_STAGING,
    STATION_STAGING,
    PERIOD_COL,
    TableSpec,
    fact_specs,
    stations_spec,
)
from stationday.sources.json_rows import LoadSpec, committed, load_all, new_load_id
from stationday.sources.tables import (
    append_table,
    ensure_database,
    ensure_table,
    overwrite_table,
    table_exists,
)

# The columns a matched row takes from the source in each upsert
# (the others keep the target's value), as the source pipeline's merges set them.
STATION_UPDATES = ("name", "latitude", "longitude", "elevation", "min_date", "max_date")
OBSERVATION_UPDATES = ("obs_value", "attributes")
ANALYTICS_UPDATES = ("avg_tmax", "avg_tmin", "avg_tavg", "avg_daily_temp_change")
# Ingest order for "the latest record wins", then the greatest (value, attributes);
# a config with a sequence field puts it first (PipelineConfig.ingest_order).
INGEST_ORDER = ("_mtime", "_file", "_pos")
OBSERVATION_TIEBREAK = ("obs_value", "attributes")


@dataclass(frozen=True)
class StageResult:
    stage: str
    status: str
    rows: int = 0


class TableNotFound(RuntimeError):
    pass


class Tables:
    """Qualified names and specs of the pipeline's tables for a config."""

    def __init__(self, cfg: PipelineConfig):
        self.cfg = cfg
        self.stations_spec = stations_spec(cfg.station_buckets)
        facts = fact_specs(cfg.fact_grain)
        r, h, a = cfg.raw_db, cfg.harmonized_db, cfg.analytics_db
        self.specs: dict[str, tuple[str, TableSpec]] = {
            "load_log": (r, LOAD_LOG),
            "load_progress": (r, LOAD_PROGRESS),
            "load_periods": (r, LOAD_PERIODS),
            "load_stations": (r, LOAD_STATIONS),
            "observation_staging": (r, OBSERVATION_STAGING),
            "station_staging": (r, STATION_STAGING),
            "stations": (h, self.stations_spec),
            "observations": (h, facts["observations"]),
            "daily_temps": (h, facts["daily_temps"]),
            "analytics": (a, facts["analytics"]),
        }

    def name(self, key: str) -> str:
        db, spec = self.specs[key]
        return f"`{db}`.`{spec.name}`"

    def spec(self, key: str) -> TableSpec:
        return self.specs[key][1]

    def path(self, key: str) -> str:
        db, spec = self.specs[key]
        return self.cfg.path(db, spec.name)


def setup(spark: SparkSession, cfg: PipelineConfig) -> Tables:
    """Databases and every table, created from their declared schemas if missing
    (S8), and the SQL functions of the analytics database (UF4)."""
    t = Tables(cfg)
    for db in (cfg.raw_db, cfg.harmonized_db, cfg.analytics_db):
        ensure_database(spark, db, cfg.db_path(db))
    for key in t.specs:
        ensure_table(spark, t.name(key), t.spec(key), t.path(key))
    register_sql_functions(spark, cfg.analytics_db, cfg.tmax_range, cfg.tmin_range)
    return t


# ---- load ------------------------------------------------------------------

PROVENANCE = '{"origin":"stationday","layer":"raw","format":"json"}'


def load_raw(spark: SparkSession, cfg: PipelineConfig, weather_path=None, station_path=None, kind: str = "array") -> StageResult:
    """Append the new raw observation and station files, of whichever path is
    given, to the staging tables; the status is the load id (the staging
    partition the rows went to), rows the number of files."""
    t = Tables(cfg)
    specs = {}
    if weather_path is not None:
        specs["observations"] = LoadSpec(weather_path, t.name("observation_staging"), "weather_json", kind)
    if station_path is not None:
        specs["stations"] = LoadSpec(station_path, t.name("station_staging"), "station_json", kind)
    load_id = new_load_id()
    n = load_all(spark, specs, comment=PROVENANCE, load_id=load_id, log_table=t.name("load_log"))
    return StageResult("load", load_id if n else "skipped: no new files", n)


def _staged(spark: SparkSession, t: Tables, key: str, loads: list[str] | None) -> DataFrame:
    """Staging rows, of the given loads only (pruned partitions) or of all
    committed ones."""
    name = t.name(key)
    if loads is None:
        return committed(spark, name, t.name("load_log"))
    return spark.table(name).filter(F.col(LOAD_ID).isin(list(loads)))


# ---- transform -------------------------------------------------------------

def transform_stations(spark: SparkSession, cfg: PipelineConfig, mode: str = "upsert",
                       parse_mode: str = "strict", loads: list[str] | None = None) -> StageResult:
    """Staged station JSON -> stations. ``upsert`` merges by station_id
    (with ``loads``: only the rows of those loads); ``refresh`` overwrites
    the table from all staged rows.

    Before an upsert of loads, the stations that are not in the table yet are
    recorded under the first load: days that were observed before their
    station arrived get their analytics from that."""
    t = Tables(cfg)
    raw = _staged(spark, t, "station_staging", loads if mode == "upsert" else None)
    if raw.isEmpty():  # never replace a table by nothing
        return StageResult("stations", "skipped: no staged rows")
    parsed = parse_stations(raw, mode=parse_mode)
    if mode == "refresh":
        overwrite_table(t.stations_spec.with_partition(parsed), t.name("stations"))
        return StageResult("stations", "refreshed")
    if loads:
        known = spark.table(t.name("stations")).select("station_id")
        new = parsed.select("station_id").dropna().distinct().join(known, "station_id", "left_anti")
        append_table(new.select(F.lit(loads[0]).alias(LOAD_ID), "station_id"), t.name("load_stations"))
    r = merge_into(spark, t.name("stations"), t.stations_spec, parsed, update={c: "source" for c in STATION_UPDATES},
                   order=INGEST_ORDER)
    return StageResult("stations", "merged", r.source_rows)


def transform_observations(spark: SparkSession, cfg: PipelineConfig, mode: str = "upsert",
                           parse_mode: str = "strict", dedupe: bool | None = None,
                           loads: list[str] | None = None) -> StageResult:
    """Staged observation JSON -> observations. ``refresh`` does not dedupe
    unless asked, as the reference's full refresh does not.

    With ``loads`` an upsert reads only those loads' staging partitions: the
    same result as re-merging all history, as later loads win anyway. The
    periods it touches are recorded under the first load before the merge, so
    that a run that stops after it still knows what is left to recompute."""
    t = Tables(cfg)
    spec = t.spec("observations")
    raw = _staged(spark, t, "observation_staging", loads if mode == "upsert" else None)
    if raw.isEmpty():  # never replace a table by nothing
        return StageResult("observations", "skipped: no staged rows")
    parsed = parse_observations(raw, mode=parse_mode, sequence_field=cfg.sequence_field)
    if mode == "refresh":
        src = parsed
        if dedupe:
            from stationday.operators.dedupe import dedupe_latest
            src = dedupe_latest(parsed, spec.keys, cfg.ingest_order, OBSERVATION_TIEBREAK)
        overwrite_table(spec.with_partition(src), t.name("observations"))
        return StageResult("observations", "refreshed")
    n, _ = upsert_observations(spark, t, parsed, cfg.null_keys, loads[0] if loads else None)
    return StageResult("observations", "merged", n)


def upsert_observations(spark: SparkSession, t: Tables, parsed: DataFrame, null_keys: str,
                        load_id: str | None = None) -> tuple[int, int]:
    """Merge parsed observations; (rows offered, rows dropped for a NULL key).
    With a load id the touched periods are recorded under it first."""
    spec = t.spec("observations")
    counts = touched_partitions(parsed, spec)
    if null_keys == "drop":
        parsed = parsed.dropna("any", subset=list(spec.keys))
    total = counts.agg(F.sum("n"), F.sum(F.when(F.col("null_key"), F.col("n")).otherwise(0))).first()
    offered, nulls = total[0] or 0, total[1] or 0
    dropped = nulls if null_keys == "drop" else 0
    if offered == dropped:
        return 0, dropped
    touched = (counts.filter(~F.col("null_key")) if null_keys == "drop" else counts).select(PERIOD_COL).distinct()
    if load_id is not None:
        append_table(touched.select(F.lit(load_id).alias(LOAD_ID), PERIOD_COL), t.name("load_periods"))
    merge_into(spark, t.name("observations"), spec, parsed, update={c: "source" for c in OBSERVATION_UPDATES},
               order=t.cfg.ingest_order, tiebreak=OBSERVATION_TIEBREAK, periods=touched)
    return offered - dropped, dropped


def pivot_stage(spark: SparkSession, cfg: PipelineConfig, periods: DataFrame | None = None,
                mode: str = "upsert") -> StageResult:
    """Observations -> daily temps. ``upsert`` merges with COALESCE, so a new
    NULL never erases a stored value; with ``periods`` (a frame with the
    partition column) only the days of those date partitions are recomputed
    (all when the target is still empty). Recomputing a whole touched partition
    gives the same values for its untouched days, since observations are never
    deleted."""
    t = Tables(cfg)
    obs = spark.table(t.name("observations"))
    if mode == "refresh":
        overwrite_table(t.spec("daily_temps").with_partition(daily_temps(obs, cfg.pivot_values)),
                        t.name("daily_temps"))
        return StageResult("daily_temps", "refreshed")
    if periods is not None and periods.isEmpty():
        return StageResult("daily_temps", "skipped: nothing touched")
    if spark.table(t.name("daily_temps")).isEmpty():
        periods = None
    src = daily_temps(in_partitions(obs, PERIOD_COL, periods), cfg.pivot_values)
    # a day falls in the same period as its observations: the touched set is known
    r = merge_into(spark, t.name("daily_temps"), t.spec("daily_temps"), src,
                   update={"tmax": coalesce_source_target("tmax"), "tmin": coalesce_source_target("tmin")},
                   on_duplicate="none",  # one row per key already: the pivot groups by it
                   periods=periods, whole=periods is None)
    return StageResult("daily_temps", "merged", r.source_rows)


def analytics_stage(spark: SparkSession, cfg: PipelineConfig, periods: DataFrame | None = None,
                    stations: DataFrame | None = None) -> StageResult:
    """Daily temps joined to stations, averaged and upserted into analytics.
    Matched rows keep their station_name. With ``periods`` only those date
    partitions of daily temps are read, and with ``stations`` (station_id of
    newly arrived ones) also those in which one of them was observed."""
    t = Tables(cfg)
    daily = spark.table(t.name("daily_temps"))
    if periods is not None and stations is not None and not stations.isEmpty():
        late = daily.join(stations.select("station_id").distinct(), "station_id", "left_semi").select(PERIOD_COL)
        periods = kept_values(periods.select(PERIOD_COL).union(late).distinct(), "periods")
    if periods is not None and periods.isEmpty():
        return StageResult("analytics", "skipped: nothing touched")
    if daily.isEmpty():
        return StageResult("analytics", "skipped: no daily temps")
    src = station_analytics(in_partitions(daily, PERIOD_COL, periods), spark.table(t.name("stations")))
    r = merge_into(spark, t.name("analytics"), t.spec("analytics"), src,
                   update={c: "source" for c in ANALYTICS_UPDATES},
                   on_duplicate="none",  # grouped by the key and a name that depends on it
                   periods=periods, whole=periods is None)
    return StageResult("analytics", "merged", r.source_rows)


def validate_tables(spark: SparkSession, cfg: PipelineConfig) -> StageResult:
    """Every table's columns and types equal its declared schema (S13);
    reads no data."""
    from stationday.schemas import assert_schema

    t = Tables(cfg)
    for key in t.specs:
        spec = t.spec(key)
        assert_schema(spark.table(t.name(key)), spec.storage_schema)
    return StageResult("validate", f"{len(t.specs)} tables match their schemas")


def require_table(spark: SparkSession, name: str) -> None:
    """A stage that needs a table fails clearly when it is missing."""
    if not table_exists(spark, name):
        raise TableNotFound(f"{name} does not exist; run the transform first")
