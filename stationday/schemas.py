"""One declared schema per table, with its logical key and partitioning.

The harmonized and analytics tables are Parquet tables. Facts are
partitioned by day (or month, see ``fact_specs``) of their date so that an
upsert rewrites only the periods it touches; the stations dimension is partitioned by a hash bucket of
its key for the same reason. The partition column is derived from the row
and is never part of the logical schema a reader sees.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    partition_col: str | None = None
    partition_type: T.DataType | None = None
    # builds the partition value from the logical columns
    partition_expr: Callable[[], Column] | None = None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def storage_schema(self) -> T.StructType:
        """Logical schema plus the partition column, last."""
        if not self.partition_col:
            return self.schema
        return T.StructType(
            list(self.schema.fields) + [T.StructField(self.partition_col, self.partition_type, True)]
        )

    def with_partition(self, df: DataFrame) -> DataFrame:
        """Logical columns in declared order, then the partition column.

        Only columns whose type differs from the declared one are cast (a
        cast crosses into the JVM once per column when the plan is built).
        """
        have = {f.name: f.dataType for f in df.schema.fields}
        cols = [F.col(f.name) if have.get(f.name) == f.dataType else
                F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in self.schema.fields]
        if self.partition_col:
            cols.append(self.partition_expr().cast(self.partition_type.simpleString()).alias(self.partition_col))
        return df.select(*cols)

    def logical(self, df: DataFrame) -> DataFrame:
        return df.select(*self.columns)

    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.storage_schema.fields)


# Partition of rows without a date: not NULL, so that partition values compare
# with = and prune like any other. Rows of that very day may share it.
NO_DATE = dt.date(1600, 1, 1)


def month_of(col: str) -> Callable[[], Column]:
    return lambda: F.coalesce(F.trunc(F.col(col).cast("date"), "month"), F.lit(NO_DATE))


def day_of(col: str) -> Callable[[], Column]:
    return lambda: F.coalesce(F.col(col).cast("date"), F.lit(NO_DATE))


# Partition grain of the fact tables. "day" keeps an incremental upsert from
# rewriting a whole month; "month" gives fewer, larger files for small volumes.
GRAINS = {"month": month_of, "day": day_of}
PERIOD_COL = "obs_period"
STATION_BUCKET = "station_bucket"


def bucket_of(col: str, n: int) -> Callable[[], Column]:
    return lambda: F.pmod(F.xxhash64(F.col(col)), F.lit(n)).cast("int")


# ---- raw layer: one semi-structured column plus ingest metadata ----------

INGEST_COLUMNS = T.StructType([
    T.StructField("_file", T.StringType(), True),
    T.StructField("_mtime", T.TimestampType(), True),
    T.StructField("_pos", T.LongType(), True),
])


LOAD_ID = "_load_id"


def staging_spec(name: str, column: str) -> TableSpec:
    """Staging rows, partitioned by the load that brought them, so a run can
    process only its own load (partition pruning) instead of all history."""
    return TableSpec(
        name=name,
        schema=T.StructType([T.StructField(column, T.VariantType(), True)] + list(INGEST_COLUMNS.fields)),
        partition_col=LOAD_ID, partition_type=T.StringType(), partition_expr=lambda: F.col(LOAD_ID),
    )


# One row per loaded file: the load-once check reads this, not the staged rows.
LOAD_LOG = TableSpec(
    name="load_log",
    schema=T.StructType([
        T.StructField("staging_table", T.StringType(), True),
        T.StructField("_file", T.StringType(), True),
        T.StructField("_mtime", T.TimestampType(), True),
        T.StructField(LOAD_ID, T.StringType(), True),
    ]),
)

# How far each load has come, so that a run takes every unfinished load once:
# the steps that are done, the periods its observations fall in, and the
# stations it brought that were not there before. All are only appended to.
LOAD_PROGRESS = TableSpec("load_progress", T.StructType([
    T.StructField(LOAD_ID, T.StringType(), True),
    T.StructField("step", T.StringType(), True),
]))
LOAD_PERIODS = TableSpec("load_periods", T.StructType([
    T.StructField(LOAD_ID, T.StringType(), True),
    T.StructField(PERIOD_COL, T.DateType(), True),
]))
LOAD_STATIONS = TableSpec("load_stations", T.StructType([
    T.StructField(LOAD_ID, T.StringType(), True),
    T.StructField("station_id", T.StringType(), True),
]))

OBSERVATION_STAGING = staging_spec("observation_staging", "weather_json")
STATION_STAGING = staging_spec("station_staging", "station_json")

# ---- harmonized layer ------------------------------------------------------

# Column names and types of the shared data model.
STATIONS_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("elevation", T.DoubleType(), True),
    T.StructField("elevation_unit", T.StringType(), True),
    T.StructField("min_date", T.DateType(), True),
    T.StructField("max_date", T.DateType(), True),
    T.StructField("data_coverage", T.DoubleType(), True),
])

OBSERVATIONS_SCHEMA = T.StructType([
    T.StructField("observation_date", T.TimestampNTZType(), True),
    T.StructField("datatype", T.StringType(), True),
    T.StructField("station_id", T.StringType(), True),
    T.StructField("attributes", T.StringType(), True),
    T.StructField("obs_value", T.DoubleType(), True),
])

DAILY_TEMPS_SCHEMA = T.StructType([
    T.StructField("observation_date", T.DateType(), True),
    T.StructField("station_id", T.StringType(), True),
    T.StructField("tmax", T.DoubleType(), True),
    T.StructField("tmin", T.DoubleType(), True),
])

ANALYTICS_SCHEMA = T.StructType([
    T.StructField("observation_date", T.DateType(), True),
    T.StructField("station_id", T.StringType(), True),
    T.StructField("station_name", T.StringType(), True),
    T.StructField("avg_tmax", T.DoubleType(), True),
    T.StructField("avg_tmin", T.DoubleType(), True),
    T.StructField("avg_tavg", T.DoubleType(), True),
    T.StructField("avg_daily_temp_change", T.DoubleType(), True),
])


def stations_spec(buckets: int = 4) -> TableSpec:
    return TableSpec(
        "stations", STATIONS_SCHEMA, ("station_id",),
        STATION_BUCKET, T.IntegerType(), bucket_of("station_id", buckets),
    )


def fact_specs(grain: str = "day") -> dict[str, TableSpec]:
    """Observations, daily temps and analytics, partitioned by ``grain`` of their date."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}")
    part = GRAINS[grain]("observation_date")
    return {
        "observations": TableSpec("observations", OBSERVATIONS_SCHEMA,
                                  ("observation_date", "station_id", "datatype"), PERIOD_COL, T.DateType(), part),
        "daily_temps": TableSpec("daily_temps", DAILY_TEMPS_SCHEMA,
                                 ("observation_date", "station_id"), PERIOD_COL, T.DateType(), part),
        "analytics": TableSpec("analytics", ANALYTICS_SCHEMA,
                               ("observation_date", "station_id"), PERIOD_COL, T.DateType(), part),
    }


_DAILY = fact_specs()
OBSERVATIONS = _DAILY["observations"]
DAILY_TEMPS = _DAILY["daily_temps"]
ANALYTICS = _DAILY["analytics"]


def assert_schema(df: DataFrame, schema: T.StructType) -> None:
    """Column names and types must equal the declared ones."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if got != want:
        raise AssertionError(f"schema mismatch: got {got}, want {want}")
