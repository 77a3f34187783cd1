"""Pipeline inputs derived from the driver's tables.

``events`` plays the observations: the day of ``ts`` is the observation
date, ``user_id`` the station, ``event_type`` the kind (``click`` is TMAX,
``view`` is TMIN, others keep their name in upper case), ``props`` the
attributes and ``value`` the measured value. ``customer`` plays the
stations. Everything here is a Spark transformation of those tables, so
its work grows with them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping (see module doc).
KIND_OF_EVENT = {"click": "TMAX", "view": "TMIN"}
ELEVATION_UNIT = "METERS"
STATION_MIN_DATE = "2024-01-01"
STATION_MAX_DATE = "2024-01-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kind_of(event_type: Column) -> Column:
    out = F.upper(event_type)
    for ev, kind in reversed(list(KIND_OF_EVENT.items())):
        out = F.when(event_type == F.lit(ev), F.lit(kind)).otherwise(out)
    return out


def observations_from_events(events: DataFrame, keep_id: bool = True) -> DataFrame:
    """Typed observation rows (plus ``event_id``, the ingest order)."""
    cols = [
        F.col("ts").cast("date").cast("timestamp_ntz").alias("observation_date"),
        kind_of(F.col("event_type")).alias("datatype"),
        F.col("user_id").cast("string").alias("station_id"),
        F.col("props").alias("attributes"),
        F.col("value").cast("double").alias("obs_value"),
    ]
    if keep_id:
        cols.insert(0, F.col("event_id"))
    return events.select(*cols)


def stations_from_customers(customer: DataFrame) -> DataFrame:
    """Typed station rows, one per customer."""
    return customer.select(
        F.col("c_custkey").cast("string").alias("station_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("double").alias("latitude"),
        F.col("c_acctbal").cast("double").alias("longitude"),
        (F.col("c_nationkey") * 10).cast("double").alias("elevation"),
        F.lit(ELEVATION_UNIT).alias("elevation_unit"),
        F.to_date(F.lit(STATION_MIN_DATE)).alias("min_date"),
        F.to_date(F.lit(STATION_MAX_DATE)).alias("max_date"),
        (F.col("c_nationkey").cast("double") / F.lit(25)).alias("data_coverage"),
    )


SEQUENCE_FIELD = "seq"


def observation_records(events: DataFrame) -> DataFrame:
    """Observation records shaped like the source's JSON (keys date, datatype,
    station, attributes, value, zip_code) plus ``seq``, the event id as the
    record's ingest sequence number; ``event_id`` orders array files."""
    return events.select(
        F.col("event_id"),
        F.col("event_id").alias(SEQUENCE_FIELD),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'00:00:00").alias("date"),
        kind_of(F.col("event_type")).alias("datatype"),
        F.col("user_id").cast("string").alias("station"),
        F.col("props").alias("attributes"),
        F.col("value").alias("value"),
        F.col("user_id").cast("string").alias("zip_code"),
    )


def station_records(customer: DataFrame) -> DataFrame:
    s = stations_from_customers(customer)
    return s.select(
        F.col("station_id").alias("id"), "name", "latitude", "longitude", "elevation",
        F.col("elevation_unit").alias("elevationUnit"),
        F.date_format("min_date", "yyyy-MM-dd").alias("mindate"),
        F.date_format("max_date", "yyyy-MM-dd").alias("maxdate"),
        F.col("data_coverage").alias("datacoverage"),
    )


def as_variant(df: DataFrame, column: str, fields: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Records as one VARIANT column (what a staging table holds)."""
    return df.select(F.parse_json(F.to_json(F.struct(*fields))).alias(column), *keep)


def write_array_files(df: DataFrame, path: str, order_col: str, rows_per_file: int = 10_000) -> str:
    """Write ``df`` as JSON array files, ordered by ``order_col`` inside each.

    ``order_col`` must be unique: rows are spread over files by its hash,
    so every file holds about ``rows_per_file`` rows whatever the keys'
    skew, and the number of files grows with the data.
    """
    n = max(1, math.ceil(df.count() / rows_per_file))
    payload = [c for c in df.columns if c != order_col]
    bucket = F.pmod(F.xxhash64(F.col(order_col)), F.lit(n)).alias("bucket")
    grouped = df.select(bucket, F.struct(F.col(order_col).alias("__o"), *payload).alias("r")).groupBy("bucket").agg(
        F.array_sort(F.collect_list("r")).alias("rs"))
    text = grouped.select(
        "bucket",
        F.to_json(F.transform("rs", lambda r: F.struct(*[r[c].alias(c) for c in payload]))).alias("value"),
    )
    text.write.partitionBy("bucket").text(path)
    return path
