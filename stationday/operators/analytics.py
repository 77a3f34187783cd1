"""Join to stations, per-day functions and grouped averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.functions.temperature import avg_temp, temp_change

ANALYTICS_KEYS = ("observation_date", "station_id", "station_name")


def join_dimension(daily: DataFrame, stations: DataFrame) -> DataFrame:
    """Inner equi-join of daily rows to station names; rows without a station drop out.

    Only ``station_id`` and ``name`` of the dimension are read (column
    pruning reaches the scan). No broadcast hint: AQE broadcasts the
    dimension when its measured size is under the broadcast threshold and
    falls back to a sort-merge join with skew splitting otherwise.
    """
    dim = stations.select("station_id", F.col("name").alias("station_name"))
    return daily.join(dim, "station_id", "inner").select(
        "observation_date", "station_id", "station_name", "tmax", "tmin")


def with_daily_functions(df: DataFrame, avg_fn=avg_temp, change_fn=temp_change) -> DataFrame:
    return df.withColumn("tavg", avg_fn("tmax", "tmin")).withColumn(
        "daily_temp_change", change_fn("tmax", "tmin"))


def group_averages(df: DataFrame) -> DataFrame:
    """Average of the four measures per (date, station, name); NULLs ignored (A3)."""
    return df.groupBy(*ANALYTICS_KEYS).agg(
        F.avg("tmax").alias("avg_tmax"),
        F.avg("tmin").alias("avg_tmin"),
        F.avg("tavg").alias("avg_tavg"),
        F.avg("daily_temp_change").alias("avg_daily_temp_change"),
    )


def grouped_average(df: DataFrame, keys, measures: dict) -> DataFrame:
    """``avg`` of each measure per group, named by ``measures`` keys (A3, general form)."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(name) for name, c in measures.items()])


def station_analytics(daily: DataFrame, stations: DataFrame, avg_fn=avg_temp, change_fn=temp_change) -> DataFrame:
    return group_averages(with_daily_functions(join_dimension(daily, stations), avg_fn, change_fn))


def order_latest_first(df: DataFrame, *tiebreak: str) -> DataFrame:
    """Date descending, then station ascending (O1); applied when reading."""
    return df.orderBy(F.desc("observation_date"), F.asc("station_id"), *[F.asc(c) for c in tiebreak])


def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows by an order (O2): a top-k, planned as TakeOrderedAndProject."""
    return df.orderBy(*order).limit(n)
