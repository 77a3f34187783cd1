"""Pivot kinds of measurement into columns (A2, A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.operators.parse import clean_column_names, ensure_columns
from stationday.schemas import DAILY_TEMPS_SCHEMA


def pivot_max(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
              value_col: str, names: Sequence[str] | None = None, method: str = "when") -> DataFrame:
    """``max(value_col)`` per key and per pivot value, one column per value.

    ``method="when"`` writes ``max(CASE WHEN pivot_col = v THEN value END)``
    for each value after an ``IN`` filter: one hash aggregate with a partial
    step before the only shuffle. ``method="pivot"`` uses ``groupBy().pivot()``
    with the explicit value list (no discovery job), which Spark plans as a
    two-phase aggregate with two shuffles; both give the same rows.
    """
    names = list(names or values)
    # only rows of the listed kinds form groups (filter pushed to the scan)
    f = df.filter(F.col(pivot_col).isin(list(values)))
    if method == "pivot":
        out = f.groupBy(*keys).pivot(pivot_col, list(values)).agg(F.max(value_col))
        return out.toDF(*keys, *names)
    if method != "when":
        raise ValueError(f"unknown pivot method {method!r}")
    aggs = [F.max(F.when(F.col(pivot_col) == F.lit(v), F.col(value_col))).alias(n) for v, n in zip(values, names)]
    return f.groupBy(*keys).agg(*aggs)


def daily_temps(observations: DataFrame, values: Sequence[str] = ("TMAX", "TMIN"),
                method: str = "when") -> DataFrame:
    """Observations -> one row per (date, station) with tmax and tmin.

    Filter to the two kinds (pushed to the Parquet scan), cast the
    timestamp to a date, pivot with ``max``, clean the names and add a
    kind that has no rows at all as a typed NULL column.
    """
    obs = observations.select("observation_date", "station_id", "datatype", "obs_value")
    obs = obs.filter(F.col("datatype").isin(list(values)))
    obs = obs.withColumn("observation_date", F.col("observation_date").cast("date"))
    piv = pivot_max(obs, ["observation_date", "station_id"], "datatype", values, "obs_value",
                    names=[v.lower() for v in values], method=method)
    piv = clean_column_names(piv)
    return ensure_columns(piv, DAILY_TEMPS_SCHEMA)
