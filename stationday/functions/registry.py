"""Functions callable by name from SQL and from ``call_function`` (UF4).

They are registered as SQL functions (``CREATE FUNCTION db.f(...) RETURN
expr``) in a database, where any session of the catalog finds them by their
qualified names. Catalyst inlines them into the calling plan, so a call by name
costs the same as the Column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from stationday.functions.temperature import OUTLIER_LABELS, TMAX_RANGE, TMIN_RANGE

# Names inside the analytics database.
AVG_TEMP_FN = "calculate_daily_avg_temp"
TEMP_CHANGE_FN = "daily_temperature_changes"
OUTLIER_FN = "outlier"


def register_sql_functions(
    spark: SparkSession,
    db: str,
    tmax_range=TMAX_RANGE,
    tmin_range=TMIN_RANGE,
) -> list[str]:
    """Create the three functions in a database; returns their qualified names."""
    both, only_max, only_min, neither = OUTLIER_LABELS
    lo_x, hi_x = (float(v) for v in tmax_range)
    lo_n, hi_n = (float(v) for v in tmin_range)
    spark.sql(
        f"CREATE OR REPLACE FUNCTION `{db}`.{AVG_TEMP_FN}(tmax DOUBLE, tmin DOUBLE) "
        "RETURNS DOUBLE RETURN (tmax + tmin) / 2"
    )
    spark.sql(
        f"CREATE OR REPLACE FUNCTION `{db}`.{TEMP_CHANGE_FN}(tmax DOUBLE, tmin DOUBLE) "
        "RETURNS DOUBLE RETURN tmax - tmin"
    )
    spark.sql(
        f"CREATE OR REPLACE FUNCTION `{db}`.{OUTLIER_FN}(tmax DOUBLE, tmin DOUBLE) "
        "RETURNS STRING RETURN CASE "
        "WHEN tmax IS NULL OR tmin IS NULL THEN CAST(NULL AS STRING) "
        f"WHEN NOT (tmax BETWEEN {lo_x} AND {hi_x}) AND NOT (tmin BETWEEN {lo_n} AND {hi_n}) THEN '{both}' "
        f"WHEN NOT (tmax BETWEEN {lo_x} AND {hi_x}) THEN '{only_max}' "
        f"WHEN NOT (tmin BETWEEN {lo_n} AND {hi_n}) THEN '{only_min}' "
        f"ELSE '{neither}' END"
    )
    return [f"{db}.{f}" for f in (AVG_TEMP_FN, TEMP_CHANGE_FN, OUTLIER_FN)]


def call_by_name(name: str, *cols) -> Column:
    """Call a registered function by its (qualified) name on columns."""
    return F.call_function(name, *[F.col(c) if isinstance(c, str) else c for c in cols])
