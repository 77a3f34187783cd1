"""Scalar functions of the pipeline as Column expressions (UF1-UF4)."""

from stationday.functions.temperature import (
    OUTLIER_LABELS,
    avg_temp,
    outlier_label,
    temp_change,
)
from stationday.functions.registry import call_by_name, register_sql_functions

__all__ = [
    "OUTLIER_LABELS",
    "avg_temp",
    "temp_change",
    "outlier_label",
    "register_sql_functions",
    "call_by_name",
]
