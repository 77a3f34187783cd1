"""How far each load has come.

A load is committed by its rows in the load log. Its later steps are recorded
as rows of ``load_progress``, written after the step's table; the periods and
new stations it brought are rows of ``load_periods`` and ``load_stations``,
written before. A run takes every load whose step is not recorded, so what a
stopped run left undone is done by the next one, and finished loads are not
merged again. Merging an unfinished load twice changes nothing, save for rows
with a NULL in their key (see ``PipelineConfig.null_keys``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.plans.stages import Tables
from stationday.schemas import LOAD_ID, PERIOD_COL
from stationday.sources.tables import append_table

STEPS = ("stations", "observations", "downstream")


def pending(spark: SparkSession, t: Tables, step: str) -> list[str]:
    """Committed loads without the step, oldest first: one id per unfinished load."""
    done = spark.table(t.name("load_progress")).filter(F.col("step") == step).select(LOAD_ID)
    loads = spark.table(t.name("load_log")).select(LOAD_ID).distinct().join(done, LOAD_ID, "left_anti")
    return [r[0] for r in loads.orderBy(LOAD_ID).collect()]


def mark(spark: SparkSession, t: Tables, loads: list[str], *steps: str) -> None:
    """Record the steps of the loads, in one write."""
    if loads:
        rows = spark.createDataFrame([(x, s) for x in loads for s in steps], f"{LOAD_ID} string, step string")
        append_table(rows.coalesce(1), t.name("load_progress"))


def periods(spark: SparkSession, t: Tables, loads: list[str]) -> DataFrame:
    """Date partitions that the loads' observations fall in."""
    return spark.table(t.name("load_periods")).filter(F.col(LOAD_ID).isin(loads)).select(PERIOD_COL).distinct()


def new_stations(spark: SparkSession, t: Tables, loads: list[str]) -> DataFrame:
    """Stations that were not there before the loads."""
    return spark.table(t.name("load_stations")).filter(F.col(LOAD_ID).isin(loads)).select("station_id").distinct()
