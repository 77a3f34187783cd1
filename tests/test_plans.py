"""Plan checks: the upsert reads only touched partitions and shuffles only the target."""

import datetime as dt
import re

from pyspark.sql import functions as F

from stationday.operators.merge import in_partitions, merge_frames, merge_into, prepare_source, touched_partitions
from stationday.schemas import OBSERVATIONS, OBSERVATIONS_SCHEMA
from stationday.sources.tables import overwrite_table, session_conf


def test_upsert_plan(spark, tables):
    D = dt.datetime
    rows = [(D(2020, m, 1), "TMAX", f"S{i}", "a", float(i)) for m in (1, 2, 3) for i in range(5)]
    overwrite_table(OBSERVATIONS.with_partition(spark.createDataFrame(rows, OBSERVATIONS_SCHEMA)),
                    tables.name("observations"))
    src = spark.createDataFrame(rows[:5], OBSERVATIONS_SCHEMA)
    prepared = OBSERVATIONS.logical(OBSERVATIONS.with_partition(prepare_source(src, OBSERVATIONS.keys)))
    touched = touched_partitions(src, OBSERVATIONS).select("obs_period")
    target = in_partitions(spark.table(tables.name("observations")), "obs_period", touched)
    merged = merge_frames(OBSERVATIONS.logical(target), prepared, list(OBSERVATIONS.keys),
                          {"obs_value": "source"}, None, OBSERVATIONS.columns)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # the target scan is pruned at run time by the touched partitions
    assert len(re.findall(r"PartitionFilters: \[[^\]]*dynamicpruning", plan)) == 1
    assert "EvalPython" not in plan
    merged.collect()
    files = [x for x in _scan_metrics(merged, "numFiles") if x]
    assert min(files) == 1  # one of three days was read


def _scan_metrics(df, name):
    """A metric of all file scans of an executed plan."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        cls = p.getClass().getSimpleName()
        if cls == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif "QueryStage" in cls:
            todo.append(p.plan())
        if cls == "FileSourceScanExec":
            out.append(p.metrics().apply(name).value())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_writes_bring_a_period_together(spark, tables):
    days = 20
    rows = spark.range(4000).select(
        F.expr("timestamp_ntz '2020-01-01' + make_interval(0, 0, 0, cast(id % 20 as int))").alias("observation_date"),
        F.lit("TMAX").alias("datatype"), F.col("id").cast("string").alias("station_id"),
        F.lit("a").alias("attributes"), F.col("id").cast("double").alias("obs_value")).repartition(40)
    with session_conf(spark, "spark.sql.shuffle.partitions", "64"):
        merge_into(spark, tables.name("observations"), OBSERVATIONS, rows, {"obs_value": "source"})
    files = spark.table(tables.name("observations")).inputFiles()
    assert days <= len(files) <= 2 * days
