"""Scalar functions: the reference's unit cases, bounds and NULLs (FIXTURES.md section 1)."""

import math

import pytest

from stationday.functions import avg_temp, call_by_name, outlier_label, register_sql_functions, temp_change
from stationday.functions.registry import AVG_TEMP_FN, OUTLIER_FN, TEMP_CHANGE_FN

AVG_CASES = [(100.0, 60.0, 80.0), (None, 60.0, None), (100.0, None, None)]
CHANGE_CASES = [(30.0, 10.0, 20.0), (15.0, 15.0, 0.0), (10.0, 15.0, -5.0),
                (None, 10.0, None), (10.0, None, None), (None, None, None)]
BOTH, MAX, MIN, NEITHER = ("Both TMAX and TMIN are outliers", "TMAX is an outlier",
                           "TMIN is an outlier", "Neither TMAX nor TMIN is an outlier")
OUTLIER_CASES = [(110.0, 10.0, BOTH), (110.0, 30.0, MAX), (70.0, 5.0, MIN), (75.0, 50.0, NEITHER),
                 (60.0, 30.0, MAX), (80.0, 65.0, MIN), (68.0, 14.0, NEITHER), (104.0, 59.0, NEITHER),
                 (None, 30.0, None), (70.0, None, None), (float("nan"), 30.0, MAX)]


def _frame(spark, cases):
    return spark.createDataFrame(cases, "tmax double, tmin double, expected " +
                                 ("string" if isinstance(cases[0][2], str) else "double"))


def _check(rows):
    for r in rows:
        if r.expected is None:
            assert r.got is None, r
        elif isinstance(r.expected, float):
            assert math.isclose(r.got, r.expected), r
        else:
            assert r.got == r.expected, r


def test_avg_temp(spark):
    _check(_frame(spark, AVG_CASES).withColumn("got", avg_temp("tmax", "tmin")).collect())


def test_temp_change(spark):
    _check(_frame(spark, CHANGE_CASES).withColumn("got", temp_change("tmax", "tmin")).collect())


def test_outlier_label(spark):
    _check(_frame(spark, OUTLIER_CASES).withColumn("got", outlier_label("tmax", "tmin")).collect())


def test_outlier_thresholds_are_parameters(spark):
    df = spark.createDataFrame([(20.0, 0.0)], "tmax double, tmin double")
    got = df.select(outlier_label("tmax", "tmin", (10, 30), (-5, 5)).alias("x")).first().x
    assert got == NEITHER


DB = "default"


def test_thresholds_come_from_the_config(spark):
    from stationday.config import PipelineConfig
    from stationday.plans.stages import setup

    cfg = PipelineConfig.fresh(spark, "test", tmax_range=(0.0, 10.0), tmin_range=(0.0, 10.0))
    setup(spark, cfg)
    df = _frame(spark, [(5.0, 5.0, None)])
    assert df.select(call_by_name(f"{cfg.analytics_db}.{OUTLIER_FN}", "tmax", "tmin")).first()[0] == NEITHER


# Input and output cases that must equal the source's.
@pytest.mark.parametrize("name,col_fn,cases", [
    (AVG_TEMP_FN, avg_temp, AVG_CASES),
    (TEMP_CHANGE_FN, temp_change, CHANGE_CASES),
    (OUTLIER_FN, outlier_label, OUTLIER_CASES),
])
def test_sql_functions_match_columns(spark, name, col_fn, cases):
    register_sql_functions(spark, DB)
    name = f"{DB}.{name}"
    df = _frame(spark, cases)
    _check(df.withColumn("got", call_by_name(name, "tmax", "tmin")).collect())
    # callable from SQL text too
    df.createOrReplaceTempView("fx")
    _check(spark.sql(f"SELECT tmax, tmin, expected, {name}(tmax, tmin) AS got FROM fx").collect())


def test_sql_average_check_passes(spark):
    """The reference's SQL check: average of 100 and 60 is 80, as a Pass/Fail column."""
    register_sql_functions(spark, DB)
    r = spark.newSession().sql(f"""SELECT 100 AS tmax_value, 60 AS tmin_value,
        {DB}.{AVG_TEMP_FN}(100, 60) AS avg_temp,
        CASE WHEN {DB}.{AVG_TEMP_FN}(100, 60) = 80 THEN 'Pass' ELSE 'Fail' END AS test_status""").first()
    assert r.avg_temp == 80.0 and r.test_status == "Pass"


def test_no_python_worker_in_plan(spark):
    register_sql_functions(spark, DB)
    df = _frame(spark, CHANGE_CASES).select(
        avg_temp("tmax", "tmin"), temp_change("tmax", "tmin"), outlier_label("tmax", "tmin"),
        call_by_name(f"{DB}.{OUTLIER_FN}", "tmax", "tmin"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
