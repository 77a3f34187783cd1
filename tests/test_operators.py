"""Pivot, parse helpers, analytics and planning operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationday.operators.analytics import station_analytics, top_n
from stationday.operators.parse import clean_column_names, drop_nulls, ensure_columns, tag_rows
from stationday.operators.pivot import daily_temps, pivot_max
from stationday.operators.planning import filter_window, missing_dimension, page_plan, split_yearly
from stationday.schemas import DAILY_TEMPS_SCHEMA, OBSERVATIONS_SCHEMA

D = dt.datetime


@pytest.fixture()
def observations(spark):
    rows = [
        (D(2020, 1, 1), "TMAX", "S1", None, 50.0), (D(2020, 1, 1), "TMAX", "S1", None, 52.0),
        (D(2020, 1, 1), "TMIN", "S1", None, 20.0), (D(2020, 1, 2), "TMAX", "S1", None, 40.0),
        (D(2020, 1, 2), "PRCP", "S2", None, 3.0), (D(2020, 1, 3), "TMIN", "S2", None, 10.0),
    ]
    return spark.createDataFrame(rows, OBSERVATIONS_SCHEMA)


def test_pivot_methods_agree(observations):
    a = sorted(tuple(r) for r in daily_temps(observations, method="when").collect())
    b = sorted(tuple(r) for r in daily_temps(observations, method="pivot").collect())
    assert a == b == [(dt.date(2020, 1, 1), "S1", 52.0, 20.0), (dt.date(2020, 1, 2), "S1", 40.0, None),
                      (dt.date(2020, 1, 3), "S2", None, 10.0)]


def test_pivot_missing_kind_is_typed_null(observations):
    only_max = observations.filter("datatype = 'TMAX'")
    df = daily_temps(only_max)
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in DAILY_TEMPS_SCHEMA.fields]
    assert all(r.tmin is None for r in df.collect())


def test_pivot_runs_no_discovery_job(spark, observations):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    pivot_max(observations, ["station_id"], "datatype", ["TMAX", "TMIN"], "obs_value", method="pivot")
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_in_filter_reaches_parquet_scan(spark, tables, observations):
    from stationday.schemas import OBSERVATIONS
    from stationday.sources.tables import overwrite_table

    overwrite_table(OBSERVATIONS.with_partition(observations), tables.name("observations"))
    df = daily_temps(spark.table(tables.name("observations")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(datatype" in plan or "In(datatype, [TMAX,TMIN])" in plan


def test_clean_names_and_ensure_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double").toDF(" 'A' ", '"tmax"')
    assert clean_column_names(df).columns == ["A", "tmax"]
    out = ensure_columns(clean_column_names(df), DAILY_TEMPS_SCHEMA)
    assert out.columns == ["observation_date", "station_id", "tmax", "tmin"]
    assert out.first().tmax == 2.0 and out.first().tmin is None


def test_drop_nulls_and_tag(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert drop_nulls(df).count() == 1
    assert tag_rows(df, "zip_code", "02128").filter("zip_code = '02128'").count() == 2


def test_analytics_joins_and_averages(spark):
    d = dt.date
    daily = spark.createDataFrame([(d(2020, 1, 1), "S1", 50.0, 20.0), (d(2020, 1, 1), "S3", 1.0, 1.0),
                                   (d(2020, 1, 2), "S1", None, 10.0)], DAILY_TEMPS_SCHEMA)
    st = spark.createDataFrame([("S1", "One")], "station_id string, name string")
    got = sorted(tuple(r) for r in station_analytics(daily, st).collect())
    assert got == [(d(2020, 1, 1), "S1", "One", 50.0, 20.0, 35.0, 30.0),
                   (d(2020, 1, 2), "S1", "One", None, 10.0, None, None)]


def test_top_n_is_take_ordered(spark):
    df = spark.range(100)
    t = top_n(df, 3, F.desc("id"))
    assert [r.id for r in t.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in t._jdf.queryExecution().executedPlan().toString()


# date chunks (FIXTURES.md section 5): start, end, expected chunks
CHUNKS = [
    ("2020-02-29", "2025-03-01", [("2020-02-29", "2021-02-27"), ("2021-02-28", "2022-02-27"),
                                  ("2022-02-28", "2023-02-27"), ("2023-02-28", "2024-02-27"),
                                  ("2024-02-28", "2025-02-27"), ("2025-02-28", "2025-03-01")]),
    ("2020-01-01", "2021-01-01", [("2020-01-01", "2020-12-31")]),
    ("2020-01-01", "2020-01-01", []),
    ("2023-03-01", "2023-03-02", [("2023-03-01", "2023-03-02")]),
    ("2019-03-01", "2024-05-05", [("2019-03-01", "2020-02-29"), ("2020-03-01", "2021-02-28"),
                                  ("2021-03-01", "2022-02-28"), ("2022-03-01", "2023-02-28"),
                                  ("2023-03-01", "2024-02-29"), ("2024-03-01", "2024-05-05")]),
]


def _reference_loop(a: dt.date, b: dt.date):
    """Restatement of the source's chunk loop, used as brute force."""
    out, cur = [], a
    while cur < b:
        try:
            nxt = cur.replace(year=cur.year + 1)
        except ValueError:
            nxt = cur + dt.timedelta(days=365)
        end = min(nxt - dt.timedelta(days=1), b)
        out.append((cur, end))
        cur = end + dt.timedelta(days=1)
    return out


@pytest.mark.parametrize("a,b,want", CHUNKS)
def test_split_yearly_fixtures(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "s string, e string").select(
        F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    got = [(str(r.chunk_start), str(r.chunk_end)) for r in split_yearly(df, "s", "e").orderBy("chunk_start").collect()]
    assert got == want


def test_split_yearly_matches_loop_on_many_ranges(spark):
    import random

    rnd = random.Random(7)
    pairs = []
    for _ in range(300):
        a = dt.date(2015, 1, 1) + dt.timedelta(days=rnd.randrange(0, 3000))
        pairs.append((a, a + dt.timedelta(days=rnd.randrange(0, 2500))))
    pairs += [(dt.date(2016, 2, 29), dt.date(2024, 2, 29)), (dt.date(2019, 3, 1), dt.date(2024, 5, 5))]
    df = spark.createDataFrame(pairs, "s date, e date")
    got = sorted((r.s, r.chunk_start, r.chunk_end) for r in split_yearly(df, "s", "e").collect())
    want = sorted((a, x, y) for a, b in pairs for x, y in _reference_loop(a, b))
    assert got == want


def test_split_yearly_include_last_day(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2021, 1, 1))], "s date, e date")
    got = [(str(r.chunk_start), str(r.chunk_end)) for r in
           split_yearly(df, "s", "e", include_last_day=True).orderBy("chunk_start").collect()]
    assert got == [("2020-01-01", "2020-12-31"), ("2021-01-01", "2021-01-01")]


@pytest.mark.parametrize("count,offsets", [(0, [1]), (1, [1]), (1000, [1]), (1001, [1, 1001]),
                                           (2000, [1, 1001]), (2001, [1, 1001, 2001])])
def test_page_plan_fixtures(spark, count, offsets):
    df = spark.createDataFrame([(count,)], "n long")
    assert [r.page_offset for r in page_plan(df, "n").collect()] == offsets


def test_missing_dimension_and_window(spark):
    facts = spark.createDataFrame([("S1",), ("S2",), ("S2",), (None,)], "station_id string")
    dim = spark.createDataFrame([("S1", "x")], "station_id string, name string")
    assert sorted(r.station_id or "" for r in missing_dimension(facts, dim, "station_id").collect()) == ["", "S2"]
    rows = spark.createDataFrame([(D(2019, 12, 31, 23), "TMAX"), (D(2020, 1, 1), "TMAX"),
                                  (D(2020, 1, 5, 23, 59), "TMIN"), (D(2020, 1, 6), "TMAX"),
                                  (D(2020, 1, 2), "PRCP")], "ts timestamp_ntz, datatype string")
    got = filter_window(rows, "ts", "2020-01-01", "2020-01-05", kinds=["TMAX", "TMIN"]).count()
    assert got == 2
    assert filter_window(rows, "ts", end="2020-01-10").count() == 4  # start defaults to 2020-01-01
    placed = rows.withColumn("zip_code", F.when(F.dayofmonth("ts") < 3, "02128").otherwise("02130"))
    some = filter_window(placed, "ts", "2020-01-01", "2020-01-10", places=["02128"])
    assert {r.zip_code for r in some.collect()} == {"02128"}
    assert filter_window(placed, "ts", "2020-01-01", "2020-01-10", places=[]).count() == 0


def test_cluster_conf_sizes_shuffles_from_input():
    from stationday.session import cluster_conf

    c = cluster_conf(input_bytes=100 * 2**40, cores=4000)  # 100 TB on 4000 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 409600  # one per 256 MB
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf()["spark.sql.shuffle.partitions"]) == 200
