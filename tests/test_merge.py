
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stationday.operators.dedupe import dedupe_latest
from stationday.operators.merge import coalesce_source_target, merge_frames, merge_into
from stationday.plans.stages import OBSERVATION_UPDATES, STATION_UPDATES
from stationday.schemas import DAILY_TEMPS, OBSERVATIONS, OBSERVATIONS_SCHEMA, STATIONS_SCHEMA, DAILY_TEMPS_SCHEMA
from stationday.sources.tables import overwrite_table

D = dt.datetime


def obs(spark, rows):
    return spark.createDataFrame(rows, OBSERVATIONS_SCHEMA)


def upsert_obs(spark, tables, src, **kw):
    return merge_into(spark, tables.name("observations"), OBSERVATIONS, src,
                      update={c: "source" for c in OBSERVATION_UPDATES}, **kw)


def read(spark, tables, key="observations", spec=OBSERVATIONS):
    return sorted((tuple(r) for r in spec.logical(spark.table(tables.name(key))).collect()), key=repr)


BASE = [
    (D(2020, 1, 1), "TMAX", "S1", "a", 50.0),
    (D(2020, 1, 1), "TMIN", "S1", "a", 20.0),
    (D(2020, 2, 1), "TMAX", "S1", "a", 55.0),
    (None, "TMAX", "S9", "n", 1.0),
]


def test_insert_then_update(spark, tables):
    upsert_obs(spark, tables, obs(spark, BASE))
    assert read(spark, tables) == sorted(BASE, key=repr)
    upsert_obs(spark, tables, obs(spark, [(D(2020, 1, 1), "TMAX", "S1", "b", 60.0),
                                          (D(2020, 1, 2), "TMAX", "S1", "c", 61.0)]))
    got = {(r[0], r[1], r[2]): (r[3], r[4]) for r in read(spark, tables) if r[0] is not None}
    assert got[(D(2020, 1, 1), "TMAX", "S1")] == ("b", 60.0)
    assert got[(D(2020, 1, 2), "TMAX", "S1")] == ("c", 61.0)
    assert got[(D(2020, 1, 1), "TMIN", "S1")] == ("a", 20.0)
    assert len(read(spark, tables)) == 5


def test_same_source_twice_equals_once(spark, tables):
    src = obs(spark, BASE[:3])
    upsert_obs(spark, tables, src)
    once = read(spark, tables)
    upsert_obs(spark, tables, src)
    assert read(spark, tables) == once


def test_disjoint_sources_commute(spark, tables):
    from stationday.config import PipelineConfig
    from stationday.plans.stages import setup

    a = obs(spark, BASE[:2])
    b = obs(spark, [(D(2020, 3, 1), "TMAX", "S2", "z", 9.0), (D(2020, 1, 1), "TMAX", "S2", "z", 8.0)])
    upsert_obs(spark, tables, a)
    upsert_obs(spark, tables, b)
    other = setup(spark, PipelineConfig.fresh(spark, "test"))
    upsert_obs(spark, other, b)
    upsert_obs(spark, other, a)
    assert read(spark, tables) == read(spark, other)


def _files(root, part):
    d = os.path.join(root, part)
    return sorted(f for f in os.listdir(d) if f.endswith(".parquet"))


def test_untouched_partitions_keep_their_files(spark, tables):
    upsert_obs(spark, tables, obs(spark, BASE[:3]))
    root = tables.path("observations").removeprefix("file:")
    feb_before = _files(root, "obs_period=2020-02-01")
    jan_before = _files(root, "obs_period=2020-01-01")
    r = upsert_obs(spark, tables, obs(spark, [(D(2020, 1, 1), "TMAX", "S2", "q", 1.0)]))
    assert [x[0] for x in r.touched.distinct().collect()] == [dt.date(2020, 1, 1)]
    assert _files(root, "obs_period=2020-02-01") == feb_before
    assert _files(root, "obs_period=2020-01-01") != jan_before
    assert len(read(spark, tables)) == 4


def test_null_partition_keeps_its_rows(spark, tables):
    upsert_obs(spark, tables, obs(spark, BASE))
    # a NULL key never matches: the new row is inserted beside the old one
    upsert_obs(spark, tables, obs(spark, [(None, "TMAX", "S9", "n2", 2.0)]))
    nulls = [r for r in read(spark, tables) if r[0] is None]
    assert sorted(r[3] for r in nulls) == ["n", "n2"]
    # dropped instead when asked (the stream does), and counted
    r = upsert_obs(spark, tables, obs(spark, [(None, "TMAX", "S9", "n3", 3.0)]), null_keys="drop")
    assert r.dropped_null_keys == 1 and len([x for x in read(spark, tables) if x[0] is None]) == 2


def test_more_than_ten_thousand_periods(spark, tables):
    days = 10_500
    every = spark.range(days).select(
        F.date_add(F.lit(dt.date(1990, 1, 1)), F.col("id").cast("int")).cast("timestamp_ntz").alias("observation_date"),
        F.lit("TMAX").alias("datatype"), F.lit("S1").alias("station_id"), F.lit("a").alias("attributes"),
        F.col("id").cast("double").alias("obs_value"))
    spec, name = tables.spec("observations"), tables.name("observations")
    overwrite_table(spec.with_partition(every), name)
    root = tables.path("observations").removeprefix("file:")
    parts = [x for x in os.listdir(root) if x.startswith("obs_period=")]
    assert len(parts) == days
    before = {p: os.stat(os.path.join(root, p)).st_mtime_ns for p in parts}
    r = upsert_obs(spark, tables, every.filter("obs_value % 21 = 0").withColumn("obs_value", F.lit(-1.0)))
    changed = [p for p in parts if os.stat(os.path.join(root, p)).st_mtime_ns != before[p]]
    assert r.source_rows == r.touched.count() == len(changed) == 500
    assert spark.table(name).filter("obs_value = -1").count() == 500 and spark.table(name).count() == days


def test_dropped_null_keys_are_all_counted(spark, tables):
    rows = [(D(2020, m, 1), "TMAX", "S1", "a", 1.0) for m in range(1, 13)]
    rows += [(D(2020, m, 1), "TMAX", None, "a", 1.0) for m in range(1, 13)] + [(None, "TMAX", "S1", "a", 1.0)] * 12
    r = upsert_obs(spark, tables, obs(spark, rows), null_keys="drop")
    assert (r.dropped_null_keys, r.source_rows) == (24, 12)
    assert len(read(spark, tables)) == 12


def test_duplicate_source_keys(spark, tables):
    dup = [(D(2020, 1, 1), "TMAX", "S1", "x", 1.0), (D(2020, 1, 1), "TMAX", "S1", "y", 2.0)]
    with pytest.raises(ValueError, match="duplicate"):
        upsert_obs(spark, tables, obs(spark, dup), on_duplicate="error")
    upsert_obs(spark, tables, obs(spark, dup))  # latest: greatest (value, attributes) without an order
    assert read(spark, tables) == [(D(2020, 1, 1), "TMAX", "S1", "y", 2.0)]


def test_dedupe_latest_orders_then_breaks_ties(spark):
    df = spark.createDataFrame([("k", 1, 5.0, "a"), ("k", 2, 1.0, "b"), ("k", 2, 1.0, "c"), ("j", None, 0.0, "z")],
                               "k string, seq int, v double, s string")
    got = {r.k: (r.seq, r.v, r.s) for r in dedupe_latest(df, ["k"], order=["seq"], tiebreak=["v", "s"]).collect()}
    assert got == {"k": (2, 1.0, "c"), "j": (None, 0.0, "z")}


def test_dedupe_pre_aggregates_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedupe_latest(df, ["k"], order=["v"])._jdf.queryExecution().executedPlan().toString()
    # partial aggregate below the exchange: a hot key ships one row per map task
    assert plan.index("Exchange") < plan.rindex("partial_max")


def test_partial_update_of_stations(spark, tables):
    spec = tables.spec("stations")
    d = dt.date
    t = spark.createDataFrame([("S1", "Old", 1.0, 2.0, 3.0, "METERS", d(2020, 1, 1), d(2020, 2, 1), 0.5)],
                              STATIONS_SCHEMA)
    overwrite_table(spec.with_partition(t), tables.name("stations"))
    s = spark.createDataFrame([("S1", "New", 1.5, 2.5, 3.5, "FEET", d(2019, 1, 1), d(2021, 1, 1), 0.9),
                               ("S2", "Two", 0.0, 0.0, 0.0, "FEET", None, None, 0.1)], STATIONS_SCHEMA)
    merge_into(spark, tables.name("stations"), spec, s, update={c: "source" for c in STATION_UPDATES})
    got = {r[0]: r for r in read(spark, tables, "stations", spec)}
    assert got["S1"] == ("S1", "New", 1.5, 2.5, 3.5, "METERS", d(2019, 1, 1), d(2021, 1, 1), 0.5)
    assert got["S2"][5] == "FEET" and got["S2"][8] == 0.1


def test_coalesce_keeps_old_value(spark, tables):
    d = dt.date
    t = spark.createDataFrame([(d(2020, 1, 1), "S1", 50.0, 20.0)], DAILY_TEMPS_SCHEMA)
    overwrite_table(DAILY_TEMPS.with_partition(t), tables.name("daily_temps"))
    s = spark.createDataFrame([(d(2020, 1, 1), "S1", None, 25.0), (d(2020, 1, 2), "S1", None, 1.0)],
                              DAILY_TEMPS_SCHEMA)
    merge_into(spark, tables.name("daily_temps"), DAILY_TEMPS, s,
               update={"tmax": coalesce_source_target("tmax"), "tmin": coalesce_source_target("tmin")})
    got = read(spark, tables, "daily_temps", DAILY_TEMPS)
    assert got == [(d(2020, 1, 1), "S1", 50.0, 25.0), (d(2020, 1, 2), "S1", None, 1.0)]


def test_merge_frames_insert_subset(spark):
    t = spark.createDataFrame([("a", 1, "t")], "k string, v int, w string")
    s = spark.createDataFrame([("a", 2, "s"), ("b", 3, "s")], "k string, v int, w string")
    out = merge_frames(t, s, ["k"], update={"v": "source"}, insert=["k", "v"])
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2, "t"), ("b", 3, None)]


def test_empty_source_changes_nothing(spark, tables):
    upsert_obs(spark, tables, obs(spark, BASE[:2]))
    before = read(spark, tables)
    r = upsert_obs(spark, tables, obs(spark, []))
    assert r.source_rows == 0 and read(spark, tables) == before


def test_row_number_form_picks_the_same_survivors(spark):
    from stationday.operators.dedupe import dedupe_by_row_number

    df = spark.range(3000).select((F.col("id") % 97).alias("k"), (F.col("id") * 7 % 1000).alias("seq"),
                                  F.col("id").cast("string").alias("v"))
    a = sorted(tuple(r) for r in dedupe_latest(df, ["k"], order=["seq"], tiebreak=["v"]).collect())
    b = sorted(tuple(r) for r in dedupe_by_row_number(df, ["k"], [F.desc("seq"), F.desc("v")]).collect())
    assert a == b and len(a) == 97
