"""Joins by time, frames, runs, snapshots and event-time windows against plain models."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stationday.operators.frames import rolling, runs
from stationday.operators.summaries import by_grouping_sets, merged, sketch, snapshot_diff
from stationday.operators.temporal_joins import asof_join, interval_join

T0 = dt.datetime(2024, 1, 1)
DAY0 = dt.date(2024, 1, 1)


def moment(rng, hours=2000):
    return None if rng.random() < 0.05 else T0 + dt.timedelta(hours=rng.randrange(hours))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("strict,tolerance,span", [(False, None, 7 * 86400), (True, None, 3600), (False, 20 * 3600, 86400), (True, 0, 86400)])
def test_asof_join_matches_plain_search(spark, strict, tolerance, span):
    rng = random.Random(1)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    left = [(i, key(), moment(rng)) for i in range(300)] + [(1000, "hot", T0), (1000, "hot", T0)]
    right = [(key(), moment(rng, 1500), rng.randrange(50)) for _ in range(200)] + [("hot", T0, 1), ("hot", T0, 9)]
    ld = spark.createDataFrame(left, "id int, k string, at timestamp").repartition(5)
    rd = spark.createDataFrame(right, "k string, at timestamp, v int").repartition(3)
    got = rows_of(asof_join(ld, rd, ["k"], "at", ["v"], strict=strict, tolerance=tolerance, span=span))
    want = []
    for i, k, at in left:
        fits = [(t, v) for k2, t, v in right if k is not None and k2 == k and at and t and (t < at if strict else t <= at)]
        best = max(fits, default=(None, None))
        if best[0] and tolerance is not None and (at - best[0]).total_seconds() > tolerance:
            best = (None, None)
        want.append((i, k, at, *best))
    assert got == sorted(want, key=str)


def test_asof_join_has_no_loop_join_and_prunes(spark):
    ld = spark.createDataFrame([(1, "a", T0)], "id int, k string, at timestamp")
    rd = spark.createDataFrame([("a", T0, 1)], "k string, at timestamp, v int")
    for df in (asof_join(ld, rd, ["k"], "at", ["v"]), interval_join(ld, rd.select("k", F.col("at").alias("s"), F.col("at").alias("e")), ["k"], "at", "s", "e")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("closed", [True, False])
def test_interval_join_matches_all_pairs(spark, closed):
    rng = random.Random(2)
    key = lambda: rng.choice(["hot"] * 5 + ["a", None])
    points = [(i, key(), moment(rng, 30000)) for i in range(250)]
    periods = []
    for i in range(120):
        s = moment(rng, 30000)
        n = rng.choice([0, 1, 24, 24 * 4, 24 * 5, 24 * 17, 24 * 90, 24 * 4000, -3])
        periods.append((1000 + i, key(), s, s and s + dt.timedelta(hours=n)))
    pd_ = spark.createDataFrame(points, "id int, k string, at timestamp").repartition(4)
    ed = spark.createDataFrame(periods, "pid int, k string, s timestamp, e timestamp").repartition(3)
    got = rows_of(interval_join(pd_, ed, ["k"], "at", "s", "e", closed=closed).select("id", "pid"))
    want = [(i, p) for i, k, at in points for p, k2, s, e in periods if k and k == k2 and at and s and s <= at and (at <= e if closed else at < e)]
    assert got == sorted(want, key=str) and len(want) > 100
    assert interval_join(pd_, ed.limit(0), ["k"], "at", "s", "e").count() == 0


def daily_rows(rng, n=400):
    return [(rng.choice(["hot"] * 6 + ["a", None]), None if rng.random() < 0.03 else DAY0 + dt.timedelta(days=rng.randrange(90)), rng.choice([None, *range(20)])) for _ in range(n)]


@pytest.mark.parametrize("days,period", [(7, 10), (1, 4), (30, 7), (7, 1000)])
def test_rolling_matches_plain_frames(spark, days, period):
    rows = daily_rows(random.Random(3))
    df = spark.createDataFrame(rows, "k string, day date, v int").repartition(4)
    got = rows_of(rolling(df, ["k"], "day", days, {"top": F.max("v"), "n": F.count("v")}, period=period))
    want = []
    for k, d, v in rows:
        own = [x for k2, d2, x in rows if d and d2 and k2 == k and 0 <= (d - d2).days < days and x is not None]
        want.append((k, d, v, max(own, default=None) if d else None, len(own) if d else None))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("period", [1, 7, 500])
def test_runs_match_plain_walk(spark, period):
    rows = daily_rows(random.Random(4))
    df = spark.createDataFrame(rows, "k string, day date, v int").repartition(4)
    got = rows_of(runs(df, ["k"], "day", F.col("v") > 6, period=period))
    want = []
    for k in ("hot", "a", None):
        days = sorted({d for k2, d, v in rows if k2 == k and d and v is not None and v > 6})
        for d in days:
            if want and want[-1][0] == k and (d - want[-1][2]).days == 1:
                want[-1] = (k, want[-1][1], d, want[-1][3] + 1)
            else:
                want.append((k, d, d, 1))
    assert got == sorted(want, key=str)


def test_grouping_sets_tell_nulls_from_totals(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 1, 2), (None, 1, 4)], "k string, m int, v int")
    got = rows_of(by_grouping_sets(df, [["k", "m"], ["m"], []], {"total": F.sum("v")}))
    want = [("a", None, 0, 1), ("a", 1, 0, 2), (None, 1, 0, 4), (None, None, 2, 1), (None, 1, 2, 6), (None, None, 3, 7)]
    assert got == sorted(want, key=str)
    plan = by_grouping_sets(df, [["k"], []], {"total": F.sum("v")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and "partial_sum" in plan


def test_sketches_roll_up_within_their_error(spark):
    df = spark.range(60000).select((F.col("id") % 7).alias("day"), (F.col("id") % 3).alias("kind"), F.pmod(F.xxhash64("id"), F.lit(20000)).alias("v"))
    rolled = {r["kind"]: r["approx_distinct"] for r in merged(sketch(df, ["day", "kind"], "v"), ["kind"]).collect()}
    exact = {r["kind"]: r["n"] for r in df.groupBy("kind").agg(F.countDistinct("v").alias("n")).collect()}
    for kind, n in exact.items():
        assert abs(rolled[kind] - n) <= 3 * 0.0065 * n


def test_snapshot_diff_turns_one_into_the_other(spark):
    rng = random.Random(5)
    row = lambda: (rng.choice([None, *range(25)]), rng.choice(["x", "y", None]), rng.choice([1.5, None]))
    before, after = [row() for _ in range(80)], [row() for _ in range(80)]
    schema = "k int, a string, b double"
    diff = snapshot_diff(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), ["k"]).collect()
    left = list(before)
    for r in diff:
        for _ in range(r["copies"]):
            if r["change"] == "delete":
                left.remove((r["k"], r["a"], r["b"]))
            elif r["change"] == "update":
                left.remove((r["k"], r["old_a"], r["old_b"]))
            if r["change"] != "delete":
                left.append((r["k"], r["a"], r["b"]))
    assert sorted(left, key=str) == sorted(after, key=str)
    assert {r["change"] for r in diff} == {"insert", "delete", "update"}
    changed = [r["k"] for r in diff if r["change"] == "update"]
    assert all(sum(x["k"] == k for x in diff) == 1 for k in changed)


def test_windows_and_late_rows_hold_every_row_once(spark, scratch):
    """Over restarts, and when a batch is replayed."""
    from stationday.streaming.windows import close_windows, keep_late_rows, landed, windowed

    rng = random.Random(6)
    drops = [[(i * 100 + n, T0 + dt.timedelta(days=4 * i + rng.uniform(-5, 4))) for n in range(60)] for i in range(4)]
    drops.append([(900, T0 + dt.timedelta(days=60)), (901, None)])
    closed, late = f"{scratch}/closed", f"{scratch}/late"
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, "id long, at timestamp").write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{scratch}/land/d{i}")
        stream = lambda: landed(spark, f"{scratch}/land", "id long, at timestamp")
        w = windowed(stream(), "at", "2 DAYS", F.window("at", "1 day"), [], {"n": F.count(F.lit(1)), "ids": F.sort_array(F.collect_list("id"))})
        close_windows(spark, w, closed, f"{scratch}/c1")
        keep_late_rows(spark, stream(), "at", "2 DAYS", lambda at: F.date_trunc("day", at) + F.expr("INTERVAL 1 DAY"), late, f"{scratch}/c2")
    in_windows = [i for r in spark.read.parquet(closed).collect() for i in r["ids"]]
    aside = [r["id"] for r in spark.read.parquet(late).collect()]
    assert aside and sorted(in_windows + aside) == sorted(i for rows in drops for i, _ in rows if i < 900)


def test_merged_states_equal_one_pass():
    import pandas as pd

    from stationday.streaming.anomalies import merge

    rng = random.Random(8)
    values = [rng.uniform(-50, 50) for _ in range(200)]
    state = (0, 0.0, 0.0)
    for lo, hi in ((0, 1), (1, 60), (60, 60), (60, 200)):
        state = merge(*state, pd.Series(values[lo:hi], dtype=float))
    mean = sum(values) / 200
    assert state[0] == 200 and state[1] == pytest.approx(mean) and state[2] == pytest.approx(sum((v - mean) ** 2 for v in values))


def test_station_state_survives_restarts_and_expires(spark, scratch):
    from stationday.streaming.anomalies import anomalies
    from stationday.streaming.windows import close_windows, landed

    day = lambda n: T0 + dt.timedelta(days=n)
    steady = [(i, day(i % 3), "a", 20.0 + i % 3) for i in range(30)]
    drops = [
        steady,
        [(100, day(4), "a", 90.0), (101, day(4), "a", 21.0), (102, day(4), "new", 90.0), (103, day(4), None, 1.0), (104, None, "a", 99.0), (105, day(4), "a", None)],
        [(200, day(60), "b", 1.0)],  # a is silent: its timer is due
        [(300, day(61), "a", 500.0)],  # and it starts anew
    ]
    schema = "event_id long, at timestamp, station_id string, value double"
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, schema).write.json(f"{scratch}/land/d{i}")
        close_windows(spark, anomalies(landed(spark, f"{scratch}/land", schema), keep_days=20), f"{scratch}/odd", f"{scratch}/ckpt")
    assert [r["event_id"] for r in spark.read.parquet(f"{scratch}/odd").collect()] == [100]


def test_a_batch_of_states_merges_as_each_alone():
    import numpy as np
    import pandas as pd

    from stationday.streaming.anomalies import merge, merge_all

    rng = np.random.default_rng(5)
    at, values = rng.integers(0, 7, 300), rng.normal(10, 3, 300)
    at[at == 3] = 4  # station 3 sends nothing
    n, mean, m2 = np.array([0, 4, 0, 2, 1, 9, 3]), rng.normal(10, 3, 7), rng.uniform(0, 9, 7)
    got = merge_all(n, mean, m2, at, values)
    for i in range(7):
        want = merge(int(n[i]), float(mean[i]), float(m2[i]), pd.Series(values[at == i], dtype=float))
        assert [x[i] for x in got] == pytest.approx(list(want))
    assert merge_all(n, mean, m2, at[:0], values[:0]) == (n, mean, m2)


def test_stations_share_state_rows_and_expire_alone(spark, scratch):
    from stationday.streaming.anomalies import anomalies
    from stationday.streaming.windows import close_windows, landed

    day = lambda n: T0 + dt.timedelta(days=n)
    drops = [
        [(100 * s + i, day(i % 3), f"s{s}", 20.0 + s + i % 3) for s in range(12) for i in range(9)],
        [(9000 + s, day(15), f"s{s}", 500.0 if s % 3 else 21.0 + s) for s in range(0, 12, 2)],  # the odd ones are silent
        [(9100, day(30), "s2", None)],  # their state is due, that of the even ones is not
        [(9200 + s, day(31), f"s{s}", 9e9) for s in range(12)],
        [(9300 + s, day(2), f"s{s}", -9e9) for s in range(12)],  # too late
    ]
    schema = "event_id long, at timestamp, station_id string, value double"
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, schema).write.json(f"{scratch}/land/d{i}")
        close_windows(spark, anomalies(landed(spark, f"{scratch}/land", schema), keep_days=20, groups=2), f"{scratch}/odd", f"{scratch}/ckpt")
        assert spark.read.format("statestore").load(f"{scratch}/ckpt").count() <= 2
    found = {r["event_id"]: r["station_id"] for r in spark.read.parquet(f"{scratch}/odd").collect()}
    assert found == {9000 + s: f"s{s}" for s in (2, 4, 8, 10)} | {9200 + s: f"s{s}" for s in range(0, 12, 2)}
