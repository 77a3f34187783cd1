"""Whole pipeline runs, modes, guards and the driver contract."""

import os

import pytest
from pyspark.sql import functions as F

from stationday.config import PipelineConfig, fresh_dir
from stationday.plans import derive
from stationday.plans.pipeline import run_pipeline
from stationday.plans.stages import TableNotFound, Tables, require_table, setup
from stationday.schemas import ANALYTICS_SCHEMA, assert_schema

from conftest import SF001


@pytest.fixture(scope="module")
def landed(spark):
    """Duplicate-free raw files from sf0.001: one record per observation key."""
    land = fresh_dir(spark, "test-land")
    ev = derive.table(spark, SF001, "events")
    rec = derive.observation_records(ev)
    uniq = rec.dropDuplicates(["date", "datatype", "station"])
    derive.write_array_files(uniq, f"{land}/weather", "event_id", 300)
    st = derive.station_records(derive.table(spark, SF001, "customer")).withColumn("__o", F.col("id"))
    derive.write_array_files(st, f"{land}/stations", "__o", 100)
    return land


def _all(spark, cfg):
    t = Tables(cfg)
    return {k: sorted((tuple(r) for r in t.spec(k).logical(spark.table(t.name(k))).collect()), key=repr)
            for k in ("stations", "observations", "daily_temps", "analytics")}


def test_refresh_equals_upsert_from_empty(spark, landed):
    a, b = PipelineConfig.fresh(spark, "test"), PipelineConfig.fresh(spark, "test")
    ra = run_pipeline(spark, a, f"{landed}/weather", f"{landed}/stations", mode="refresh")
    rb = run_pipeline(spark, b, f"{landed}/weather", f"{landed}/stations", mode="upsert")
    assert [r.stage for r in ra] == [r.stage for r in rb]
    ta, tb = _all(spark, a), _all(spark, b)
    assert ta == tb and len(ta["analytics"]) > 0
    assert_schema(Tables(a).spec("analytics").logical(spark.table(Tables(a).name("analytics"))), ANALYTICS_SCHEMA)


def test_rerun_is_idempotent(spark, landed):
    cfg = PipelineConfig.fresh(spark, "test")
    run_pipeline(spark, cfg, f"{landed}/weather", f"{landed}/stations", mode="upsert")
    first = _all(spark, cfg)
    run_pipeline(spark, cfg, mode="upsert")  # staging unchanged: same tables
    assert _all(spark, cfg) == first


def test_empty_staging_skips(spark):
    cfg = PipelineConfig.fresh(spark, "test")
    res = run_pipeline(spark, cfg, mode="upsert")
    assert all(r.status.startswith("skipped") for r in res if r.stage != "validate"), res
    assert res[-1].stage == "validate"


def test_guard_when_target_missing(spark):
    with pytest.raises(TableNotFound):
        require_table(spark, "`nowhere`.`observations`")
    t = setup(spark, PipelineConfig.fresh(spark, "test"))
    require_table(spark, t.name("observations"))


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == [f.name for f in ANALYTICS_SCHEMA.fields]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_day_grain_gives_the_same_tables(spark, landed):
    month = PipelineConfig.fresh(spark, "test", fact_grain="month")
    day = PipelineConfig.fresh(spark, "test", fact_grain="day")
    run_pipeline(spark, month, f"{landed}/weather", f"{landed}/stations", mode="upsert")
    run_pipeline(spark, day, f"{landed}/weather", f"{landed}/stations", mode="upsert")
    assert _all(spark, month) == _all(spark, day)
    parts = spark.table(Tables(day).name("observations")).select("obs_period").distinct().count()
    assert parts > 1  # one partition per day


def test_sequence_field_beats_file_time(spark, scratch):
    import json
    import os

    cfg = PipelineConfig.fresh(spark, "test", sequence_field="seq")
    rec = {"date": "2020-01-01T00:00:00", "datatype": "TMAX", "station": "S1", "attributes": ""}
    os.makedirs(f"{scratch}/w", exist_ok=True)
    with open(f"{scratch}/w/new.json", "w") as f:  # newer file, older sequence number
        json.dump([dict(rec, value=1, seq=1)], f)
    with open(f"{scratch}/w/old.json", "w") as f:
        json.dump([dict(rec, value=2, seq=2)], f)
    os.utime(f"{scratch}/w/old.json", (1, 1))
    with open(f"{scratch}/s.json", "w") as f:
        json.dump([{"id": "S1", "name": "One"}], f)
    run_pipeline(spark, cfg, f"{scratch}/w", f"{scratch}/s.json", mode="upsert")
    t = Tables(cfg)
    assert [r.obs_value for r in spark.table(t.name("observations")).collect()] == [2.0]
    plain = PipelineConfig.fresh(spark, "test")
    run_pipeline(spark, plain, f"{scratch}/w", f"{scratch}/s.json", mode="upsert")
    assert [r.obs_value for r in spark.table(Tables(plain).name("observations")).collect()] == [1.0]


def test_lines_input_and_command_line(spark, scratch):
    import json

    from stationday.__main__ import main

    os.makedirs(f"{scratch}/w", exist_ok=True)
    recs = [{"date": "2020-01-01T00:00:00", "datatype": "TMAX", "station": "S1", "attributes": "", "value": 70},
            {"date": "2020-01-01T00:00:00", "datatype": "TMIN", "station": "S1", "attributes": "", "value": 30}]
    with open(f"{scratch}/w/part.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    with open(f"{scratch}/s.json", "w") as f:
        f.write(json.dumps({"id": "S1", "name": "One"}))
    cfg = PipelineConfig.fresh(spark, "test")
    argv = ["run", "--root", cfg.root, "--raw-db", cfg.raw_db, "--harmonized-db", cfg.harmonized_db,
            "--analytics-db", cfg.analytics_db, "--weather", f"{scratch}/w", "--stations", f"{scratch}/s.json",
            "--kind", "lines"]
    assert main(argv) == 0
    a = spark.table(Tables(cfg).name("analytics")).first()
    assert (a.station_name, a.avg_tavg, a.avg_daily_temp_change) == ("One", 50.0, 40.0)


def test_upsert_reads_only_the_new_load(spark, scratch):
    import json

    cfg = PipelineConfig.fresh(spark, "test")
    rec = {"datatype": "TMAX", "station": "S1", "attributes": ""}
    os.makedirs(f"{scratch}/a", exist_ok=True)
    os.makedirs(f"{scratch}/b", exist_ok=True)
    with open(f"{scratch}/a/w.json", "w") as f:
        json.dump([dict(rec, date=f"2020-01-0{d}T00:00:00", value=d) for d in range(1, 6)], f)
    with open(f"{scratch}/b/w.json", "w") as f:
        json.dump([dict(rec, date="2020-01-01T00:00:00", value=9), dict(rec, date="2020-02-01T00:00:00", value=8)], f)
    with open(f"{scratch}/s.json", "w") as f:
        json.dump([{"id": "S1", "name": "One"}], f)
    first = run_pipeline(spark, cfg, f"{scratch}/a", f"{scratch}/s.json", mode="upsert")
    second = run_pipeline(spark, cfg, f"{scratch}/b", f"{scratch}/s.json", mode="upsert")
    assert first[0].status != second[0].status  # two loads, two staging partitions
    obs2 = [r for r in second if r.stage == "observations"][0]
    assert obs2.rows == 2  # only the second load's rows were merged
    stations2 = [r for r in second if r.stage == "stations"][0]
    assert stations2.status.startswith("skipped")  # the station file was loaded already
    t = Tables(cfg)
    got = {str(r.observation_date)[:10]: r.obs_value for r in spark.table(t.name("observations")).collect()}
    assert got == {"2020-01-01": 9.0, "2020-01-02": 2.0, "2020-01-03": 3.0, "2020-01-04": 4.0,
                   "2020-01-05": 5.0, "2020-02-01": 8.0}
    daily = {str(r.observation_date): r.tmax for r in spark.table(t.name("daily_temps")).collect()}
    assert daily["2020-01-01"] == 9.0 and daily["2020-02-01"] == 8.0


# ---- restarts, late stations, second processes -------------------------------

REC = {"datatype": "TMAX", "attributes": ""}


def _land(folder, name, records):
    import json

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(json.dumps(r) for r in records))
    return folder


def _obs(station, day, value, kind="TMAX"):
    return dict(REC, station=station, date=f"{day}T00:00:00", value=value, datatype=kind)


@pytest.fixture(scope="module")
def drops(spark):
    """Two drops of files and the tables that two clean runs over them give."""
    land = fresh_dir(spark, "test-drops").removeprefix("file:")
    w1 = _land(f"{land}/w1", "a.json", [_obs("S1", "2020-01-01", 50), _obs("S2", "2020-01-01", 60)])
    w2 = _land(f"{land}/w2", "b.json", [_obs("S1", "2020-01-01", 55), _obs("S1", "2020-02-01", 70)])
    s1 = _land(f"{land}/s1", "s.json", [{"id": "S1", "name": "One"}])
    s2 = _land(f"{land}/s2", "s.json", [{"id": "S2", "name": "Two"}])
    os.utime(f"{w1}/a.json", (1, 1))
    clean = PipelineConfig.fresh(spark, "test")
    run_pipeline(spark, clean, w1, s1, kind="lines")
    run_pipeline(spark, clean, w2, s2, kind="lines")
    want = _all(spark, clean)
    assert len(want["analytics"]) == 3
    return w1, s1, w2, s2, want


@pytest.mark.parametrize("stop", ["staged", "stations", "observations", "observations recorded", "daily_temps"])
def test_run_stopped_after_any_stage(spark, drops, stop, monkeypatch):
    from stationday.plans import pipeline

    w1, s1, w2, s2, want = drops
    cfg = PipelineConfig.fresh(spark, "test")
    run_pipeline(spark, cfg, w1, s1, kind="lines")

    class Stop(Exception):
        pass

    def failing(fn, before=False):
        def run(*a, **k):
            if not before:
                fn(*a, **k)
            raise Stop
        return run

    with monkeypatch.context() as m:
        if stop == "staged":  # rows appended, load not in the log
            from stationday.sources import json_rows
            append, calls = json_rows.append_table, []

            def first_only(df, name):
                calls.append(name)
                if len(calls) == 2:
                    raise Stop
                append(df, name)
            m.setattr(json_rows, "append_table", first_only)
        elif stop.endswith("recorded"):
            mark = pipeline.progress.mark

            def stop_after(spark_, t, loads, *steps):
                mark(spark_, t, loads, *steps)
                if stop.split()[0] in steps:
                    raise Stop
            m.setattr(pipeline.progress, "mark", stop_after)
        else:
            name = {"load": "load_raw", "stations": "transform_stations", "observations": "transform_observations",
                    "daily_temps": "pivot_stage", "analytics": "analytics_stage"}[stop]
            m.setattr(pipeline, name, failing(getattr(pipeline, name)))
        with pytest.raises(Stop):
            run_pipeline(spark, cfg, w2, s2, kind="lines")
    run_pipeline(spark, cfg, w2, s2, kind="lines")
    assert _all(spark, cfg) == want
    if stop == "staged":  # the rows of the load that was not committed are not seen
        idle = run_pipeline(spark, cfg, w2, s2, kind="lines")
        assert all(r.status.startswith("skipped") for r in idle if r.stage != "validate")
        run_pipeline(spark, cfg, mode="refresh")
        assert len(_all(spark, cfg)["observations"]) == 4


def test_one_path_only(spark, scratch):
    cfg = PipelineConfig.fresh(spark, "test")
    w = _land(f"{scratch}/w", "a.json", [_obs("S1", "2020-01-01", 50)])
    res = {r.stage: r for r in run_pipeline(spark, cfg, w, kind="lines")}
    assert res["observations"].rows == 1 and res["daily_temps"].rows == 1 and res["analytics"].rows == 0
    s = _land(f"{scratch}/s", "s.json", [{"id": "S1", "name": "One"}])
    res = {r.stage: r for r in run_pipeline(spark, cfg, station_path=s, kind="lines")}
    assert res["stations"].rows == 1 and res["analytics"].rows == 1
    assert len(_all(spark, cfg)["analytics"]) == 1


def test_null_keys_of_a_load_are_merged_once(spark, scratch):
    w = _land(f"{scratch}/w", "a.json", [_obs("S1", "2020-01-01", 50), dict(REC, station="S1", date=None, value=1)])
    for keep, n in (("insert", 2), ("drop", 1)):
        cfg = PipelineConfig.fresh(spark, "test", null_keys=keep)
        for _ in range(3):
            run_pipeline(spark, cfg, w, kind="lines")
        assert len(_all(spark, cfg)["observations"]) == n


def test_second_load_does_not_open_loaded_files(spark, scratch):
    w = _land(f"{scratch}/w", "a.json", [_obs("S1", "2020-01-01", 50)])
    cfg = PipelineConfig.fresh(spark, "test")
    run_pipeline(spark, cfg, w, kind="lines")
    st = os.stat(f"{w}/a.json")
    with open(f"{w}/a.json", "r+") as f:  # broken, but as old as before: nobody reads it
        f.write("{{{")
    os.utime(f"{w}/a.json", ns=(st.st_atime_ns, st.st_mtime_ns))
    _land(w, "b.json", [_obs("S1", "2020-01-02", 51)])
    res = {r.stage: r for r in run_pipeline(spark, cfg, w, kind="lines")}
    assert res["load"].rows == 1 and res["observations"].rows == 1


def test_two_processes_on_one_root(scratch):
    import json
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=repo)
    code = ("import sys\nfrom stationday.session import local_session\nspark = local_session(2, 'cli', '1g')\n"
            "from stationday.__main__ import main\nmain(sys.argv[1:])\n"
            "import json\nn = lambda t: spark.table(t).count()\n"
            "print(json.dumps([n(t) for t in ('harmonized.observations', 'raw.observation_staging', 'raw.load_log', "
            "'analytics.analytics')]))\n")
    s = _land(f"{scratch}/s", "s.json", [{"id": f"S{i}", "name": f"N{i}"} for i in range(11)])
    days = [_land(f"{scratch}/d1", "a.json", [_obs(f"S{i}", "2020-01-01", i) for i in range(10)]),
            _land(f"{scratch}/d2", "b.json", [_obs("S10", "2020-01-01", 10)])]
    for d in days:
        out = subprocess.run([sys.executable, "-c", code, "run", "--root", f"{scratch}/wh", "--weather", d,
                              "--stations", s, "--grain", "month"], env=env, cwd=scratch, capture_output=True, text=True,
                             timeout=300)
        assert out.returncode == 0, out.stderr[-3000:]
        got = json.loads(out.stdout.strip().splitlines()[-1])
    assert got == [11, 11, 3, 11]
