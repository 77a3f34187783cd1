
import datetime as dt
import json
import os

from stationday.plans.stages import Tables
from stationday.schemas import DAILY_TEMPS, OBSERVATIONS
from stationday.streaming import incremental_upsert, skip_existing_files

D1 = [{"date": "2020-01-01T00:00:00", "datatype": "TMAX", "station": "S1", "attributes": "a", "value": 50},
      {"date": "2020-01-01T00:00:00", "datatype": "TMIN", "station": "S1", "attributes": "a", "value": 20},
      {"date": None, "datatype": "TMAX", "station": "S1", "attributes": "n", "value": 1}]
D2 = [{"date": "2020-01-01T00:00:00", "datatype": "TMAX", "station": "S1", "attributes": "b", "value": 55},
      {"date": "2020-02-03T00:00:00", "datatype": "TMAX", "station": "S2", "attributes": "b", "value": 70}]


def _drop(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(json.dumps(r) for r in records) + "\n")


def _rows(spark, t: Tables, key="observations", spec=OBSERVATIONS):
    return sorted((tuple(r) for r in spec.logical(spark.table(t.name(key))).collect()), key=repr)


def test_two_drops_equal_one_batch(spark, tables, scratch):
    from stationday.config import PipelineConfig
    from stationday.plans.stages import setup

    land, ckpt = f"{scratch}/land", f"{scratch}/ckpt"
    _drop(f"{land}/d1", "a.json", D1)
    r1 = incremental_upsert(spark, tables.cfg, land, ckpt)
    _drop(f"{land}/d2", "b.json", D2)
    r2 = incremental_upsert(spark, tables.cfg, land, ckpt)
    assert len(r1.batches) == 1 and len(r2.batches) == 1
    assert r1.dropped_null_keys == 1  # NULL keys are dropped (and counted) in the stream
    streamed = _rows(spark, tables)

    # one batch over both files
    other = setup(spark, PipelineConfig.fresh(spark, "test"))
    land2 = f"{scratch}/land2"
    _drop(f"{land2}/d1", "a.json", D1)
    os.utime(os.path.join(land2, "d1", "a.json"), (1, 1))  # older file
    _drop(f"{land2}/d2", "b.json", D2)
    incremental_upsert(spark, other.cfg, land2, f"{scratch}/ckpt2")
    assert _rows(spark, other) == streamed
    got = {(r[1], r[2], r[0]): r[4] for r in streamed}
    assert got[("TMAX", "S1", dt.datetime(2020, 1, 1))] == 55.0  # the later drop wins


def test_idle_run_and_replay_change_nothing(spark, tables, scratch):
    land, ckpt = f"{scratch}/land", f"{scratch}/ckpt"
    _drop(f"{land}/d1", "a.json", D1)
    incremental_upsert(spark, tables.cfg, land, ckpt)
    before = _rows(spark, tables)
    idle = incremental_upsert(spark, tables.cfg, land, ckpt)
    assert idle.batches == [] and _rows(spark, tables) == before
    # a batch replayed after a lost commit: a fresh checkpoint re-reads the same file
    incremental_upsert(spark, tables.cfg, land, f"{scratch}/ckpt-replay")
    assert _rows(spark, tables) == before


def test_files_present_at_setup_are_skipped(spark, tables, scratch):
    land, ckpt = f"{scratch}/land", f"{scratch}/ckpt"
    _drop(f"{land}/old", "a.json", D1)
    skip_existing_files(spark, land, ckpt)
    _drop(f"{land}/new", "b.json", D2)
    run = incremental_upsert(spark, tables.cfg, land, ckpt)
    assert run.source_rows == 2 and len(_rows(spark, tables)) == 2


def test_downstream_recompute(spark, tables, scratch):
    land, ckpt = f"{scratch}/land", f"{scratch}/ckpt"
    _drop(f"{land}/d1", "a.json", D1 + D2)
    run = incremental_upsert(spark, tables.cfg, land, ckpt, downstream=True)
    assert [r.stage for r in run.results] == ["daily_temps", "analytics"]
    daily = _rows(spark, tables, "daily_temps", DAILY_TEMPS)
    assert (dt.date(2020, 1, 1), "S1", 55.0, 20.0) in daily


def test_array_files_stream(spark, tables, scratch):
    land, ckpt = f"{scratch}/land", f"{scratch}/ckpt"
    os.makedirs(f"{land}/d1", exist_ok=True)
    with open(f"{land}/d1/a.json", "w") as f:
        json.dump(D1[:2] + D2, f)
    run = incremental_upsert(spark, tables.cfg, land, ckpt, kind="array")
    assert run.source_rows == 4
    got = {(r[1], r[2]): r[4] for r in _rows(spark, tables)}
    assert got[("TMAX", "S1")] == 55.0  # later position in the array wins


def test_incremental_command_line(spark, scratch, capsys):
    from stationday.__main__ import main
    from stationday.config import PipelineConfig

    cfg = PipelineConfig.fresh(spark, "test")
    land = f"{scratch}/land"
    _drop(f"{land}/old", "a.json", D1)
    base = ["incremental", "--root", cfg.root, "--raw-db", cfg.raw_db, "--harmonized-db", cfg.harmonized_db,
            "--analytics-db", cfg.analytics_db, "--landing", land, "--checkpoint", f"{scratch}/ckpt"]
    assert main(base + ["--skip-existing"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["source_rows"] == 0
    _drop(f"{land}/new", "b.json", D2)
    assert main(base + ["--downstream"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["source_rows"] == 2 and len(out["batches"]) == 1


def test_downstream_once_per_run_and_after_a_failure(spark, tables, scratch, monkeypatch):
    import pytest

    from stationday.plans import pipeline
    from stationday.streaming import incremental

    land, ckpt = f"{scratch}/land", f"{scratch}/ckpt"
    for i, recs in enumerate([D1[:2], D2[:1], D2[1:]]):
        _drop(f"{land}/d{i}", f"{i}.json", recs)
    calls = []
    pivot = pipeline.pivot_stage
    monkeypatch.setattr(pipeline, "pivot_stage", lambda *a, **k: calls.append(1) or pivot(*a, **k))
    with monkeypatch.context() as m:
        def fail(*a):
            raise RuntimeError("stopped")
        m.setattr(incremental, "run_downstream", fail)
        with pytest.raises(RuntimeError, match="stopped"):
            incremental_upsert(spark, tables.cfg, land, ckpt, downstream=True, max_files_per_trigger=1)
    assert calls == [] and _rows(spark, tables, "daily_temps", DAILY_TEMPS) == []
    run = incremental_upsert(spark, tables.cfg, land, ckpt, downstream=True)  # nothing new has arrived
    assert run.batches == [] and calls == [1]
    assert [r[:3] for r in _rows(spark, tables, "daily_temps", DAILY_TEMPS)] == [
        (dt.date(2020, 1, 1), "S1", 55.0), (dt.date(2020, 2, 3), "S2", 70.0)]
    _drop(f"{land}/d8", "8.json", D1[:1])
    _drop(f"{land}/d9", "9.json", D2[:1])
    run = incremental_upsert(spark, tables.cfg, land, ckpt, downstream=True, max_files_per_trigger=1)
    assert len(run.batches) == 2 and calls == [1, 1]


def test_a_batch_run_takes_up_the_stream(spark, tables, scratch):
    from stationday.plans.pipeline import run_pipeline

    land, ckpt = f"{scratch}/land", f"{scratch}/ckpt"
    _drop(land, "a.json", D1)
    incremental_upsert(spark, tables.cfg, land, ckpt)
    res = {r.stage: r.status for r in run_pipeline(spark, tables.cfg)}
    assert res["observations"].startswith("skipped") and res["daily_temps"] == "merged"
    assert len(_rows(spark, tables)) == 2  # the row with a NULL key stays dropped
