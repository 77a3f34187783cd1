"""Loading JSON records, tables and the JSON sink (FIXTURES.md sections 2-3)."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from stationday.operators.parse import parse_observations, parse_stations
from stationday.schemas import ANALYTICS_SCHEMA, assert_schema
from stationday.sources import (
    comment_table,
    drop_table,
    empty_from_schema,
    empty_like,
    load_json_rows,
    read_json_array_files,
    read_json_lines,
    table_exists,
    write_json_lines,
)

OBS = [
    {"date": "2020-01-01T00:00:00", "datatype": "TMAX", "station": "S1", "attributes": ",,7,", "value": 50,
     "zip_code": "02128"},
    {"date": "2020-01-01T00:00:00", "datatype": "TMIN", "station": "S1", "value": 20, "zip_code": "02128"},
    {"date": "2020-01-02T00:00:00", "datatype": "PRCP", "station": "S2", "attributes": "x", "value": None},
    {"date": None, "datatype": "TMAX", "station": "S3", "attributes": "y", "value": 1.5},
]


def _write(path, obj, opener=open):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj))
    return path


def test_array_file_rows_and_positions(spark, scratch):
    p = _write(f"{scratch}/a/weather.json", OBS)
    df = read_json_array_files(spark, p, "weather_json")
    rows = df.orderBy("_pos").collect()
    assert [r._pos for r in rows] == [0, 1, 2, 3]
    assert rows[0]._file.endswith("weather.json") and rows[0]._mtime is not None
    parsed = parse_observations(df).orderBy("_pos").collect()
    assert parsed[0].obs_value == 50.0 and parsed[0].attributes == ",,7,"
    assert parsed[1].attributes is None  # missing key
    assert parsed[2].obs_value is None   # JSON null
    assert parsed[3].observation_date is None


def test_gzip_array_file(spark, scratch):
    p = _write(f"{scratch}/gz/weather.json.gz", OBS, gzip.open)
    assert read_json_array_files(spark, p, "j").count() == 4


def test_empty_array_gives_no_rows(spark, scratch):
    p = _write(f"{scratch}/empty/w.json", [])
    assert read_json_array_files(spark, p, "j").count() == 0


def test_truncated_array_fails(spark, scratch):
    p = _write(f"{scratch}/trunc/w.json", json.dumps(OBS)[:-20])
    with pytest.raises(Exception):
        read_json_array_files(spark, p, "j").count()


def test_object_file_is_not_an_array(spark, scratch):
    p = _write(f"{scratch}/obj/w.json", OBS[0])
    with pytest.raises(Exception):  # FAILFAST rejects a non-array document
        read_json_array_files(spark, p, "j").collect()


def test_json_lines(spark, scratch):
    p = _write(f"{scratch}/lines/w.jsonl", "\n".join(json.dumps(o) for o in OBS) + "\n")
    df = read_json_lines(spark, p, "weather_json")
    assert df.count() == 4
    assert df.filter(F.col("_pos").isNotNull()).count() == 0


def test_strict_and_permissive_casts(spark, scratch):
    bad = [{"date": "2020-01-01T00:00:00", "datatype": "TMAX", "station": "S1", "value": "warm"}]
    p = _write(f"{scratch}/bad/w.json", bad)
    raw = read_json_array_files(spark, p, "weather_json")
    assert parse_observations(raw, mode="permissive").first().obs_value is None
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        parse_observations(raw, mode="strict").collect()


def test_station_types_follow_target(spark, scratch):
    st = [{"id": "GHCND:1", "name": "A", "latitude": 42.1, "longitude": -71, "elevation": 5,
           "elevationUnit": "METERS", "mindate": "1893-01-01", "maxdate": "2025-03-01", "datacoverage": 1}]
    p = _write(f"{scratch}/st/s.json", st)
    r = parse_stations(read_json_array_files(spark, p, "station_json"), keep_ingest=False)
    row = r.first()
    assert row.longitude == -71.0 and row.data_coverage == 1.0 and str(row.min_date) == "1893-01-01"


def test_load_into_staging_with_comment(spark, tables, scratch):
    p = _write(f"{scratch}/load/w.json", OBS)
    name = tables.name("observation_staging")
    load_json_rows(spark, p, name, "weather_json", "array", comment='{"origin":"test"}')
    load_json_rows(spark, p, name, "weather_json", "array")  # already loaded: skipped
    assert spark.table(name).count() == 4
    os.utime(p, (10, 10))  # a rewritten file is loaded again
    load_json_rows(spark, p, name, "weather_json", "array")
    assert spark.table(name).count() == 8
    p2 = _write(f"{scratch}/load/zip=02130/w.json", OBS[:1])
    load_json_rows(spark, p2, name, "weather_json", "array")
    assert spark.table(name).count() == 9
    from stationday.sources.json_rows import tag_from_path
    zips = tag_from_path(spark.table(name), "zip_code", r"zip=([^/]+)").filter("zip_code != ''")
    assert [r.zip_code for r in zips.collect()] == ["02130"]
    comment_table(spark, name, "it's tagged")
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert desc.get("Comment") == "it's tagged"


def test_load_in_committed_batches(spark, tables, scratch, monkeypatch):
    """5,000 files, some with pattern characters in their names: the driver
    names one batch at a time, and a load that stops keeps its done batches."""
    from stationday.sources import json_rows

    for i in range(5000):
        _write(f"{scratch}/many/{i % 50}/w{i}.json", [{**OBS[0], "value": i}])
    for name in ("a[1].json", "b{2,3}.json", "c*.json", "d?.json", "e\\f.json", "g h%20.json"):
        _write(f"{scratch}/many/odd/{name}", [{**OBS[0], "value": 10_000}])
    _write(f"{scratch}/many/odd/a1.json", [{**OBS[0], "value": 20_000}])  # what a[1] as a pattern would name
    monkeypatch.setattr(json_rows, "BATCH_FILES", 1700)
    named, real = [], json_rows.read_json_rows

    def read(spark_, paths, *a):
        named.append(len(paths))
        if len(named) == 2:
            raise RuntimeError("stopped")
        return real(spark_, paths, *a)

    monkeypatch.setattr(json_rows, "read_json_rows", read)
    staging, log = tables.name("observation_staging"), tables.name("load_log")
    load = lambda: load_json_rows(spark, f"{scratch}/many/*", staging, "weather_json", "array", log_table=log)
    with pytest.raises(RuntimeError):
        load()
    done = json_rows.committed(spark, staging, log).count()
    assert 0 < done == named[0] < 5007
    assert load() == 5007 - done and load() == 0
    assert max(named) < 2500 and sum(named[2:]) == 5007 - done
    rows = json_rows.committed(spark, staging, log)
    assert rows.count() == 5007
    values = parse_observations(rows, keep_ingest=False).agg({"obs_value": "sum"}).first()[0]
    assert values == sum(range(5000)) + 6 * 10_000 + 20_000


def test_table_exists_both_answers(spark, tables):
    assert table_exists(spark, tables.name("analytics"))
    assert not table_exists(spark, tables.name("analytics")[:-1] + "_missing`")
    drop_table(spark, tables.name("analytics"))
    assert not table_exists(spark, tables.name("analytics"))


def test_empty_tables(spark, tables):
    e = empty_from_schema(spark, ANALYTICS_SCHEMA)
    assert e.count() == 0
    assert_schema(e, ANALYTICS_SCHEMA)
    like = empty_like(spark, tables.name("observations"))
    assert like.count() == 0 and "obs_period" in like.columns


def test_sink_round_trip(spark, scratch):
    df = spark.createDataFrame([(o["date"], o["datatype"], o["station"], o.get("attributes"), float(o["value"]))
                                for o in OBS[:2]], "date string, datatype string, station string, "
                                                   "attributes string, value double")
    path = write_json_lines(df, f"file:{scratch}/sink", compression="gzip")
    back = parse_observations(read_json_lines(spark, path, "weather_json"), keep_ingest=False)
    assert sorted(r.obs_value for r in back.collect()) == [20.0, 50.0]
