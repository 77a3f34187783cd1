"""A station holding a third of all observations: the pipeline's results stay exact."""

import duckdb
from pyspark.sql import functions as F

from conftest import SF01
from stationday.plans import derive
from stationday.plans.oracle import ORACLE_SQL
from stationday.plans.queries import QUERIES
from tools.oracle_check import compare


def test_hot_station_through_the_pipeline(spark, scratch):
    d = f"{scratch}/skewed"
    ev = derive.table(spark, SF01, "events")
    hot = (F.col("event_id") % 3) == 0  # fixture construction: every third event moves to one station
    ev.withColumn("user_id", F.when(hot, F.lit(7).cast("bigint")).otherwise(F.col("user_id"))) \
        .write.parquet(f"{d}/events.parquet")
    derive.table(spark, SF01, "customer").write.parquet(f"{d}/customer.parquet")
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    share = con.sql("SELECT avg(CASE WHEN user_id = 7 THEN 1.0 ELSE 0 END) FROM events").fetchall()[0][0]
    assert share > 0.33
    for name in ("flagship_analytics", "dedupe_latest", "merge_upsert"):
        r = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], d)
        assert r["cols_ok"] and r["rows"] == r["oracle_rows"] and r["hash_ok"], r
