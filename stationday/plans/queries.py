"""Queries over the driver's tables, one per operator of the inventory.

Each query is a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where
the result is expressible in SQL, the same result as DuckDB SQL over the
tables ``events``, ``customer``, ``orders`` and ``lineitem``. Queries that
exercise a write path (upserts, loads, the stream) write into a fresh
folder of the work dir and return a read of the resulting table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.config import PipelineConfig, fresh_dir
from stationday.functions import avg_temp, call_by_name, outlier_label, temp_change
from stationday.functions.temperature import OUTLIER_LABELS
from stationday.functions.registry import AVG_TEMP_FN, OUTLIER_FN, TEMP_CHANGE_FN
from stationday.operators.analytics import (
    grouped_average,
    join_dimension,
    order_latest_first,
    station_analytics,
    top_n,
)
from stationday.operators.dedupe import dedupe_latest, distinct_keys, distinct_rows
from stationday.operators.frames import rolling, runs
from stationday.operators.merge import coalesce_source_target, merge_into
from stationday.operators.parse import (
    OBSERVATION_FIELDS,
    clean_column_names,
    drop_nulls,
    ensure_columns,
    extract,
    json_field,
    parse_observations,
    parse_stations,
    rename_column,
    timestamp_to_date,
)
from stationday.operators.pivot import daily_temps, pivot_max
from stationday.operators.planning import filter_window, missing_dimension, page_plan, split_yearly, union_tagged
from stationday.operators.summaries import by_grouping_sets, merged, sketch, snapshot_diff
from stationday.operators.temporal_joins import asof_join, interval_join
from stationday.plans import derive, progress
from stationday.plans.pipeline import run_pipeline
from stationday.plans.stages import (
    ANALYTICS_UPDATES,
    OBSERVATION_UPDATES,
    STATION_UPDATES,
    Tables,
    load_raw,
    pivot_stage,
    setup,
    transform_observations,
    transform_stations,
)
from stationday.schemas import ANALYTICS, DAILY_TEMPS, DAILY_TEMPS_SCHEMA, OBSERVATIONS
from stationday.sources.json_rows import load_json_rows, read_json_lines
from stationday.sources.sink import write_json_lines
from stationday.sources.tables import empty_like, overwrite_table
from stationday.streaming.anomalies import anomalies
from stationday.streaming.incremental import incremental_upsert, skip_existing_files
from stationday.streaming.windows import close_windows, keep_late_rows, landed, windowed

OBS_KEYS = ["observation_date", "datatype", "station_id"]
OBS_COLS = ["observation_date", "datatype", "station_id", "attributes", "obs_value"]
DAILY_KEYS = ["observation_date", "station_id"]
# Day boundaries used to split the month of events into overlapping parts.
SPLIT_OLD_BEFORE = "2024-01-21"   # target: days before this one
SPLIT_NEW_FROM = "2024-01-11"     # source: this day and later
STREAM_DROPS = ("2024-01-04", "2024-01-13", "2024-01-22")  # drop boundaries
WINDOW = ("2024-01-05", "2024-01-20")
PAGE = 100


# ---- shared inputs -----------------------------------------------------------

def _events(spark, sf):
    return derive.table(spark, sf, "events")


def _obs(spark, sf, keep_id=True):
    return derive.observations_from_events(_events(spark, sf), keep_id)


def _stations(spark, sf):
    return derive.stations_from_customers(derive.table(spark, sf, "customer"))


def _deduped(spark, sf):
    return dedupe_latest(_obs(spark, sf), OBS_KEYS, order=["event_id"]).drop("event_id")


def _ts(day: str):
    return F.to_date(F.lit(day)).cast("timestamp_ntz")


def _old(df):
    return df.filter(F.col("observation_date") < _ts(SPLIT_OLD_BEFORE))


def _new(df):
    return df.filter(F.col("observation_date") >= _ts(SPLIT_NEW_FROM))


def _daily(obs: DataFrame, method="when"):
    return daily_temps(obs, ("TMAX", "TMIN"), method)


def _fresh_tables(spark, tag) -> Tables:
    return setup(spark, PipelineConfig.fresh(spark, tag))


def _land_array(spark, sf, land):
    ev = _events(spark, sf)
    derive.write_array_files(derive.observation_records(ev), f"{land}/weather", "event_id")
    st = derive.station_records(derive.table(spark, sf, "customer")).withColumn("__o", F.col("id"))
    derive.write_array_files(st, f"{land}/stations", "__o")


# ---- sources -----------------------------------------------------------------

def q_load_json_rows(spark, sf):
    land = fresh_dir(spark, "q-load")
    derive.write_array_files(derive.observation_records(_events(spark, sf)), f"{land}/weather", "event_id")
    t = _fresh_tables(spark, "q-load")
    load_json_rows(spark, f"{land}/weather", t.name("observation_staging"), "weather_json", "array",
                   log_table=t.name("load_log"))
    return parse_observations(spark.table(t.name("observation_staging")), keep_ingest=False)


def q_json_round_trip(spark, sf):
    path = fresh_dir(spark, "q-sink")
    write_json_lines(derive.observation_records(_events(spark, sf)).drop("event_id"), path)
    return parse_observations(read_json_lines(spark, path, "weather_json"), keep_ingest=False)


def q_project_columns(spark, sf):
    return _stations(spark, sf).select("station_id", "name")


def q_full_refresh(spark, sf):
    land = fresh_dir(spark, "q-refresh")
    _land_array(spark, sf, land)
    cfg = PipelineConfig.fresh(spark, "q-refresh", sequence_field=derive.SEQUENCE_FIELD)
    run_pipeline(spark, cfg, f"{land}/weather", f"{land}/stations", kind="array", mode="refresh")
    return DAILY_TEMPS.logical(spark.table(Tables(cfg).name("daily_temps")))


def q_empty_like(spark, sf):
    t = _fresh_tables(spark, "q-empty")
    overwrite_table(OBSERVATIONS.with_partition(_obs(spark, sf, keep_id=False)), t.name("observations"))
    return OBSERVATIONS.logical(empty_like(spark, t.name("observations")))


# ---- projections and scalar functions ------------------------------------------

def q_json_extract(spark, sf):
    ev = _events(spark, sf)
    return ev.select("event_id", json_field(F.parse_json("props"), "k", "int").alias("k"))


def q_parse_observations(spark, sf):
    rec = derive.observation_records(_events(spark, sf))
    fields = ["date", "datatype", "station", "attributes"]
    good = F.struct(*fields, F.col("value"))
    bad = F.struct(*fields, F.lit("n/a").alias("value"))  # a value of the wrong type
    j = F.when(F.col("datatype") == "ERROR", F.to_json(bad)).otherwise(F.to_json(good))
    staged = rec.select(F.parse_json(j).alias("weather_json"), "event_id")
    return extract(staged, "weather_json", OBSERVATION_FIELDS, mode="permissive", keep=("event_id",))


def q_parse_stations(spark, sf):
    rec = derive.station_records(derive.table(spark, sf, "customer"))
    staged = derive.as_variant(rec, "station_json", rec.columns)
    return parse_stations(staged, keep_ingest=False)


def q_timestamp_to_date(spark, sf):
    return timestamp_to_date(_obs(spark, sf), "observation_date")


def q_clean_column_names(spark, sf):
    obs = timestamp_to_date(_obs(spark, sf), "observation_date")
    piv = pivot_max(obs, DAILY_KEYS, "datatype", ["TMAX", "TMIN"], "obs_value",
                    names=["'tmax'", ' "tmin" '], method="pivot")
    return clean_column_names(piv)


def q_ensure_columns(spark, sf):
    piv = pivot_max(_obs(spark, sf).withColumn("observation_date", F.col("observation_date").cast("date")),
                    DAILY_KEYS, "datatype", ["TMAX"], "obs_value", names=["tmax"])
    return ensure_columns(piv, DAILY_TEMPS_SCHEMA)


def q_rename_column(spark, sf):
    return rename_column(_stations(spark, sf).select("station_id", "name"), "name", "station_name")


def q_avg_temp(spark, sf):
    return _daily(_obs(spark, sf)).withColumn("tavg", avg_temp("tmax", "tmin"))


def q_temp_change(spark, sf):
    return _daily(_obs(spark, sf)).withColumn("daily_temp_change", temp_change("tmax", "tmin"))


def q_outlier_label(spark, sf):
    return _daily(_obs(spark, sf)).withColumn("outlier", outlier_label("tmax", "tmin"))


def q_call_by_name(spark, sf):
    db = _fresh_tables(spark, "q-functions").cfg.analytics_db  # set-up creates the functions there
    d = _daily(_obs(spark, sf))
    return d.select(*d.columns,
                    call_by_name(f"{db}.{AVG_TEMP_FN}", "tmax", "tmin").alias("tavg"),
                    call_by_name(f"{db}.{TEMP_CHANGE_FN}", "tmax", "tmin").alias("daily_temp_change"),
                    call_by_name(f"{db}.{OUTLIER_FN}", "tmax", "tmin").alias("outlier"))


def q_union_tagged(spark, sf):
    obs = _obs(spark, sf)
    early = F.col("observation_date") < _ts(SPLIT_NEW_FROM)
    return union_tagged({"early": obs.filter(early), "late": obs.filter(~early | early.isNull())}, "zip_code")


# ---- filters -------------------------------------------------------------------

def q_filter_in(spark, sf):
    return _obs(spark, sf).filter(F.col("datatype").isin("TMAX", "TMIN"))


def q_drop_nulls(spark, sf):
    return drop_nulls(_daily(_obs(spark, sf)))


def q_exists_scalar(spark, sf):
    # EXISTS as a one-row result: the limit stops the scan at the first match
    hit = _obs(spark, sf).filter(F.col("datatype") == "TMAX").limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("has_rows"))


def q_filter_window(spark, sf):
    return filter_window(_obs(spark, sf), "observation_date", WINDOW[0], WINDOW[1], kinds=["TMAX", "TMIN"])


# ---- joins, aggregates, order -----------------------------------------------------

def q_join_dimension(spark, sf):
    return join_dimension(_daily(_obs(spark, sf)), _stations(spark, sf))


def q_count_rows(spark, sf):
    return _events(spark, sf).agg(F.count(F.lit(1)).alias("row_count"))


def q_pivot_max(spark, sf):
    return _daily(_obs(spark, sf), method="pivot")


def q_group_avg(spark, sf):
    li = derive.table(spark, sf, "lineitem").withColumn("ship_day", F.col("l_shipdate").cast("date"))
    return grouped_average(li, ["l_returnflag", "l_linestatus", "ship_day"],
                           {"avg_qty": "l_quantity", "avg_price": "l_extendedprice", "avg_disc": "l_discount"})


def q_distinct_rows(spark, sf):
    return distinct_rows(_obs(spark, sf).select(*OBS_KEYS))


def q_dedupe_latest(spark, sf):
    return dedupe_latest(_obs(spark, sf), OBS_KEYS, order=["event_id"])


def q_distinct_keys(spark, sf):
    return distinct_keys(_obs(spark, sf), ["station_id"])


def q_order_two_keys(spark, sf):
    return order_latest_first(station_analytics(_daily(_obs(spark, sf)), _stations(spark, sf)))


def q_top_n(spark, sf):
    return top_n(_obs(spark, sf), 10, F.desc("observation_date"), "station_id", "datatype", "event_id")


# ---- upserts -------------------------------------------------------------------

def q_merge_upsert(spark, sf):
    t = _fresh_tables(spark, "q-upsert")
    d = _deduped(spark, sf)
    overwrite_table(OBSERVATIONS.with_partition(_old(d)), t.name("observations"))
    src = _new(d).select(
        "observation_date", "datatype", "station_id", F.upper("attributes").alias("attributes"),
        (F.col("obs_value") * 2).alias("obs_value"))
    merge_into(spark, t.name("observations"), OBSERVATIONS, src,
               update={c: "source" for c in OBSERVATION_UPDATES}, on_duplicate="distinct")
    return OBSERVATIONS.logical(spark.table(t.name("observations")))


def q_merge_partial_update(spark, sf):
    t = _fresh_tables(spark, "q-stations")
    st = _stations(spark, sf)
    spec = t.spec("stations")
    overwrite_table(spec.with_partition(st.filter(F.col("latitude") < 15)), t.name("stations"))
    src = st.filter(F.col("latitude") >= 10).select(
        "station_id", F.lower("name").alias("name"), (F.col("latitude") + 0.5).alias("latitude"),
        "longitude", "elevation", F.lit("FEET").alias("elevation_unit"),
        F.date_add("min_date", 1).alias("min_date"), "max_date",
        (F.col("data_coverage") + 1).alias("data_coverage"))
    merge_into(spark, t.name("stations"), spec, src, update={c: "source" for c in STATION_UPDATES},
               on_duplicate="error")
    return spec.logical(spark.table(t.name("stations")))


def q_merge_coalesce(spark, sf):
    t = _fresh_tables(spark, "q-daily")
    obs = _obs(spark, sf)
    overwrite_table(DAILY_TEMPS.with_partition(_daily(_old(obs))), t.name("daily_temps"))
    src = _daily(_new(obs).withColumn("obs_value", F.col("obs_value") * 2))
    merge_into(spark, t.name("daily_temps"), DAILY_TEMPS, src,
               update={"tmax": coalesce_source_target("tmax"), "tmin": coalesce_source_target("tmin")},
               on_duplicate="none")
    return DAILY_TEMPS.logical(spark.table(t.name("daily_temps")))


def q_merge_analytics(spark, sf):
    t = _fresh_tables(spark, "q-analytics")
    obs, st = _obs(spark, sf), _stations(spark, sf)
    overwrite_table(ANALYTICS.with_partition(station_analytics(_daily(_old(obs)), st)), t.name("analytics"))
    src = station_analytics(_daily(_new(obs).withColumn("obs_value", F.col("obs_value") * 2)),
                            st.withColumn("name", F.lower("name")))
    merge_into(spark, t.name("analytics"), ANALYTICS, src, update={c: "source" for c in ANALYTICS_UPDATES},
               on_duplicate="none")
    return ANALYTICS.logical(spark.table(t.name("analytics")))


def q_incremental_merge(spark, sf):
    t = setup(spark, PipelineConfig.fresh(spark, "q-stream", sequence_field=derive.SEQUENCE_FIELD))
    land, ckpt = fresh_dir(spark, "q-landing"), fresh_dir(spark, "q-ckpt")
    rec = derive.observation_records(_events(spark, sf)).drop("event_id")
    day = F.to_date(F.substring("date", 1, 10))
    bounds = [None, *STREAM_DROPS, None]
    for i in range(len(bounds) - 1):
        cond = F.lit(True)
        if bounds[i]:
            cond = cond & (day >= F.to_date(F.lit(bounds[i])))
        if bounds[i + 1]:
            cond = cond & (day < F.to_date(F.lit(bounds[i + 1])))
        write_json_lines(rec.filter(cond), f"{land}/drop{i}")
        if i == 0:
            # files present before the feed starts are not part of it
            skip_existing_files(spark, land, ckpt)
        else:
            incremental_upsert(spark, t.cfg, land, ckpt)
    return OBSERVATIONS.logical(spark.table(t.name("observations")))


def q_pivot_touched_dates(spark, sf):
    t = _fresh_tables(spark, "q-touched")
    d = _deduped(spark, sf)
    overwrite_table(OBSERVATIONS.with_partition(_old(d)), t.name("observations"))
    pivot_stage(spark, t.cfg)
    src = _new(d).withColumn("obs_value", F.col("obs_value") * 2)
    r = merge_into(spark, t.name("observations"), OBSERVATIONS, src,
                   update={c: "source" for c in OBSERVATION_UPDATES}, on_duplicate="none")
    pivot_stage(spark, t.cfg, r.touched)
    return DAILY_TEMPS.logical(spark.table(t.name("daily_temps")))


def q_flagship_analytics(spark, sf):
    land = fresh_dir(spark, "q-flagship")
    _land_array(spark, sf, land)
    cfg = PipelineConfig.fresh(spark, "q-flagship", sequence_field=derive.SEQUENCE_FIELD)
    run_pipeline(spark, cfg, f"{land}/weather", f"{land}/stations", kind="array", mode="upsert")
    return ANALYTICS.logical(spark.table(Tables(cfg).name("analytics")))


def q_pipeline_restart(spark, sf):
    """Runs that stop after each stage, then one that finishes all loads."""
    land = fresh_dir(spark, "q-restart")
    ev = _events(spark, sf)
    rec = derive.observation_records(ev)
    early = F.substring("date", 1, 10) < SPLIT_NEW_FROM
    derive.write_array_files(rec.filter(early), f"{land}/w1", "event_id")
    derive.write_array_files(rec.filter(~early | early.isNull()), f"{land}/w2", "event_id")
    st = derive.station_records(derive.table(spark, sf, "customer")).withColumn("__o", F.col("id"))
    derive.write_array_files(st, f"{land}/stations", "__o")
    t = setup(spark, PipelineConfig.fresh(spark, "q-restart", sequence_field=derive.SEQUENCE_FIELD))
    load_raw(spark, t.cfg, f"{land}/w1")  # stops after the load
    load_raw(spark, t.cfg, f"{land}/w2", f"{land}/stations")
    loads = progress.pending(spark, t, "stations")
    transform_stations(spark, t.cfg, loads=loads)  # stops before the step is recorded
    transform_observations(spark, t.cfg, loads=loads)
    progress.mark(spark, t, loads, "observations")  # stops before daily temps
    run_pipeline(spark, t.cfg)
    return ANALYTICS.logical(spark.table(t.name("analytics")))


def q_analytics_late_station(spark, sf):
    """Half of the stations arrive after all observations, without new ones."""
    land = fresh_dir(spark, "q-late")
    derive.write_array_files(derive.observation_records(_events(spark, sf)), f"{land}/weather", "event_id")
    st = derive.station_records(derive.table(spark, sf, "customer")).withColumn("__o", F.col("id"))
    first = F.col("latitude") < 12
    derive.write_array_files(st.filter(first), f"{land}/s1", "__o")
    derive.write_array_files(st.filter(~first | first.isNull()), f"{land}/s2", "__o")
    cfg = PipelineConfig.fresh(spark, "q-late", sequence_field=derive.SEQUENCE_FIELD)
    run_pipeline(spark, cfg, f"{land}/weather", f"{land}/s1")
    run_pipeline(spark, cfg, station_path=f"{land}/s2")
    return ANALYTICS.logical(spark.table(Tables(cfg).name("analytics")))


# ---- planning ------------------------------------------------------------------------

def q_split_yearly(spark, sf):
    o = derive.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("range_start"),
        F.max("o_orderdate").cast("date").alias("range_end"))
    return split_yearly(o, "range_start", "range_end").select("o_custkey", "chunk_start", "chunk_end")


def q_page_plan(spark, sf):
    c = derive.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return page_plan(c, "n", PAGE)


def q_missing_dimension(spark, sf):
    """Customers without any event."""
    customers = derive.table(spark, sf, "customer")
    return missing_dimension(customers, _events(spark, sf), "c_custkey", "user_id")


# ---- time, grains, snapshots -----------------------------------------------------------

def _moments(spark, sf):
    """Observations at their full time, with the station as text."""
    return _events(spark, sf).select(
        "event_id", F.col("user_id").cast("string").alias("station_id"), derive.kind_of(F.col("event_type")).alias("datatype"),
        F.col("ts").alias("at"), F.col("value").alias("obs_value"))


def q_asof_join(spark, sf):
    """Each temperature with the station's latest earlier report of another kind."""
    m = _moments(spark, sf)
    temps = m.filter(F.col("datatype").isin("TMAX", "TMIN"))
    reports = m.filter(F.col("datatype") == "SIGNUP").select(
        "station_id", "at", F.col("event_id").alias("report_id"), F.col("obs_value").alias("report_value"))
    out = asof_join(temps, reports, ["station_id"], "at", ["report_id", "report_value"], prefix="last_")
    return out.select("event_id", "station_id", "datatype", "obs_value", "last_report_id", "last_report_value")


def q_asof_join_tolerance(spark, sf):
    """The same with reports of the two days before only."""
    m = _moments(spark, sf)
    reports = m.filter(F.col("datatype") == "SIGNUP").select("station_id", "at", F.col("event_id").alias("report_id"))
    out = asof_join(m.filter(F.col("datatype") == "TMAX"), reports, ["station_id"], "at", ["report_id"],
                    prefix="last_", strict=True, tolerance=2 * 86_400)
    return out.select("event_id", "station_id", "last_report_id")


def _periods(spark, sf):
    """Stations with a period of activity that depends on their region."""
    st = derive.table(spark, sf, "customer")
    return st.select(F.col("c_custkey").cast("string").alias("station_id"), F.col("c_name").alias("name"),
                     F.date_add(F.to_date(F.lit(derive.STATION_MIN_DATE)), F.col("c_nationkey").cast("int")).alias("min_date"),
                     F.date_add(F.to_date(F.lit(derive.STATION_MIN_DATE)), (F.col("c_nationkey") * 2 - 5).cast("int")).alias("max_date"))


def q_interval_join(spark, sf):
    """Observations within their station's period (some periods are empty)."""
    out = interval_join(_obs(spark, sf), _periods(spark, sf), ["station_id"], "observation_date", "min_date", "max_date")
    return out.select("event_id", "station_id", "observation_date", "datatype", "name")


def q_interval_counts(spark, sf):
    """For every order, how many orders of the customer fall into the time after
    it, which is from a day to years long by its price."""
    o = derive.table(spark, sf, "orders")
    after = o.select("o_custkey", F.col("o_orderkey").alias("first_key"), F.col("o_orderdate").alias("opened"),
                     F.date_add(F.col("o_orderdate").cast("date"), F.floor(F.col("o_totalprice") / 150).cast("int")).alias("closes"))
    pairs = interval_join(o.select("o_custkey", "o_orderkey", "o_orderdate"), after, ["o_custkey"], "o_orderdate", "opened", "closes", closed=False)
    return pairs.groupBy("first_key").agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderkey").alias("last_key"))


def q_rolling_week(spark, sf):
    """Frames of seven days over the daily temperatures of a station."""
    d = _daily(_obs(spark, sf))
    out = rolling(d, ["station_id"], "observation_date", 7, {
        "week_max": F.max("tmax"), "week_min": F.min("tmin"), "week_days": F.count("tmax")}, period=10)
    return out.select("station_id", "observation_date", "tmax", "tmin", "week_max", "week_min", "week_days")


def q_outlier_runs(spark, sf):
    """Runs of days on which a station's temperatures are outliers of a narrow range."""
    d = _daily(_obs(spark, sf))
    label = outlier_label("tmax", "tmin", (20.0, 90.0), (5.0, 80.0))
    return runs(d, ["station_id"], "observation_date", label != OUTLIER_LABELS[3], period=10)


def q_grouping_sets(spark, sf):
    """Station by month, month by kind, kind, and everything."""
    o = _obs(spark, sf).select("station_id", F.month("observation_date").alias("month"), "datatype", "obs_value")
    return by_grouping_sets(o, [["station_id", "month"], ["month", "datatype"], ["datatype"], []], {
        "n_obs": F.count(F.lit(1)), "highest": F.max("obs_value"), "lowest": F.min("obs_value")})


def q_distinct_rollup(spark, sf):
    """Stations per kind from daily sketches, against the exact number: within
    three standard errors of a sketch of 2**14 buckets."""
    o = _obs(spark, sf)
    daily = sketch(o, ["observation_date", "datatype"], "station_id")
    rolled = merged(daily, ["datatype"])
    exact = o.groupBy("datatype").agg(F.countDistinct("station_id").alias("exact_distinct"))
    close = F.abs(F.col("approx_distinct") - F.col("exact_distinct")) <= F.col("exact_distinct") * 3 * 0.0065 + 1
    return rolled.join(exact, "datatype").select("datatype", "n_values", "exact_distinct", close.alias("within_bound"))


def q_snapshot_diff(spark, sf):
    """Two versions of orders: some left, some came, some have a new price."""
    o = derive.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    before = o.filter(F.col("o_orderstatus") != "P")
    after = o.filter(F.col("o_totalprice") > 1000).withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "O", F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice")))
    return snapshot_diff(before, after, ["o_orderkey"])


# ---- event time ----------------------------------------------------------------------------

ARRIVED = "event_id long, at timestamp, station_id string, datatype string, obs_value double"
LATE_DAYS = 6   # reports of errors arrive so many days after the rest
DELAY = "3 DAYS"


def _arrivals(spark, sf):
    """Observations with the drop they arrive in: by day, errors later."""
    m = _moments(spark, sf)
    day = F.datediff(F.col("at").cast("date"), F.to_date(F.lit(derive.STATION_MIN_DATE)))
    day = day + F.when(F.col("datatype") == "ERROR", LATE_DAYS).otherwise(0)
    return m.withColumn("drop", F.least(F.floor(day / 10), F.lit(2)))


def _drops(spark, sf, run):
    """Land one drop after the other; ``run`` takes up what has arrived."""
    land = fresh_dir(spark, "q-windows")
    rows = _arrivals(spark, sf)
    for i in range(3):
        rows.filter(F.col("drop") == i).drop("drop").write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{land}/drop{i}")
        run(landed(spark, land, ARRIVED))


def q_event_windows(spark, sf):
    """Days by kind, closed three days after; late rows are not in them."""
    out, ckpt = fresh_dir(spark, "q-closed"), fresh_dir(spark, "q-closed-ckpt")

    def run(stream):
        day = F.window("at", "1 day")
        w = windowed(stream, "at", DELAY, day, ["datatype"], {"n_obs": F.count(F.lit(1)), "highest": F.max("obs_value")})
        close_windows(spark, w, out, ckpt)

    _drops(spark, sf, run)
    return spark.read.parquet(out).select(F.col("window_start").cast("date").alias("day"), "datatype", "n_obs", "highest")


def q_late_rows(spark, sf):
    """The rows that came too late for the day they belong to."""
    out, ckpt = fresh_dir(spark, "q-aside"), fresh_dir(spark, "q-aside-ckpt")

    def run(stream):
        keep_late_rows(spark, stream, "at", DELAY, lambda at: F.date_trunc("day", at) + F.expr("INTERVAL 1 DAY"), out, ckpt)

    _drops(spark, sf, run)
    return spark.read.parquet(out).select("event_id", "station_id", "datatype", "obs_value")


def q_station_sessions(spark, sf):
    """Sessions of a station's reports (errors apart), six hours apart at most."""
    out, ckpt = fresh_dir(spark, "q-sessions"), fresh_dir(spark, "q-sessions-ckpt")

    def run(stream):
        s = F.session_window("at", "6 hours")
        own = stream.filter(F.col("datatype") != "ERROR")
        w = windowed(own, "at", DELAY, s, ["station_id"], {"n_obs": F.count(F.lit(1)), "first_event": F.min("event_id")})
        close_windows(spark, w, out, ckpt)

    _drops(spark, sf, run)
    return spark.read.parquet(out).select("station_id", "n_obs", "first_event")


def q_station_anomalies(spark, sf):
    """Temperatures far from what the station reported in earlier arrivals."""
    out, ckpt = fresh_dir(spark, "q-odd"), fresh_dir(spark, "q-odd-ckpt")

    def run(stream):
        temps = stream.filter(F.col("datatype").isin("TMAX", "TMIN")).select("event_id", "at", "station_id", F.col("obs_value").alias("value"))
        close_windows(spark, anomalies(temps, width=1.5, keep_days=60), out, ckpt)

    _drops(spark, sf, run)
    return spark.read.parquet(out).select("event_id", "station_id", "value")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "load_json_rows": q_load_json_rows,
    "json_round_trip": q_json_round_trip,
    "project_columns": q_project_columns,
    "full_refresh": q_full_refresh,
    "empty_like": q_empty_like,
    "json_extract": q_json_extract,
    "parse_observations": q_parse_observations,
    "parse_stations": q_parse_stations,
    "timestamp_to_date": q_timestamp_to_date,
    "clean_column_names": q_clean_column_names,
    "ensure_columns": q_ensure_columns,
    "rename_column": q_rename_column,
    "avg_temp": q_avg_temp,
    "temp_change": q_temp_change,
    "outlier_label": q_outlier_label,
    "call_by_name": q_call_by_name,
    "union_tagged": q_union_tagged,
    "filter_in": q_filter_in,
    "drop_nulls": q_drop_nulls,
    "exists_scalar": q_exists_scalar,
    "filter_window": q_filter_window,
    "join_dimension": q_join_dimension,
    "count_rows": q_count_rows,
    "pivot_max": q_pivot_max,
    "group_avg": q_group_avg,
    "distinct_rows": q_distinct_rows,
    "dedupe_latest": q_dedupe_latest,
    "distinct_keys": q_distinct_keys,
    "order_two_keys": q_order_two_keys,
    "top_n": q_top_n,
    "merge_upsert": q_merge_upsert,
    "merge_partial_update": q_merge_partial_update,
    "merge_coalesce": q_merge_coalesce,
    "merge_analytics": q_merge_analytics,
    "incremental_merge": q_incremental_merge,
    "pivot_touched_dates": q_pivot_touched_dates,
    "flagship_analytics": q_flagship_analytics,
    "pipeline_restart": q_pipeline_restart,
    "analytics_late_station": q_analytics_late_station,
    "split_yearly": q_split_yearly,
    "page_plan": q_page_plan,
    "missing_dimension": q_missing_dimension,
    "asof_join": q_asof_join,
    "asof_join_tolerance": q_asof_join_tolerance,
    "interval_join": q_interval_join,
    "interval_counts": q_interval_counts,
    "rolling_week": q_rolling_week,
    "outlier_runs": q_outlier_runs,
    "grouping_sets": q_grouping_sets,
    "distinct_rollup": q_distinct_rollup,
    "snapshot_diff": q_snapshot_diff,
    "event_windows": q_event_windows,
    "late_rows": q_late_rows,
    "station_sessions": q_station_sessions,
    "station_anomalies": q_station_anomalies,
}
