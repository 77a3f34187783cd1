"""The same results as ``queries.QUERIES``, as DuckDB SQL over the driver's tables.

Shared pieces mirror ``derive``: ``obs`` is events as observations, ``dd``
the latest row per observation key, ``st`` customers as stations.
"""

from __future__ import annotations

OBS = """obs AS (
  SELECT event_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS observation_date,
         CASE WHEN event_type = 'click' THEN 'TMAX' WHEN event_type = 'view' THEN 'TMIN'
              ELSE upper(event_type) END AS datatype,
         CAST(user_id AS VARCHAR) AS station_id,
         props AS attributes,
         CAST(value AS DOUBLE) AS obs_value
  FROM events)"""

DD = """dd AS (
  SELECT observation_date, datatype, station_id, attributes, obs_value FROM obs
  QUALIFY row_number() OVER (PARTITION BY observation_date, datatype, station_id ORDER BY event_id DESC) = 1)"""

ST = """st AS (
  SELECT CAST(c_custkey AS VARCHAR) AS station_id, c_name AS name,
         CAST(c_nationkey AS DOUBLE) AS latitude, CAST(c_acctbal AS DOUBLE) AS longitude,
         CAST(c_nationkey * 10 AS DOUBLE) AS elevation, 'METERS' AS elevation_unit,
         DATE '2024-01-01' AS min_date, DATE '2024-01-30' AS max_date,
         CAST(c_nationkey AS DOUBLE) / 25 AS data_coverage
  FROM customer)"""

MOMENTS = """m AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS station_id,
         CASE WHEN event_type = 'click' THEN 'TMAX' WHEN event_type = 'view' THEN 'TMIN' ELSE upper(event_type) END AS datatype,
         ts AS moment, value AS obs_value
  FROM events)"""

PERIODS = """p AS (
  SELECT CAST(c_custkey AS VARCHAR) AS station_id, c_name AS name,
         DATE '2024-01-01' + CAST(c_nationkey AS INTEGER) AS min_date,
         DATE '2024-01-01' + CAST(c_nationkey * 2 - 5 AS INTEGER) AS max_date
  FROM customer)"""

# The drop that a row arrives in, and the latest time of all earlier drops.
ARRIVALS_PLAIN = """a0 AS (
  SELECT *, least((CAST(moment AS DATE) - DATE '2024-01-01' + CASE WHEN datatype = 'ERROR' THEN 6 ELSE 0 END) // 10, 2) AS d FROM m)"""

ARRIVALS = ARRIVALS_PLAIN + """, seen AS (SELECT x.d, max(y.moment) AS latest FROM (SELECT DISTINCT d FROM a0) x JOIN a0 y ON y.d < x.d GROUP BY 1),
a AS (SELECT a0.*, coalesce(date_trunc('day', moment) + INTERVAL 1 DAY <= latest - INTERVAL 3 DAY, false) AS late FROM a0 LEFT JOIN seen ON a0.d = seen.d)"""

OBS5 = "observation_date, datatype, station_id, attributes, obs_value"


def daily(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT CAST(observation_date AS DATE) AS observation_date, station_id,
         max(obs_value) FILTER (WHERE datatype = 'TMAX') AS tmax,
         max(obs_value) FILTER (WHERE datatype = 'TMIN') AS tmin
  FROM {src} WHERE datatype IN ('TMAX', 'TMIN') GROUP BY 1, 2)"""


def analytics(daily_name: str, st_name: str, name: str) -> str:
    return f"""{name} AS (
  SELECT d.observation_date, d.station_id, s.name AS station_name,
         avg(d.tmax) AS avg_tmax, avg(d.tmin) AS avg_tmin,
         avg((d.tmax + d.tmin) / 2) AS avg_tavg, avg(d.tmax - d.tmin) AS avg_daily_temp_change
  FROM {daily_name} d JOIN {st_name} s ON d.station_id = s.station_id
  GROUP BY 1, 2, 3)"""


OUTLIER = """CASE WHEN tmax IS NULL OR tmin IS NULL THEN NULL
  WHEN NOT (tmax BETWEEN 68 AND 104) AND NOT (tmin BETWEEN 14 AND 59) THEN 'Both TMAX and TMIN are outliers'
  WHEN NOT (tmax BETWEEN 68 AND 104) THEN 'TMAX is an outlier'
  WHEN NOT (tmin BETWEEN 14 AND 59) THEN 'TMIN is an outlier'
  ELSE 'Neither TMAX nor TMIN is an outlier' END"""

OLD = "observation_date < TIMESTAMP '2024-01-21'"
NEW = "observation_date >= TIMESTAMP '2024-01-11'"


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE_SQL: dict[str, str] = {
    "load_json_rows": w(OBS) + f"SELECT {OBS5} FROM obs",
    "json_round_trip": w(OBS) + f"SELECT {OBS5} FROM obs",
    "project_columns": "SELECT CAST(c_custkey AS VARCHAR) AS station_id, c_name AS name FROM customer",
    "full_refresh": w(OBS, daily("obs", "d")) + "SELECT * FROM d",
    "empty_like": w(OBS) + f"SELECT {OBS5} FROM obs WHERE 1 = 0",
    "json_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "parse_observations": w(OBS) + """SELECT observation_date, datatype, station_id, attributes,
        CASE WHEN datatype = 'ERROR' THEN NULL ELSE obs_value END AS obs_value, event_id FROM obs""",
    "parse_stations": w(ST) + "SELECT * FROM st",
    "timestamp_to_date": w(OBS) + """SELECT event_id, CAST(observation_date AS DATE) AS observation_date,
        datatype, station_id, attributes, obs_value FROM obs""",
    "clean_column_names": w(OBS, daily("obs", "d")) + "SELECT * FROM d",
    "ensure_columns": w(OBS) + """SELECT CAST(observation_date AS DATE) AS observation_date, station_id,
        max(obs_value) AS tmax, CAST(NULL AS DOUBLE) AS tmin
        FROM obs WHERE datatype = 'TMAX' GROUP BY 1, 2""",
    "rename_column": "SELECT CAST(c_custkey AS VARCHAR) AS station_id, c_name AS station_name FROM customer",
    "avg_temp": w(OBS, daily("obs", "d")) + "SELECT *, (tmax + tmin) / 2 AS tavg FROM d",
    "temp_change": w(OBS, daily("obs", "d")) + "SELECT *, tmax - tmin AS daily_temp_change FROM d",
    "outlier_label": w(OBS, daily("obs", "d")) + f"SELECT *, {OUTLIER} AS outlier FROM d",
    "call_by_name": w(OBS, daily("obs", "d")) + f"""SELECT *, (tmax + tmin) / 2 AS tavg,
        tmax - tmin AS daily_temp_change, {OUTLIER} AS outlier FROM d""",
    "union_tagged": w(OBS) + """SELECT *, CASE WHEN observation_date < TIMESTAMP '2024-01-11'
        THEN 'early' ELSE 'late' END AS zip_code FROM obs""",
    "filter_in": w(OBS) + "SELECT * FROM obs WHERE datatype IN ('TMAX', 'TMIN')",
    "drop_nulls": w(OBS, daily("obs", "d")) + "SELECT * FROM d WHERE tmax IS NOT NULL AND tmin IS NOT NULL",
    "exists_scalar": "SELECT EXISTS (SELECT 1 FROM events WHERE event_type = 'click') AS has_rows",
    "filter_window": w(OBS) + """SELECT * FROM obs
        WHERE CAST(observation_date AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
          AND datatype IN ('TMAX', 'TMIN')""",
    "join_dimension": w(OBS, daily("obs", "d"), ST) + """SELECT d.observation_date, d.station_id,
        st.name AS station_name, d.tmax, d.tmin FROM d JOIN st ON d.station_id = st.station_id""",
    "count_rows": "SELECT count(*) AS row_count FROM events",
    "pivot_max": w(OBS, daily("obs", "d")) + "SELECT * FROM d",
    "group_avg": """SELECT l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_day,
        avg(l_quantity) AS avg_qty, avg(l_extendedprice) AS avg_price, avg(l_discount) AS avg_disc
        FROM lineitem GROUP BY 1, 2, 3""",
    "distinct_rows": w(OBS) + "SELECT DISTINCT observation_date, datatype, station_id FROM obs",
    "dedupe_latest": w(OBS) + """SELECT * FROM obs QUALIFY row_number() OVER (
        PARTITION BY observation_date, datatype, station_id ORDER BY event_id DESC) = 1""",
    "distinct_keys": w(OBS) + "SELECT DISTINCT station_id FROM obs",
    "order_two_keys": w(OBS, daily("obs", "d"), ST, analytics("d", "st", "a"))
    + "SELECT * FROM a ORDER BY observation_date DESC, station_id",
    "top_n": w(OBS) + "SELECT * FROM obs ORDER BY observation_date DESC, station_id, datatype, event_id LIMIT 10",
    "merge_upsert": w(OBS, DD, f"t AS (SELECT *, 1 AS tm FROM dd WHERE {OLD})",
                      f"""s AS (SELECT observation_date, datatype, station_id, upper(attributes) AS attributes,
                          obs_value * 2 AS obs_value, 1 AS sm FROM dd WHERE {NEW})""")
    + """SELECT observation_date, datatype, station_id,
        CASE WHEN tm IS NOT NULL AND sm IS NOT NULL THEN s.attributes WHEN tm IS NOT NULL THEN t.attributes
             ELSE s.attributes END AS attributes,
        CASE WHEN tm IS NOT NULL AND sm IS NOT NULL THEN s.obs_value WHEN tm IS NOT NULL THEN t.obs_value
             ELSE s.obs_value END AS obs_value
        FROM t FULL OUTER JOIN s USING (observation_date, datatype, station_id)""",
    "merge_partial_update": w(ST, "t AS (SELECT *, 1 AS tm FROM st WHERE latitude < 15)",
                              """s AS (SELECT station_id, lower(name) AS name, latitude + 0.5 AS latitude,
                                 longitude, elevation, 'FEET' AS elevation_unit, min_date + 1 AS min_date,
                                 max_date, data_coverage + 1 AS data_coverage, 1 AS sm
                                 FROM st WHERE latitude >= 10)""")
    + """SELECT station_id,
        CASE WHEN sm IS NOT NULL THEN s.name ELSE t.name END AS name,
        CASE WHEN sm IS NOT NULL THEN s.latitude ELSE t.latitude END AS latitude,
        CASE WHEN sm IS NOT NULL THEN s.longitude ELSE t.longitude END AS longitude,
        CASE WHEN sm IS NOT NULL THEN s.elevation ELSE t.elevation END AS elevation,
        CASE WHEN tm IS NOT NULL THEN t.elevation_unit ELSE s.elevation_unit END AS elevation_unit,
        CASE WHEN sm IS NOT NULL THEN s.min_date ELSE t.min_date END AS min_date,
        CASE WHEN sm IS NOT NULL THEN s.max_date ELSE t.max_date END AS max_date,
        CASE WHEN tm IS NOT NULL THEN t.data_coverage ELSE s.data_coverage END AS data_coverage
        FROM t FULL OUTER JOIN s USING (station_id)""",
    "merge_coalesce": w(OBS, f"o_old AS (SELECT * FROM obs WHERE {OLD})",
                        f"o_new AS (SELECT observation_date, datatype, station_id, obs_value * 2 AS obs_value "
                        f"FROM obs WHERE {NEW})",
                        daily("o_old", "t0"), daily("o_new", "s0"),
                        "t AS (SELECT *, 1 AS tm FROM t0)", "s AS (SELECT *, 1 AS sm FROM s0)")
    + """SELECT observation_date, station_id,
        CASE WHEN tm IS NOT NULL AND sm IS NOT NULL THEN coalesce(s.tmax, t.tmax)
             WHEN tm IS NOT NULL THEN t.tmax ELSE s.tmax END AS tmax,
        CASE WHEN tm IS NOT NULL AND sm IS NOT NULL THEN coalesce(s.tmin, t.tmin)
             WHEN tm IS NOT NULL THEN t.tmin ELSE s.tmin END AS tmin
        FROM t FULL OUTER JOIN s USING (observation_date, station_id)""",
    "merge_analytics": w(OBS, ST, f"o_old AS (SELECT * FROM obs WHERE {OLD})",
                         f"o_new AS (SELECT observation_date, datatype, station_id, obs_value * 2 AS obs_value "
                         f"FROM obs WHERE {NEW})",
                         "st_new AS (SELECT station_id, lower(name) AS name FROM st)",
                         daily("o_old", "d_old"), daily("o_new", "d_new"),
                         analytics("d_old", "st", "a_old"), analytics("d_new", "st_new", "a_new"),
                         "t AS (SELECT *, 1 AS tm FROM a_old)", "s AS (SELECT *, 1 AS sm FROM a_new)")
    + """SELECT observation_date, station_id,
        CASE WHEN tm IS NOT NULL THEN t.station_name ELSE s.station_name END AS station_name,
        CASE WHEN sm IS NOT NULL THEN s.avg_tmax ELSE t.avg_tmax END AS avg_tmax,
        CASE WHEN sm IS NOT NULL THEN s.avg_tmin ELSE t.avg_tmin END AS avg_tmin,
        CASE WHEN sm IS NOT NULL THEN s.avg_tavg ELSE t.avg_tavg END AS avg_tavg,
        CASE WHEN sm IS NOT NULL THEN s.avg_daily_temp_change ELSE t.avg_daily_temp_change END
             AS avg_daily_temp_change
        FROM t FULL OUTER JOIN s USING (observation_date, station_id)""",
    "incremental_merge": w(OBS) + f"""SELECT {OBS5} FROM obs
        WHERE observation_date >= TIMESTAMP '2024-01-04'
        QUALIFY row_number() OVER (PARTITION BY observation_date, datatype, station_id ORDER BY event_id DESC) = 1""",
    "pivot_touched_dates": w(OBS, DD, f"t AS (SELECT *, 1 AS tm FROM dd WHERE {OLD})",
                             f"""s AS (SELECT observation_date, datatype, station_id, attributes,
                                 obs_value * 2 AS obs_value, 1 AS sm FROM dd WHERE {NEW})""",
                             """m AS (SELECT observation_date, datatype, station_id,
                                 CASE WHEN sm IS NOT NULL THEN s.obs_value ELSE t.obs_value END AS obs_value
                                 FROM t FULL OUTER JOIN s USING (observation_date, datatype, station_id))""",
                             daily("m", "d"))
    + "SELECT * FROM d",
    "flagship_analytics": w(OBS, DD, ST, daily("dd", "d"), analytics("d", "st", "a")) + "SELECT * FROM a",
    "pipeline_restart": w(OBS, DD, ST, daily("dd", "d"), analytics("d", "st", "a")) + "SELECT * FROM a",
    "analytics_late_station": w(OBS, DD, ST, daily("dd", "d"), analytics("d", "st", "a")) + "SELECT * FROM a",
    "split_yearly": """WITH RECURSIVE r AS (
          SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
          FROM orders GROUP BY o_custkey),
        c(o_custkey, chunk_start, b) AS (
          SELECT o_custkey, a, b FROM r WHERE a < b
          UNION ALL
          SELECT o_custkey, CAST(chunk_start + INTERVAL 1 YEAR AS DATE), b FROM c
          WHERE CAST(chunk_start + INTERVAL 1 YEAR AS DATE) < b)
        SELECT o_custkey, chunk_start,
               least(CAST(CAST(chunk_start + INTERVAL 1 YEAR AS DATE) - INTERVAL 1 DAY AS DATE), b) AS chunk_end
        FROM c""",
    "page_plan": """SELECT l_suppkey, n, unnest(generate_series(1, greatest(n, 1), 100)) AS page_offset
        FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey)""",
    "missing_dimension": """SELECT DISTINCT c_custkey FROM customer c WHERE NOT EXISTS (
        SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""",
    "asof_join": f"""WITH {MOMENTS}, r AS (SELECT station_id, moment, event_id AS report_id, obs_value AS report_value FROM m WHERE datatype = 'SIGNUP')
        SELECT t.event_id, t.station_id, t.datatype, t.obs_value, r.report_id AS last_report_id, r.report_value AS last_report_value
        FROM (SELECT * FROM m WHERE datatype IN ('TMAX', 'TMIN')) t ASOF LEFT JOIN r ON t.station_id = r.station_id AND t.moment >= r.moment""",
    "asof_join_tolerance": f"""WITH {MOMENTS}, r AS (SELECT station_id, moment, event_id AS report_id FROM m WHERE datatype = 'SIGNUP')
        SELECT t.event_id, t.station_id,
               CASE WHEN epoch(date_trunc('second', t.moment)) - epoch(date_trunc('second', r.moment)) <= 2 * 86400 THEN r.report_id END AS last_report_id
        FROM (SELECT * FROM m WHERE datatype = 'TMAX') t ASOF LEFT JOIN r ON t.station_id = r.station_id AND t.moment > r.moment""",
    "interval_join": w(OBS, PERIODS) + """SELECT o.event_id, o.station_id, o.observation_date, o.datatype, p.name
        FROM obs o JOIN p ON o.station_id = p.station_id AND o.observation_date BETWEEN p.min_date AND p.max_date""",
    "interval_counts": """SELECT a.o_orderkey AS first_key, count(*) AS n_orders, max(b.o_orderkey) AS last_key
        FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate >= a.o_orderdate
         AND b.o_orderdate < CAST(a.o_orderdate AS DATE) + CAST(floor(a.o_totalprice / 150) AS INTEGER)
        GROUP BY 1""",
    "rolling_week": w(OBS, daily("obs", "d")) + f"""SELECT station_id, observation_date, tmax, tmin,
        max(tmax) OVER week AS week_max, min(tmin) OVER week AS week_min, count(tmax) OVER week AS week_days
        FROM d WINDOW week AS (PARTITION BY station_id ORDER BY observation_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
    "outlier_runs": w(OBS, daily("obs", "d"), """f AS (SELECT station_id, observation_date AS day,
          observation_date - CAST(row_number() OVER (PARTITION BY station_id ORDER BY observation_date) AS INTEGER) AS g
          FROM d WHERE tmax IS NOT NULL AND tmin IS NOT NULL AND (tmax NOT BETWEEN 20 AND 90 OR tmin NOT BETWEEN 5 AND 80))""")
    + "SELECT station_id, min(day) AS run_start, max(day) AS run_end, count(*) AS run_days FROM f GROUP BY station_id, g",
    "grouping_sets": w(OBS) + """SELECT station_id, month, datatype, grouping(station_id, month, datatype) AS grouping_id,
        count(*) AS n_obs, max(obs_value) AS highest, min(obs_value) AS lowest
        FROM (SELECT station_id, CAST(month(observation_date) AS INTEGER) AS month, datatype, obs_value FROM obs)
        GROUP BY GROUPING SETS ((station_id, month), (month, datatype), (datatype), ())""",
    "distinct_rollup": w(OBS) + """SELECT datatype, count(station_id) AS n_values, count(DISTINCT station_id) AS exact_distinct, true AS within_bound
        FROM obs GROUP BY datatype""",
    "snapshot_diff": """WITH b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'),
        a AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice) ELSE o_totalprice END AS o_totalprice
              FROM orders WHERE o_totalprice > 1000)
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
               CASE WHEN b.o_orderkey IS NULL THEN 'insert' WHEN a.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change, CAST(1 AS BIGINT) AS copies,
               coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus, coalesce(a.o_totalprice, b.o_totalprice) AS o_totalprice,
               CASE WHEN a.o_orderkey = b.o_orderkey THEN b.o_custkey END AS old_o_custkey, CASE WHEN a.o_orderkey = b.o_orderkey THEN b.o_orderstatus END AS old_o_orderstatus,
               CASE WHEN a.o_orderkey = b.o_orderkey THEN b.o_totalprice END AS old_o_totalprice
        FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey
        WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice""",
    "event_windows": f"""WITH {MOMENTS}, {ARRIVALS}
        SELECT CAST(moment AS DATE) AS day, datatype, count(*) AS n_obs, max(obs_value) AS highest FROM a
        WHERE NOT late AND date_trunc('day', moment) + INTERVAL 1 DAY <= (SELECT max(moment) FROM a) - INTERVAL 3 DAY GROUP BY 1, 2""",
    "late_rows": f"WITH {MOMENTS}, {ARRIVALS} SELECT event_id, station_id, datatype, obs_value FROM a WHERE late",
    "station_sessions": f"""WITH {MOMENTS}, o AS (SELECT * FROM m WHERE datatype <> 'ERROR'),
        b AS (SELECT *, CASE WHEN moment < lag(moment) OVER (PARTITION BY station_id ORDER BY moment) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS begins FROM o),
        n AS (SELECT *, sum(begins) OVER (PARTITION BY station_id ORDER BY moment ROWS UNBOUNDED PRECEDING) AS no FROM b)
        SELECT station_id, count(*) AS n_obs, min(event_id) AS first_event FROM n GROUP BY station_id, no
        HAVING max(moment) + INTERVAL 6 HOUR <= (SELECT max(moment) FROM o) - INTERVAL 3 DAY""",
    "station_anomalies": f"""WITH {MOMENTS}, {ARRIVALS_PLAIN}, t AS (SELECT * FROM a0 WHERE datatype IN ('TMAX', 'TMIN')),
        x AS (SELECT a.event_id, a.station_id, a.obs_value AS value, count(*) AS n, avg(b.obs_value) AS mean, stddev_pop(b.obs_value) AS deviation
              FROM t a JOIN t b ON a.station_id = b.station_id AND b.d < a.d GROUP BY 1, 2, 3)
        SELECT event_id, station_id, value FROM x WHERE n >= 5 AND abs(value - mean) > 1.5 * deviation""",
}
