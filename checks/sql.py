"""SQL for the registered queries, over the given tables."""

from __future__ import annotations


def _mean(expression: str, places: int | None = None) -> str:
    """Average of the raw values; to 9 decimals first where it is rounded, for equal halves."""
    mean = f"AVG({expression})"
    return mean if places is None else f"ROUND(ROUND({mean}, 9), {places})"


_K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"

_RAW = f"""raw AS (
  SELECT event_id,
         'ST' || user_id AS station,
         'L' || (user_id % 5) AS location,
         CASE WHEN event_id % 97 <> 0 THEN ts END AS observation_time,
         CASE WHEN event_id % 89 <> 0 THEN value END AS temperature_f,
         {_K} + value / 7 AS humidity_pct,
         ROUND(value / 4, 2) AS wind_speed_mph,
         1013.25 - value / 7 AS pressure_mb,
         event_type AS condition
  FROM events)"""

_STAGED = f"""{_RAW}, staged AS (
  SELECT event_id,
         station AS station_id,
         location,
         observation_time AS observation_timestamp,
         ROUND((temperature_f - 32) * (5.0::DOUBLE / 9), 2) AS "temperature_degC",
         temperature_f,
         humidity_pct,
         ROUND(wind_speed_mph * 0.44704, 2) AS wind_speed_mps,
         wind_speed_mph,
         pressure_mb,
         condition
  FROM raw
  WHERE observation_time IS NOT NULL)"""

_FACT = f"""{_STAGED}, fact AS (
  SELECT ROW_NUMBER() OVER (ORDER BY observation_timestamp, event_id) AS observation_id,
         observation_timestamp, station_id, location, "temperature_degC", temperature_f,
         humidity_pct, wind_speed_mps, wind_speed_mph, pressure_mb, condition,
         CAST(DATE_TRUNC('day', observation_timestamp) AS TIMESTAMP) AS observation_date,
         EXTRACT(HOUR FROM observation_timestamp) AS observation_hour,
         EXTRACT(DOW FROM observation_timestamp) AS day_of_week
  FROM staged)"""

_SPREAD = f"""spread AS (
  SELECT station_id,
         {_mean('"temperature_degC"')} AS avg_temp,
         STDDEV("temperature_degC") AS stddev_temp
  FROM staged
  GROUP BY station_id)"""

_Z = 'ABS(o."temperature_degC" - s.avg_temp) / NULLIF(s.stddev_temp, 0)'

_CATEGORY = f"""CASE WHEN {_Z} > 2 THEN 'Extreme' WHEN {_Z} > 1 THEN 'Unusual' ELSE 'Normal' END"""

_DAILY = f"""SELECT station_id, location, observation_date,
       COUNT(*) AS observation_count,
       {_mean('"temperature_degC"', 2)} AS "avg_temperature_degC",
       ROUND(MIN("temperature_degC"), 2) AS "min_temperature_degC",
       ROUND(MAX("temperature_degC"), 2) AS "max_temperature_degC",
       {_mean("humidity_pct", 2)} AS avg_humidity_pct,
       {_mean("wind_speed_mps", 2)} AS avg_wind_speed_mps,
       ROUND(MAX(wind_speed_mps), 2) AS max_wind_speed_mps,
       {_mean("pressure_mb", 2)} AS avg_pressure_mb
FROM fact
GROUP BY station_id, location, observation_date"""

_EXTREME = f"""SELECT o.observation_id, o.observation_timestamp, o.station_id, o."temperature_degC",
       ROUND(s.avg_temp, 6) AS avg_temp, ROUND(s.stddev_temp, 6) AS stddev_temp, ROUND({_Z}, 6) AS temp_z_score,
       {_CATEGORY} AS temperature_category
FROM fact o JOIN spread s ON o.station_id = s.station_id
WHERE s.stddev_temp IS NOT NULL AND {_Z} > 1"""

_ROLLING = """SELECT station_id, observation_timestamp, humidity_pct, event_id,
       ROUND(AVG(humidity_pct) OVER w, 6) AS rolling_24h_avg
FROM staged {where}
WINDOW w AS (PARTITION BY station_id ORDER BY observation_timestamp, event_id
             ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"""

_ROLLING_DAY = """SELECT station_id, observation_timestamp, humidity_pct, event_id,
       ROUND(AVG(humidity_pct) OVER (PARTITION BY station_id ORDER BY observation_timestamp
         RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW), 6) AS rolling_24h_avg
FROM staged"""

_CHARGE = "(l_extendedprice * (1 - l_discount) * (1 + l_tax))"

_MONTHLY = f"""SELECT l_suppkey, EXTRACT(MONTH FROM l_shipdate) AS month,
       COUNT(*) AS obs_count,
       ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY {_CHARGE}), 4) AS median_temp,
       ROUND(PERCENTILE_CONT(0.95) WITHIN GROUP (ORDER BY l_extendedprice), 4) AS p95_wind,
       CAST(SUM(CASE WHEN l_tax > 0 THEN 1 ELSE 0 END) AS BIGINT) AS precip_hours,
       {_mean(f"CASE WHEN l_discount > 0.05::DOUBLE THEN {_CHARGE} END", 4)} AS avg_temp_humid
FROM lineitem
GROUP BY l_suppkey, EXTRACT(MONTH FROM l_shipdate)"""

_NUMBERED_ORDERS = """SELECT o_orderkey, o_orderdate,
       ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS order_number
FROM orders"""

_LOADED = f"""SELECT ts AS observation_timestamp,
       'obs-' || event_id AS observation_id,
       'Feature' AS observation_type,
       'Point' AS geometry_type,
       '-' || (user_id % 180) || '.50,40.640' AS geometry_coordinates,
       CAST(user_id % 100 AS DOUBLE) AS elevation_m,
       'ST' || user_id AS station_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS station_name,
       value AS "temperature_degC",
       CAST(NULL AS DOUBLE) AS "dewpoint_degC",
       CAST(NULL AS DOUBLE) AS wind_direction_deg,
       CASE WHEN {_K} > 50 THEN {_K} END AS wind_speed_kmh,
       CAST(NULL AS DOUBLE) AS wind_gust_kmh,
       CAST(NULL AS DOUBLE) AS "barometric_pressure_Pa",
       CAST(NULL AS DOUBLE) AS "sea_level_pressure_Pa",
       CAST(NULL AS DOUBLE) AS visibility_m,
       CAST(NULL AS DOUBLE) AS "max_temp_24h_degC",
       CAST(NULL AS DOUBLE) AS "min_temp_24h_degC",
       CAST(NULL AS DOUBLE) AS precipitation_3h_mm,
       {_K} AS relative_humidity_percent,
       CAST(NULL AS DOUBLE) AS "wind_chill_degC",
       CAST(NULL AS DOUBLE) AS "heat_index_degC"
FROM events"""

_TIMINGS = """timings AS (
  SELECT user_id AS query, event_type AS format, value / 7 AS time_ms FROM events)"""

_RUN_STATS = f"""{_TIMINGS}, ranked AS (
  SELECT query, format, time_ms,
         ROW_NUMBER() OVER (PARTITION BY query, format ORDER BY time_ms) - 1 AS place,
         COUNT(*) OVER (PARTITION BY query, format) AS n
  FROM timings), stats AS (
  SELECT query, format,
         COUNT(*) AS runs,
         MEDIAN(time_ms) AS median,
         {_mean("time_ms", 2)} AS mean,
         ROUND(MIN(time_ms), 2) AS min,
         ROUND(MAX(time_ms), 2) AS max,
         MAX(CASE WHEN place = LEAST(CAST(FLOOR(n * 0.95::DOUBLE) AS BIGINT), n - 1)
                  THEN time_ms END) AS p95,
         ROUND(COALESCE(STDDEV(time_ms), 0), 2) AS stddev
  FROM ranked GROUP BY query, format)"""

_REPORT = f"""{_RUN_STATS}, report AS (
  SELECT v.query, v.median AS base_median, c.median AS other_median,
         ROUND((c.median - v.median) / NULLIF(v.median, 0) * 100, 1) AS overhead_pct
  FROM stats v JOIN stats c ON v.query = c.query AND v.format = 'view' AND c.format = 'click')"""

_CHAIN = """RECURSIVE links AS (
  SELECT p.url AS page, CASE WHEN p.page_id % 100 = 20 THEN p.url || '/gone' ELSE n.url END AS next
  FROM pages p LEFT JOIN pages n ON n.page_id = CASE WHEN p.page_id % 50 = 49 THEN NULL
    WHEN p.page_id % 150 = 110 THEN p.page_id - 7 ELSE p.page_id + 1 END),
walk AS (
  SELECT url AS start, url AS page, 0::BIGINT AS position, [url] AS seen FROM pages WHERE page_id % 50 = 0
  UNION ALL
  SELECT start, n.page, position + 1, list_append(seen, n.page)
  FROM walk JOIN links l ON walk.page = l.page JOIN links n ON n.page = l.next
  WHERE NOT list_contains(seen, n.page)),
walked AS (
  SELECT w.start, l.page, l.next, w.position, FALSE AS differing,
         CASE WHEN w.position IS NULL THEN 'unreachable' WHEN l.next IS NULL THEN 'last'
              WHEN l.next NOT IN (SELECT page FROM links) THEN 'missing'
              WHEN n.position = w.position + 1 THEN 'followed' ELSE 'cycle' END AS status
  FROM links l LEFT JOIN walk w ON w.page = l.page
  LEFT JOIN walk n ON n.start = w.start AND n.page = l.next)"""

_LANDED = """CASE WHEN event_id % 7 = 0 THEN 2 WHEN observation_timestamp < '2024-01-16' THEN 0 ELSE 1 END"""

_ANOMALIES = f"""SELECT o.event_id, o.observation_timestamp, o.station_id, o."temperature_degC",
       ROUND(s.avg_temp, 6) AS avg_temp, ROUND(s.stddev_temp, 6) AS stddev_temp, ROUND({_Z}, 6) AS temp_z_score
FROM staged o JOIN spread s ON o.station_id = s.station_id WHERE {_Z} > 2"""

_STATIONS = f"""WITH {_STAGED}
SELECT station_id, location, MIN(observation_timestamp) AS first_observation,
       MAX(observation_timestamp) AS last_observation, COUNT(*) AS total_observations
FROM staged WHERE station_id IS NOT NULL GROUP BY station_id, location"""

SQL: dict[str, str] = {
    "stg_observations": f"WITH {_STAGED} SELECT * FROM staged",
    "fact_observations": f"WITH {_FACT} SELECT * FROM fact",
    "fact_observations_split": f"WITH {_FACT} SELECT * FROM fact",
    "daily_weather": f"WITH {_FACT} {_DAILY}",
    "dim_stations": _STATIONS,
    "extreme_events": f"WITH {_FACT}, {_SPREAD} {_EXTREME}",
    "classify_observations": f"""WITH {_STAGED}, {_SPREAD}
SELECT o.event_id, o.station_id, ROUND({_Z}, 6) AS temp_z_score, {_CATEGORY} AS temperature_category
FROM staged o JOIN spread s ON o.station_id = s.station_id""",
    "union_sources": f"""WITH {_STAGED}
SELECT * EXCLUDE (event_id) FROM staged
UNION ALL
SELECT 'SU' || l_suppkey, l_returnflag, l_shipdate, ROUND(l_quantity, 2),
       ROUND(l_quantity * 9 / 5 + 32, 2), l_discount * 1000, ROUND(l_quantity / 3.6, 2),
       ROUND(l_quantity / 3.6 / 0.44704, 2), ROUND(l_extendedprice / 100, 2), NULL
FROM lineitem WHERE l_shipdate IS NOT NULL""",
    "build_marts": f"""WITH {_FACT}, {_SPREAD}, daily AS ({_DAILY}), extreme AS ({_EXTREME})
SELECT 'stg_observations' AS model, station_id, observation_timestamp AS moment, event_id AS number,
       "temperature_degC" AS reading FROM staged
UNION ALL SELECT 'fact_observations', station_id, observation_timestamp, observation_id,
       "temperature_degC" FROM fact
UNION ALL SELECT 'fact_daily_weather', station_id, observation_date, observation_count,
       avg_pressure_mb FROM daily
UNION ALL SELECT 'dim_stations', station_id, MIN(observation_timestamp), COUNT(*), NULL
FROM staged WHERE station_id IS NOT NULL GROUP BY station_id, location
UNION ALL SELECT 'extreme_weather_events', station_id, observation_timestamp, observation_id,
       temp_z_score FROM extreme""",
    "full_scan": "SELECT * FROM lineitem",
    "count_star": "SELECT COUNT(*) AS row_count FROM lineitem",
    "filtered_scan": """SELECT * FROM events
WHERE event_type = 'view' AND ts >= '2024-01-08' AND ts < '2024-01-15'""",
    "daily_aggregation": f"""SELECT l_suppkey,
       CAST(DATE_TRUNC('day', l_shipdate) AS TIMESTAMP) AS observation_date,
       COUNT(*) AS observation_count,
       {_mean(_CHARGE, 2)} AS avg_temp,
       ROUND(MIN({_CHARGE}), 2) AS min_temp,
       ROUND(MAX({_CHARGE}), 2) AS max_temp,
       {_mean("l_discount", 2)} AS avg_humidity,
       {_mean("l_quantity", 2)} AS avg_wind,
       ROUND(MAX(l_quantity), 2) AS max_wind,
       {_mean("l_tax", 2)} AS avg_pressure
FROM lineitem GROUP BY l_suppkey, DATE_TRUNC('day', l_shipdate)""",
    "anomaly_detection": f"WITH {_STAGED}, {_SPREAD} {_ANOMALIES}",
    "station_dimension": f"""SELECT c_custkey, c_name, c_nationkey,
       COUNT(*) AS total_observations, MIN(o_orderdate) AS first_observation,
       MAX(o_orderdate) AS last_observation, {_mean("o_totalprice / 7", 6)} AS avg_temp
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_custkey, c_name, c_nationkey""",
    "rolling_avg": f"WITH {_STAGED} " + _ROLLING.format(where=""),
    "rolling_avg_split": f"WITH {_STAGED} " + _ROLLING.format(where=""),
    "rolling_avg_stations": f"WITH {_STAGED} "
    + _ROLLING.format(where="WHERE station_id IN ('ST1', 'ST2', 'ST3')"),
    "rolling_24h_range": f"WITH {_STAGED} {_ROLLING_DAY}",
    "rolling_24h_range_split": f"WITH {_STAGED} {_ROLLING_DAY}",
    "approx_stations": f"""WITH {_STAGED}
SELECT condition, COUNT(*) AS n_rows, COUNT(DISTINCT station_id) AS stations, TRUE AS within
FROM staged GROUP BY condition""",
    "approx_percentiles": """SELECT l_suppkey, EXTRACT(MONTH FROM l_shipdate) AS month, COUNT(*) AS n_rows,
       TRUE AS median_within, TRUE AS p95_within FROM lineitem GROUP BY 1, 2""",
    "monthly_percentiles": _MONTHLY,
    "monthly_percentiles_split": _MONTHLY,
    "load_stats": f"""WITH {_STAGED}
SELECT COUNT(DISTINCT station_id) AS unique_stations,
       MIN(observation_timestamp) AS earliest_observation,
       MAX(observation_timestamp) AS latest_observation, COUNT(*) AS row_count,
       {_mean("humidity_pct", 6)} AS "avg_temp_degC",
       MIN(humidity_pct) AS "min_temp_degC", MAX(humidity_pct) AS "max_temp_degC"
FROM staged""",
    "latest_observations": f"""WITH {_STAGED}
SELECT observation_timestamp, station_id, "temperature_degC", wind_speed_mps, humidity_pct
FROM staged ORDER BY observation_timestamp DESC, event_id LIMIT 5""",
    "numbered_orders": _NUMBERED_ORDERS,
    "numbered_orders_split": _NUMBERED_ORDERS,
    "json_extract": """SELECT event_id, json_extract_string(props, '$.k') AS k,
       json_extract_string(props, '$.missing') AS missing FROM events""",
    "features_explode": """SELECT 'obs-' || event_id AS observation_id,
       'ST' || user_id AS station_id, value AS temperature FROM events""",
    "flatten_observations": _LOADED,
    "load_observations": _LOADED,
    "load_rejects": """WITH landed AS (
  SELECT user_id % 50 = 0 AS broken, event_id % 97 = 0 AS homeless, event_type = 'error' AS unread,
         user_id, event_id // 500 AS page FROM events)
SELECT 'unreadable document' AS reason, COUNT(*) AS row_count
FROM (SELECT DISTINCT user_id, page FROM landed WHERE broken) HAVING COUNT(*) > 0
UNION ALL
SELECT CASE WHEN homeless AND unread THEN 'station_id is missing; temperature_degC is no double'
            WHEN homeless THEN 'station_id is missing'
            WHEN unread THEN 'temperature_degC is no double' ELSE 'loaded' END, COUNT(*)
FROM landed WHERE NOT broken GROUP BY 1""",
    "load_quality": """WITH landed AS (
  SELECT user_id % 50 = 0 AS broken, event_id % 97 = 0 AS homeless, event_type = 'error' AS unread,
         user_id, event_id // 500 AS page FROM events),
broken AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT user_id, page FROM landed WHERE broken)),
counts AS (
  SELECT 'loaded' AS measure, COUNT(*) FILTER (NOT homeless AND NOT unread) AS row_count FROM landed WHERE NOT broken
  UNION ALL
  SELECT 'rejected', (SELECT n FROM broken) + COUNT(*) FILTER (homeless OR unread) FROM landed WHERE NOT broken
  UNION ALL SELECT 'unreadable document', n FROM broken WHERE n > 0
  UNION ALL SELECT 'station_id is missing', COUNT(*) FROM landed WHERE NOT broken AND homeless HAVING COUNT(*) > 0
  UNION ALL SELECT 'temperature_degC is no double', COUNT(*) FROM landed WHERE NOT broken AND unread HAVING COUNT(*) > 0)
SELECT measure, row_count, CASE WHEN measure IN ('loaded', 'rejected') THEN row_count END AS rows_read FROM counts""",
    "schema_drift": """WITH d AS (
  SELECT CASE WHEN event_id % 40 = 0 THEN 'broken' WHEN event_id % 25 = 0 THEN 'sensor'
              WHEN event_id % 15 = 0 THEN 'text' WHEN event_id % 10 = 0 THEN 'unit'
              WHEN event_id % 9 = 0 THEN 'tags' ELSE 'plain' END AS form FROM events),
f(form, path, kind, status) AS (VALUES
  ('broken', '', NULL, 'unreadable'),
  ('sensor', 'k', 'integer', 'known'), ('sensor', 'sensor', 'object', 'known'),
  ('sensor', 'sensor.model', 'string', 'known'), ('sensor', 'sensor.rev', 'integer', 'unknown field'),
  ('text', 'k', 'string', 'other type'),
  ('unit', 'k', 'integer', 'known'), ('unit', 'unit', 'string', 'unknown field'),
  ('tags', 'k', 'number', 'other type'), ('tags', 'tags', 'array', 'unknown field'),
  ('tags', 'tags[]', 'string', 'unknown field'), ('tags', 'tags[]', 'integer', 'unknown field'),
  ('plain', 'k', 'integer', 'known'))
SELECT path, kind, COUNT(*) AS documents, status FROM d JOIN f USING (form) GROUP BY path, kind, status
UNION ALL SELECT 'note', NULL, 0, 'never seen'""",
    "station_pages": """SELECT url AS station_url,
       CASE WHEN contains(url, 'page=') THEN url END AS next_page FROM pages""",
    "page_cursor": """SELECT DISTINCT url AS next_page, split_part(url, 'page=', -1) AS cursor
FROM pages WHERE contains(url, 'page=')""",
    "page_chain": f"WITH {_CHAIN} SELECT * FROM walked",
    "chain_report": f"""WITH {_CHAIN}
SELECT start, status, COUNT(*) AS pages, MAX(position) AS furthest FROM walked GROUP BY start, status""",
    "refresh_daily": f"WITH {_FACT} {_DAILY}",
    "fact_increment": f"""WITH {_FACT}
SELECT event_id, f.* REPLACE (
  ROW_NUMBER() OVER (ORDER BY {_LANDED}, f.observation_timestamp, event_id) AS observation_id)
FROM fact f JOIN (SELECT event_id, ROW_NUMBER() OVER (ORDER BY observation_timestamp, event_id) AS observation_id
                  FROM staged) s USING (observation_id)""",
    "daily_spread": f"""WITH {_STAGED}, {_SPREAD}
SELECT station_id, ROUND(avg_temp, 6) AS avg_temp, ROUND(stddev_temp, 6) AS stddev_temp FROM spread""",
    "url_key": "SELECT page_id, url, split_part(url, '/', -1) AS station_id FROM pages",
    "append_rows": "SELECT * FROM orders",
    "overwrite_rows": "SELECT * FROM orders WHERE o_totalprice > 100000",
    "overwrite_partitioned": """SELECT *, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) > '2024-01-10' AND value > 20""",
    "replace_mart_schema": """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority, o_orderpriority = '1-URGENT' AS urgent FROM orders""",
    "update_where": """SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END
         AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders""",
    "delete_where": "SELECT * FROM orders WHERE (o_orderstatus = 'F') IS NOT TRUE",
    "update_rows": """SELECT event_id, ts, user_id, event_type,
       CASE WHEN event_type = 'error' AND ts >= '2024-01-20' THEN value + 1 ELSE value END AS value,
       props, CAST(ts AS DATE) AS day FROM events""",
    "delete_rows": """SELECT *, CAST(ts AS DATE) AS day FROM events
WHERE (ts < '2024-01-05' OR value > 100) IS NOT TRUE""",
    "replace_partitions": """SELECT event_id, ts, user_id, event_type,
       CASE WHEN ts >= '2024-01-20' THEN 0 ELSE value END AS value,
       props, CAST(ts AS DATE) AS day FROM events""",
    "incremental_anti": """SELECT * FROM events e WHERE NOT EXISTS (
  SELECT 1 FROM events d WHERE d.event_id = e.event_id AND d.ts < '2024-01-16')""",
    "parquet_roundtrip": "SELECT * FROM orders",
    "managed_table_scan": "SELECT * FROM supplier",
    "weather_samples": f"""WITH {_STAGED}
SELECT event_id AS id, station_id AS name, location || ',' || condition AS tags,
       "temperature_degC" AS temperature, EXTRACT(HOUR FROM observation_timestamp) AS hour
FROM staged WHERE "temperature_degC" > 20""",
    "clustered_scan": f"WITH {_STAGED} SELECT * FROM staged WHERE station_id = 'ST7'",
    "clustered_rollup": _STATIONS,
    "clustered_rollup_split": _STATIONS,
    "not_null_violations": f"""WITH {_RAW}
SELECT 'station' AS column_name, COUNT(*) FILTER (station IS NULL) AS violations FROM raw
UNION ALL SELECT 'observation_time', COUNT(*) FILTER (observation_time IS NULL) FROM raw
UNION ALL SELECT 'temperature_f', COUNT(*) FILTER (temperature_f IS NULL) FROM raw""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, COUNT(*) AS copies
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "accepted_values": """SELECT event_type, COUNT(*) AS row_count FROM events
WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY event_type""",
    "reconcile_counts": """SELECT COALESCE(l.k, o.k) AS order_key,
       COALESCE(l.n, 0) AS left_rows, COALESCE(o.n, 0) AS right_rows,
       COALESCE(l.n, 0) - COALESCE(o.n, 0) AS difference
FROM (SELECT l_orderkey AS k, COUNT(*) AS n FROM lineitem GROUP BY 1) l
FULL JOIN (SELECT o_orderkey AS k, COUNT(*) AS n FROM orders GROUP BY 1) o ON l.k = o.k""",
    "schema_contract": """SELECT event_id,
       CASE WHEN event_type <> 'error'
            THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       event_type, event_type <> 'error' AS accepted FROM events""",
    "run_stats": f"""WITH {_RUN_STATS}
SELECT * REPLACE (ROUND(median, 4) AS median, ROUND(p95, 4) AS p95) FROM stats""",
    "run_stats_split": f"""WITH {_RUN_STATS}
SELECT * REPLACE (ROUND(median, 4) AS median, ROUND(p95, 4) AS p95) FROM stats""",
    "overhead_report": f"""WITH {_REPORT}
SELECT query, ROUND(base_median, 4) AS base_median, ROUND(other_median, 4) AS other_median,
       overhead_pct,
       CASE WHEN overhead_pct < -5 THEN 'click FASTER' WHEN overhead_pct < 5 THEN '~Same'
            WHEN overhead_pct < 20 THEN 'Slight overhead'
            WHEN overhead_pct IS NOT NULL THEN 'Significant overhead' END AS verdict
FROM report""",
    "mean_overhead": f"""WITH {_REPORT}
SELECT COUNT(overhead_pct) AS queries, {_mean("overhead_pct", 1)} AS avg_overhead
FROM report""",
    "result_export": f"""WITH {_RUN_STATS}
SELECT * REPLACE (ROUND(median, 4) AS median, ROUND(p95, 4) AS p95) FROM stats""",
    "stream_ingest": "SELECT * FROM events",
    "stream_daily": f"WITH {_FACT} {_DAILY}",
    "stream_rollup": f"WITH {_FACT} {_DAILY}",
    "stream_anomalies": f"WITH {_STAGED}, {_SPREAD} {_ANOMALIES}",
    "stream_late": """WITH e AS (
  SELECT event_id, ts, CASE WHEN event_id % 7 = 0 THEN 2 WHEN ts < '2024-01-16' THEN 0 ELSE 1 END AS batch FROM events),
delivered AS (
  SELECT batch, event_id, ts, FALSE AS again FROM e
  UNION ALL SELECT 1, event_id, ts, TRUE FROM e WHERE batch = 0 AND event_id % 5 = 0),
marks AS (
  SELECT 0 AS batch, NULL::TIMESTAMP AS since
  UNION ALL SELECT b, MAX(ts) - INTERVAL 2 DAY FROM e, (VALUES (1), (2)) v(b) WHERE batch < b GROUP BY b),
marked AS (
  SELECT batch, CASE WHEN ts < since THEN 'late' WHEN again THEN 'repeated' ELSE 'landed' END AS outcome
  FROM delivered JOIN marks USING (batch)),
landed AS (SELECT COUNT(*) AS n FROM marked WHERE outcome = 'landed')
SELECT batch::BIGINT AS batch, outcome, COUNT(*) AS row_count, n AS landed_rows, n AS landed_keys
FROM marked, landed GROUP BY batch, outcome, n""",
    "stream_dedup": "SELECT * FROM events",
}
