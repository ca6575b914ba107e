"""DuckDB SQL over the given tables that must give the same rows as the queries."""

from __future__ import annotations

from checks.fixtures import BATCH, FIRST_DAY, READING
from checks.queries import ASKED, DIGITS, STRETCH

# Fixed values, written out here so that the queries' own tables are checked against them: of each
# pollutant the bands of its concentration (co in mg), least and greatest, and those of the index.
BANDS = {
    "pm25": [(0, 35), (36, 75), (76, 115), (116, 150), (151, 250), (251, 350), (351, 500)],
    "pm10": [(0, 50), (51, 100), (101, 250), (251, 350), (351, 430), (431, 500), (501, 600)],
    "co": [(0, 5), (5.1, 10), (10.1, 35), (35.1, 60), (60.1, 90), (90.1, 120), (120.1, 150)],
    "so2": [(0, 50), (51, 100), (101, 350), (351, 500), (501, 750), (751, 1000), (1001, 1200)],
    "no2": [(0, 40), (41, 80), (81, 180), (181, 280), (281, 400), (401, 500), (501, 600)],
    "o3": [(0, 100), (101, 160), (161, 215), (216, 265), (266, 800), (801, 1000), (1001, 1200)],
}
INDEX = [(0, 50), (51, 100), (101, 150), (151, 200), (201, 300), (301, 400), (401, 500)]


def sub_index(pollutant: str, c: str) -> str:
    cases = " ".join(
        f"WHEN {c} BETWEEN {low}e0 AND {high}e0 THEN "
        f"({i_high}e0 - {i_low}e0) / ({high}e0 - {low}e0) * ({c} - {low}e0) + {i_low}e0"
        for (low, high), (i_low, i_high) in zip(BANDS[pollutant], INDEX)
    )
    return f"CAST(round_even(CASE {cases} END, 0) AS INT)"


def aqi_of(o3: str = "o3", pm25: str = "pm25") -> str:
    inputs = {"pm25": pm25, "pm10": "pm10", "co": "(co / 1000e0)", "so2": "so2", "no2": "no2", "o3": o3}
    return f"greatest({', '.join(sub_index(p, c) for p, c in inputs.items())})"


AQI = aqi_of()

READINGS = f"readings AS (SELECT {', '.join(READING)} FROM events)"
CITY = """dim_city AS (
  SELECT n_nationkey AS city_id, n_name AS city_name, 'Việt Nam' AS country,
         n_nationkey * 1.5e0 AS lon, n_nationkey * 0.5e0 AS lat
  FROM nation)"""
DATE_PARTS = """full_date, CAST(day(full_date) AS INT) AS day, CAST(month(full_date) AS INT) AS month,
  CAST(year(full_date) AS INT) AS year, CAST(quarter(full_date) AS INT) AS quarter,
  isodow(full_date) >= 6 AS is_weekend, CAST(isodow(full_date) - 1 AS VARCHAR) AS day_of_week"""


def days(name: str, first: str, last: str) -> str:
    return f"""{name} AS (
  SELECT CAST(date_diff('day', DATE '{FIRST_DAY}', full_date) + 1 AS INT) AS date_id, {DATE_PARTS}
  FROM (SELECT CAST(unnest(generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS DATE) AS full_date))"""


DATE = days("dim_date", "2024-01-01", "2025-12-31")
FIRST_YEAR = days("dim_date", "2024-01-01", "2024-12-31")
TIME = """dim_time AS (
  SELECT CAST(h + 1 AS INT) AS time_id, CAST(h AS INT) AS hour, 0 AS minute, 0 AS second,
         CASE WHEN h BETWEEN 6 AND 11 THEN 'Sáng' WHEN h BETWEEN 12 AND 17 THEN 'Chiều'
              WHEN h BETWEEN 18 AND 21 THEN 'Tối' ELSE 'Đêm' END AS time_bucket
  FROM range(24) t(h))"""
KEYS = f"""CAST(date_diff('day', DATE '{FIRST_DAY}', full_date) + 1 AS INT) AS date_id, city_id,
  CAST(hour + 1 AS INT) AS time_id"""
AIR = f"""fact_air AS (
  SELECT event_id AS aq_id, {KEYS}, CAST({AQI} AS DOUBLE) AS aqi, pm25, pm10, no2, so2, o3, co, co2, full_date
  FROM readings)"""
WEATHER = f"""fact_weather AS (
  SELECT event_id AS weather_id, {KEYS}, temperature, humidity, wind_speed, precipitation,
         CAST(weather_code AS VARCHAR) AS weather_code, cloud_cover, rain,
         CAST(wind_direction AS VARCHAR) AS wind_direction, apparent_temperature, full_date
  FROM readings)"""

ATTRIBUTES = "c.city_name, t.hour, d.full_date, d.day, d.month, d.year, d.quarter, d.is_weekend, d.day_of_week"
STAR = """JOIN dim_city c ON c.city_id = f.city_id JOIN dim_date d ON d.date_id = f.date_id
  JOIN dim_time t ON t.time_id = f.time_id"""
AIR_STAR = f"""WITH {READINGS}, {CITY}, {DATE}, {TIME}, {AIR},
  air AS (SELECT f.* EXCLUDE (full_date), {ATTRIBUTES}, CAST(week(d.full_date) AS INT) AS week
          FROM fact_air f {STAR})"""
WEATHER_STAR = f"""WITH {READINGS}, {CITY}, {DATE}, {TIME}, {WEATHER},
  weather AS (SELECT f.* EXCLUDE (full_date), {ATTRIBUTES} FROM fact_weather f {STAR})"""

AIR_COLUMNS = "city_id, full_date, hour, {aqi} AS aqi, pm25, pm10, no2, so2, o3, co, co2"
WEATHER_AVERAGES = ", ".join(
    f"round(avg({measure}), {DIGITS}) AS {name}"
    for name, measure in (
        ("avg_temp", "temperature"),
        ("avg_hum", "humidity"),
        ("avg_wind", "wind_speed"),
        ("avg_rain", "rain"),
    )
)


def _weather_average(period: str, where: str = "") -> str:
    return f"""{WEATHER_STAR}
      SELECT city_id, city_name, {period}, {WEATHER_AVERAGES} FROM weather {where}
      GROUP BY city_id, city_name, {period} ORDER BY city_id, {period}"""


def _rank(value: str, period: str) -> str:
    return f"CAST(dense_rank() OVER (PARTITION BY {period} ORDER BY {value} DESC) AS INT)"


def _extreme(period: str) -> str:
    return f"""{AIR_STAR},
      g AS (SELECT city_id, city_name, {period}, avg(aqi) AS a FROM air GROUP BY city_id, city_name, {period})
      SELECT city_id, city_name, {period}, round(a, {DIGITS}) AS avg_aqi, {_rank('a', period)} AS rank FROM g"""


def _compare(period: str) -> str:
    return f"""{AIR_STAR},
      g AS (SELECT city_id, city_name, {period}, avg(aqi) AS a, round(avg(pm25), {DIGITS}) AS p, round(avg(pm10), {DIGITS}) AS q
            FROM air GROUP BY city_id, city_name, {period})
      SELECT city_id, city_name, {period}, round(a, {DIGITS}) AS avg_aqi, p AS avg_pm25, q AS avg_pm10,
        {_rank('a', period)} AS rank_aqi, {_rank('p', period)} AS rank_pm25, {_rank('q', period)} AS rank_pm10
      FROM g"""


def _correlation(labels: dict[str, str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{label}' AS metric, "
        + ", ".join(
            f"round(corr({measure}, {w}), {DIGITS}) AS {w}" for w in ("rain", "wind_speed", "humidity", "temperature")
        )
        + " FROM pairs"
        for measure, label in labels.items()
    )
    return f"""WITH {READINGS}, {AIR}, {WEATHER},
      pairs AS (SELECT w.rain, w.wind_speed, w.humidity, w.temperature, a.aqi, a.pm10, a.pm25
                FROM fact_weather w JOIN fact_air a USING (city_id, date_id, time_id))
      {rows}"""


def _peak(limit: int, where: str = "") -> str:
    return f"""{AIR_STAR},
      g AS (SELECT city_id, city_name, hour, avg(aqi) AS a FROM air GROUP BY city_id, city_name, hour),
      r AS (SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY a DESC, city_name, hour) AS n FROM g)
      SELECT city_id, city_name, hour, round(a, {DIGITS}) AS aqi, CAST(n AS INT) AS rank_aqi
      FROM r WHERE n <= {limit} {where}"""


def _loaded(table: str, before: str, after: str = "0") -> str:
    return f"SELECT '{table}' AS table_name, {before} AS rows_before, CAST({after} AS BIGINT) AS rows_after"


COUNT_EVENTS = "(SELECT count(*) FROM events)"
COUNT_NATION = "(SELECT count(*) FROM nation)"

# Readings as the documents carry them: rain and ozone are missing for 'error' events and count as 0.
IMPUTED_RAIN = "CASE WHEN event_type <> 'error' THEN rain ELSE 0e0 END"
IMPUTED_O3 = "(CASE WHEN event_type <> 'error' THEN o3 ELSE 0e0 END)"

# Of a city's date the readings of the last block of event ids count.
NEWEST = f"""r AS (SELECT * FROM readings JOIN dim_city USING (city_id)
  QUALIFY event_id // {BATCH} = max(event_id // {BATCH}) OVER (PARTITION BY city_id, full_date))"""

ORACLES: dict[str, str] = {
    "latest_snapshot": """SELECT user_id, ts, event_id, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_drop": """SELECT event_id, value, CAST(ts AS DATE) AS run_date FROM events
      WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "scan_raw_json": f"""WITH {READINGS}, {CITY}
      SELECT CAST(city_id AS BIGINT) AS city_id, city_name, CAST(date_trunc('month', full_date) AS DATE) AS run_date,
        CAST(count(*) AS INT) AS n_hours, min(strftime(full_date, '%Y-%m-%d') || printf('T%02d:00', hour)) AS first_time,
        round(sum(pm25 ORDER BY event_id), {DIGITS}) AS total_pm25
      FROM readings JOIN dim_city USING (city_id)
      GROUP BY city_id, city_name, date_trunc('month', full_date), event_id // {BATCH}""",
    "raw_json_roundtrip": """SELECT c_custkey AS city_id, 'Tỉnh ' || c_name AS name, CAST(c_nationkey AS VARCHAR) AS lat,
        CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS lon, DATE '2024-01-01' AS run_date FROM customer""",
    "sink_roundtrip": f"""WITH {READINGS}
      SELECT event_id, {AIR_COLUMNS.format(aqi=AQI)}, co / 1000e0 AS co_mg,
        CAST(date_trunc('month', full_date) AS DATE) AS run_date FROM readings""",
    "stream_ingest": f"""WITH {READINGS}, {CITY}
      SELECT CAST(city_id AS BIGINT) AS city_id, city_name, full_date AS date, hour, pm25, {IMPUTED_O3} AS o3, co,
        co / 1000e0 AS co_mg, {aqi_of(IMPUTED_O3)} AS aqi
      FROM readings JOIN dim_city USING (city_id)""",
    "fetch_manifest": """WITH wanted AS (
        SELECT c_custkey AS city_id, c_name AS city_name, c_nationkey * 0.5e0 AS lat, c_nationkey * 1.5e0 AS lon,
          CAST(d AS DATE) AS start_date, CAST(d AS DATE) AS end_date
        FROM customer, generate_series(DATE '1996-01-01', DATE '1996-01-31', INTERVAL 1 DAY) t(d))
      SELECT * FROM wanted w WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = w.city_id AND CAST(o_orderdate AS DATE) = w.start_date)""",
    "attach_results": f"""SELECT c_custkey AS city_id, c_name AS city_name, event_id // {BATCH} AS batch,
        CAST(count(*) AS INT) AS n_hours, 0 AS n_ozone, max(value * 0.5e0) AS worst_pm25
      FROM customer JOIN events ON user_id = c_custkey GROUP BY ALL""",
    "fetch_failures": """SELECT c_custkey AS city_id, c_name AS city_name, c_nationkey * 0.5e0 AS lat,
        c_nationkey * 1.5e0 AS lon
      FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
    "attach_results_dated": f"""SELECT c_custkey AS city_id, CAST(o_orderdate AS DATE) AS start_date, c_name AS city_name,
        CAST(count(*) AS INT) AS n_hours, max(CAST(o_totalprice AS DOUBLE)) AS worst_pm25
      FROM customer JOIN orders ON o_custkey = c_custkey
      WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{ASKED[0]}' AND DATE '{ASKED[1]}' GROUP BY ALL""",
    "fetch_failures_dated": f"""SELECT c_custkey AS city_id, c_name AS city_name, c_nationkey * 0.5e0 AS lat,
        c_nationkey * 1.5e0 AS lon, CAST(d AS DATE) AS start_date, CAST(d AS DATE) AS end_date
      FROM customer, generate_series(DATE '{ASKED[0]}', DATE '{ASKED[1]}', INTERVAL 1 DAY) t(d)
      WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND CAST(o_orderdate AS DATE) = CAST(d AS DATE))""",
    "scan_unreadable": f"""WITH {READINGS}, {CITY}, hours AS (
        SELECT CAST(city_id AS BIGINT) AS city_id, wind_direction, event_id,
          row_number() OVER (PARTITION BY city_id, date_trunc('month', full_date), event_id // {BATCH} ORDER BY event_id) AS place
        FROM readings JOIN dim_city USING (city_id)),
      judged AS (
        SELECT *, CASE WHEN city_id % 5 = 1 THEN 'unreadable temperature_2m'
          WHEN city_id % 5 = 2 THEN 'arrays of different lengths'
          WHEN city_id % 5 = 3 AND place = 1 THEN 'unreadable time' END AS reject FROM hours)
      SELECT city_id, reject, count(*) AS n_rows,
        CASE WHEN city_id % 5 = 2 THEN '0' WHEN city_id % 5 = 0 THEN min(wind_direction || '.5') ELSE min(CAST(wind_direction AS VARCHAR)) END AS least_direction,
        CASE WHEN city_id % 5 = 2 THEN '0' WHEN city_id % 5 = 0 THEN max(wind_direction || '.5') ELSE max(CAST(wind_direction AS VARCHAR)) END AS greatest_direction
      FROM judged WHERE city_id % 5 <> 2 OR place = 1 GROUP BY city_id, reject""",
    "load_report": f"""WITH {READINGS}, judged AS (
        SELECT *, event_type = 'error' AND hour < 12 AS spoilt, {AQI} IS NULL AS no_index FROM readings),
      good AS (SELECT * FROM judged WHERE NOT spoilt)
      SELECT 'read' AS outcome, count(*) AS n FROM judged
      UNION ALL SELECT 'rejected', count(*) FILTER (spoilt) FROM judged
      UNION ALL SELECT 'unmatched', CAST(0 AS BIGINT)
      UNION ALL SELECT 'superseded', CAST(0 AS BIGINT)
      UNION ALL SELECT 'repeated', count(*) - count(DISTINCT (city_id, full_date, hour)) FROM good
      UNION ALL SELECT 'loaded', count(*) FROM good""",
    "first_geocode": """SELECT c_custkey AS city_id,
        CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_name END AS name,
        CAST(c_nationkey AS VARCHAR) AS lat, CAST(c_custkey AS VARCHAR) AS lon
      FROM customer WHERE c_acctbal >= 0""",
    "gen_dim_date": f"""WITH {READINGS}, {DATE},
      n AS (SELECT full_date, count(*) AS n_readings FROM readings GROUP BY full_date)
      SELECT d.* EXCLUDE (date_id), coalesce(n_readings, 0) AS n_readings FROM dim_date d LEFT JOIN n USING (full_date)
      WHERE year IN (SELECT year(full_date) FROM readings)""",
    "gen_dim_time": f"""WITH {READINGS}, {TIME},
      n AS (SELECT hour, count(*) AS n_readings FROM readings GROUP BY hour)
      SELECT t.* EXCLUDE (time_id), coalesce(n_readings, 0) AS n_readings FROM dim_time t LEFT JOIN n USING (hour)""",
    "clean_city": """SELECT c_custkey AS city_id, c_name AS city_name, CAST(c_nationkey AS DOUBLE) AS lat,
        105.25e0 AS lon, 'Việt Nam' AS country
      FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'""",
    "impute_zero": f"""WITH {READINGS} SELECT event_id, {IMPUTED_RAIN} AS rain,
        CASE WHEN event_type <> 'click' THEN weather_code ELSE 0 END AS weather_code FROM readings""",
    "dedup_first": """SELECT user_id, event_type, ts, event_id, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
    "explode_hourly": f"""WITH {READINGS}, {CITY}
      SELECT CAST(city_id AS BIGINT) AS city_id, city_name,
        strftime(full_date, '%Y-%m-%d') || printf('T%02d:00', hour) AS time, full_date AS date, hour, temperature,
        humidity, wind_speed, precipitation, weather_code, cloud_cover, {IMPUTED_RAIN} AS rain, wind_direction,
        apparent_temperature,
        CAST(count(*) OVER (PARTITION BY city_id, date_trunc('month', full_date), event_id // {BATCH}) AS INT)
          AS n_dew_point
      FROM readings JOIN dim_city USING (city_id)""",
    "aqi_hourly": f"""WITH {READINGS}
      SELECT event_id, {AIR_COLUMNS.format(aqi=AQI)}, co / 1000e0 AS co_mg FROM readings""",
    "iso_week": f"""WITH {READINGS}
      SELECT event_id, full_date, CAST(week(full_date) AS INT) AS week FROM readings""",
    "conform_schema": f"WITH {READINGS}, {WEATHER} SELECT * FROM fact_weather",
    "init_dw": " UNION ALL ".join(
        (
            _loaded("dim_city", COUNT_NATION),
            _loaded("dim_date", "CAST(731 AS BIGINT)"),
            _loaded("dim_time", "CAST(24 AS BIGINT)"),
            _loaded("fact_weather", "CAST(0 AS BIGINT)"),
            _loaded("fact_air_quality", COUNT_EVENTS),
        )
    ),
    "reset_fact": f"{_loaded('dim_city', COUNT_NATION, COUNT_NATION)} UNION ALL {_loaded('fact_air_quality', COUNT_EVENTS)}",
    "upsert_city": """SELECT s_suppkey AS city_id, s_name AS city_name FROM supplier
      UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
    "upsert_date": f"""WITH {READINGS}, {DATE},
      known AS (SELECT {DATE_PARTS} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders))
      SELECT * FROM known
      UNION ALL SELECT * EXCLUDE (date_id) FROM dim_date
      WHERE year IN (SELECT year(full_date) FROM readings) AND full_date NOT IN (SELECT full_date FROM known)""",
    "upsert_time": f"""WITH {READINGS}, {TIME},
      seen AS (SELECT DISTINCT hour, 'seen' AS time_bucket FROM readings WHERE pm25 > 150)
      SELECT * FROM seen
      UNION ALL SELECT hour, time_bucket FROM dim_time WHERE hour NOT IN (SELECT hour FROM seen)""",
    "surrogate_dim": f"""WITH {READINGS}, {DATE},
      known AS (SELECT DISTINCT full_date,
                  CAST(date_diff('day', DATE '{FIRST_DAY}', full_date) + 1 AS INT) AS date_id
                FROM readings WHERE event_type = 'error')
      SELECT * FROM known
      UNION ALL SELECT full_date,
        CAST((SELECT max(date_id) FROM known) + row_number() OVER (ORDER BY full_date) AS INT) AS date_id
      FROM dim_date WHERE full_date NOT IN (SELECT full_date FROM known)""",
    "surrogate_fact": """SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id
      FROM events""",
    "load_overlapping": """SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(0 AS BIGINT) AS n_above_log FROM events""",
    "load_fact_aq": f"""WITH {READINGS}, {FIRST_YEAR}, {TIME}, {AIR}
      SELECT f.* FROM fact_air f JOIN dim_date USING (full_date)
      JOIN dim_time t ON t.time_id = f.time_id""",
    "load_fact_weather": f"""WITH {READINGS}, {FIRST_YEAR}, {TIME}, {WEATHER}
      SELECT f.* FROM fact_weather f JOIN dim_date USING (full_date)
      JOIN dim_time t ON t.time_id = f.time_id""",
    "load_idempotent": f"WITH {READINGS} SELECT {AIR_COLUMNS.format(aqi=f'CAST({AQI} AS DOUBLE)')} FROM readings",
    "fk_violations": f"""WITH {READINGS}
      SELECT city_id, count(*) AS row_count FROM readings WHERE city_id NOT IN (
        SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA')
      GROUP BY city_id""",
    "null_violations": f"""WITH {READINGS}, n AS (
        SELECT 'rain' AS column_name, count(*) FILTER (event_type = 'error') AS nulls FROM readings
        UNION ALL SELECT 'humidity', count(*) FILTER (pm25 > 150) FROM readings)
      SELECT 'fact_weather' AS table_name, column_name, nulls FROM n WHERE nulls > 0""",
    "unique_violations": """SELECT city_id, count(*) AS copies FROM (
        SELECT s_suppkey AS city_id FROM supplier UNION ALL SELECT c_custkey FROM customer)
      GROUP BY city_id HAVING count(*) > 1""",
    "lookup_misses": f"""WITH {READINGS}, rows AS (
        SELECT CASE WHEN event_type <> 'error' OR rain = 0 THEN full_date END AS date, hour FROM readings),
      flagged AS (SELECT date, hour, count(*) AS row_count, date IS NULL OR year(date) <> 2024 AS date_missing,
                    hour >= 22 AS hour_missing FROM rows GROUP BY ALL)
      SELECT * FROM flagged WHERE date_missing OR hour_missing""",
    "star_weather": f"{WEATHER_STAR} SELECT * FROM weather",
    "star_air": f"{AIR_STAR} SELECT * FROM air",
    "avg_weather_hour": f"""{WEATHER_STAR}
      SELECT city_id, city_name, hour, rain, wind_speed, humidity, temperature FROM weather ORDER BY city_id, hour""",
    "avg_weather_day": _weather_average("full_date"),
    "avg_weather_day_city": _weather_average("full_date", "WHERE city_id = 7"),
    "avg_weather_month": _weather_average("year, month"),
    "national_month": f"""{WEATHER_STAR}
      SELECT month, round(avg(temperature), {DIGITS}) AS avg_temp, round(avg(humidity), {DIGITS}) AS avg_hum,
        round(avg(wind_speed), {DIGITS}) AS avg_wind
      FROM weather GROUP BY month ORDER BY month""",
    "extreme_aqi_month": _extreme("year, month"),
    "extreme_aqi_year": _extreme("year"),
    "high_aqi": f"""{AIR_STAR}
      SELECT aq_id, city_name, full_date, hour, aqi, pm25, pm10, no2, o3, co, so2 FROM air WHERE aqi > 150""",
    "compare_month": _compare("year, month"),
    "compare_year": _compare("year"),
    "weather_aqi_corr": _correlation({"aqi": "AQI", "pm10": "PM10", "pm25": "PM2.5"}),
    "weather_aqi_corr_legacy": _correlation({"aqi": "AQI", "pm10": "PM2.5", "pm25": "PM10"}),
    "peak_hours": _peak(2),
    "peak_hours_city": _peak(3, "AND city_id = 7"),
    "job_dims": f"""WITH {FIRST_YEAR}, {TIME}
      SELECT 'dim_city' AS table_name, CAST(c_custkey AS INT) AS id, c_name AS natural_key, 'Việt Nam' AS attribute
      FROM customer WHERE c_acctbal >= 0
      UNION ALL SELECT 'dim_date', date_id, CAST(full_date AS VARCHAR), day_of_week FROM dim_date
      UNION ALL SELECT 'dim_time', time_id, CAST(hour AS VARCHAR), time_bucket FROM dim_time""",
    "job_daily": f"""WITH {READINGS}, {CITY}, {NEWEST}
      SELECT 'fact_weather' AS table_name, city_name, full_date, hour, temperature AS m1, {IMPUTED_RAIN} AS m2,
        CAST(wind_direction AS DOUBLE) AS m3 FROM r
      UNION ALL SELECT 'fact_air_quality', city_name, full_date, hour, CAST({aqi_of(IMPUTED_O3)} AS DOUBLE),
        {IMPUTED_O3}, pm25 FROM r""",
}

ORACLES["job_incremental"] = ORACLES["job_daily"]

RECRAWLED_PM25 = "(pm25 + CASE WHEN city_id % 3 = 0 THEN 1e0 ELSE 0e0 END)"
ORACLES["load_groupings"] = f"""WITH {READINGS}, {CITY}, {NEWEST}
  SELECT grouping_name, city_name, full_date, hour, {RECRAWLED_PM25} AS pm25,
    CAST({aqi_of(IMPUTED_O3, RECRAWLED_PM25)} AS DOUBLE) AS aqi
  FROM r, (VALUES ('at once'), ('newest drop first'), ('as they land')) g(grouping_name)"""

for _pollutant, _factor in STRETCH.items():
    _value = f"(co / 1000e0) * {_factor}e0" if _pollutant == "co" else f"{_pollutant} * {_factor}e0"
    ORACLES[f"aqi_subindex_{_pollutant}"] = f"""WITH {READINGS}, s AS (
        SELECT event_id, {_value} AS concentration FROM readings)
      SELECT event_id, concentration, {sub_index(_pollutant, 'concentration')} AS sub_index FROM s"""
