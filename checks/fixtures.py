"""The given tables seen as weather and air-quality inputs.

Every function here has a twin of the same name in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.functions.aqi import aqi, co_milligrams
from hazemill.operators.clean import conform
from hazemill.plans.star import Star
from hazemill.schemas import FACT_AIR, FACT_WEATHER
from hazemill.sources.calendar import days_of_years, generate_hours

# The readings span 2024 and January 2025.
FIRST_DAY, YEARS = "2024-01-01", (2024, 2025)
# Readings per landed document at most: event ids are unique, so a block of ids bounds an array.
BATCH = 5_000

READING = [
    "event_id",
    "CAST(user_id % 25 AS INT) AS city_id",
    "CAST(ts AS DATE) + CAST((user_id % 13) * 30 AS INT) AS full_date",
    "CAST(hour(ts) AS INT) AS hour",
    "value * 0.5e0 AS pm25",
    "(event_id * 37 % 1300) / 10e0 AS pm10",
    "(event_id * 53 % 14000) * 1e0 AS co",
    "(event_id * 17 % 900) / 10e0 AS so2",
    "(event_id * 29 % 1100) / 10e0 AS no2",
    "(event_id * 41 % 1700) / 10e0 AS o3",
    "400e0 + event_id % 50 AS co2",
    "15e0 + (event_id * 13 % 250) / 10e0 AS temperature",
    "40e0 + (event_id * 7 % 600) / 10e0 AS humidity",
    "(event_id * 11 % 300) / 10e0 AS wind_speed",
    "CASE WHEN event_id % 10 = 0 THEN (event_id % 70) / 10e0 ELSE 0e0 END AS rain",
    "CASE WHEN event_id % 10 = 0 THEN (event_id % 80) / 10e0 ELSE 0e0 END AS precipitation",
    "(event_id * 19 % 1000) / 10e0 AS cloud_cover",
    "12e0 + (event_id * 23 % 270) / 10e0 AS apparent_temperature",
    "event_id % 100 AS weather_code",
    "event_id * 17 % 360 AS wind_direction",
    "event_type",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather and air-quality reading per event."""
    return table(spark, sf_dir, "events").selectExpr(*READING)


def dim_date(spark: SparkSession) -> DataFrame:
    years = spark.range(YEARS[0], YEARS[-1] + 1, 1, 1).select(F.col("id").cast("int").alias("year"))
    date_id = F.datediff("full_date", F.lit(FIRST_DAY).cast("date")) + 1
    return days_of_years(years).withColumn("date_id", date_id)


def dim_time(spark: SparkSession) -> DataFrame:
    return generate_hours(spark).withColumn("time_id", F.col("hour") + 1)


def dim_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS city_id",
        "n_name AS city_name",
        "'Việt Nam' AS country",
        "n_nationkey * 1.5e0 AS lon",
        "n_nationkey * 0.5e0 AS lat",
    )


def _with_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "date_id": F.datediff("full_date", F.lit(FIRST_DAY).cast("date")) + 1,
            "time_id": F.col("hour") + 1,
            "aq_id": F.col("event_id"),
            "weather_id": F.col("event_id"),
        }
    )


def fact_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).withColumn("co_mg", co_milligrams()).withColumn("aqi", aqi())
    return conform(_with_keys(rows), FACT_AIR)


def fact_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_with_keys(readings(spark, sf_dir)), FACT_WEATHER)


def star_air(spark: SparkSession, sf_dir: str) -> Star:
    return Star(fact_air(spark, sf_dir), dim_city(spark, sf_dir), dim_date(spark), dim_time(spark))


def star_weather(spark: SparkSession, sf_dir: str) -> Star:
    return Star(fact_weather(spark, sf_dir), dim_city(spark, sf_dir), dim_date(spark), dim_time(spark))


def _documents(spark: SparkSession, sf_dir: str, variables: dict[str, str]) -> DataFrame:
    """Raw documents: one per city, month of readings and block of event ids."""
    time = F.concat(F.date_format("full_date", "yyyy-MM-dd"), F.format_string("T%02d:00", "hour"))
    hours = readings(spark, sf_dir).withColumns(
        {
            "run_date": F.trunc("full_date", "month"),
            "batch": F.expr(f"event_id DIV {BATCH}"),
            "reading": F.struct(
                "event_id", time.alias("time"), *(F.expr(e).alias(name) for name, e in variables.items())
            ),
        }
    )
    collected = hours.groupBy("city_id", "run_date", "batch").agg(
        F.array_sort(F.collect_list("reading")).alias("hourly")
    )
    named = collected.join(dim_city(spark, sf_dir).select("city_id", "city_name"), "city_id")
    return named.select(
        F.col("city_id").cast("long").alias("city_id"),
        "city_name",
        "run_date",
        "batch",
        *(F.col(f"hourly.{name}").alias(name) for name in ("time", *variables)),
    )


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rain is missing for 'error' events."""
    return _documents(
        spark,
        sf_dir,
        {
            "temperature_2m": "temperature",
            "relative_humidity_2m": "humidity",
            "dew_point_2m": "temperature - 5e0",
            "wind_speed_10m": "wind_speed",
            "wind_direction_10m": "wind_direction",
            "precipitation": "precipitation",
            "weather_code": "weather_code",
            "apparent_temperature": "apparent_temperature",
            "rain": "CASE WHEN event_type <> 'error' THEN rain END",
            "cloud_cover_low": "cloud_cover",
        },
    )


def air_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ozone is missing for 'error' events."""
    return _documents(
        spark,
        sf_dir,
        {
            "pm10": "pm10",
            "pm2_5": "pm25",
            "carbon_monoxide": "co",
            "carbon_dioxide": "co2",
            "nitrogen_dioxide": "no2",
            "sulphur_dioxide": "so2",
            "ozone": "CASE WHEN event_type <> 'error' THEN o3 END",
        },
    )
