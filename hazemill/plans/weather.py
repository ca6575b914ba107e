"""Weather reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.plans.star import Star, choose

GRAINS = {"hour": ["hour"], "day": ["full_date"], "month": ["year", "month"]}
AVERAGES = {"avg_temp": "temperature", "avg_hum": "humidity", "avg_wind": "wind_speed", "avg_rain": "rain"}


def avg_weather_by_time(star: Star, freq: str = "day", city_id: int | None = None) -> DataFrame:
    """Average temperature, humidity, wind and rain per city and day or month.

    ``hour`` lists the single readings of all cities in order instead: no average is taken
    and ``city_id`` is ignored. The fact id at the end of the sort key lets Spark cut a
    city's hour with very many readings into several sorted ranges.
    """
    period = choose(GRAINS, freq)
    if freq == "hour":
        rows = star.named(star.timed(star.fact)).orderBy("city_id", "hour", "weather_id")
        return rows.select("city_id", "city_name", "hour", "rain", "wind_speed", "humidity", "temperature")
    averages = [F.avg(measure).alias(name) for name, measure in AVERAGES.items()]
    grouped = star.dated(star.of_city(city_id).fact).groupBy("city_id", *period).agg(*averages)
    return star.named(grouped).select("city_id", "city_name", *period, *AVERAGES).orderBy("city_id", *period)


def national_weather_summary(star: Star) -> DataFrame:
    """Average temperature, humidity and wind per calendar month, all years and cities pooled."""
    averages = [F.avg(AVERAGES[name]).alias(name) for name in ("avg_temp", "avg_hum", "avg_wind")]
    return star.dated(star.fact).groupBy("month").agg(*averages).orderBy("month")
