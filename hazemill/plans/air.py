"""Air-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazemill.operators.ranking import dense_ranks
from hazemill.plans.star import Star, choose

PERIODS = {"month": ["year", "month"], "year": ["year"]}
HIGH_AQI = 150


def extreme_avg_aqi_by_time(star: Star, freq: str) -> DataFrame:
    """Average AQI per city and period, ranked within the period (1 is the worst).

    AQI values are whole numbers, so their sums and the ranks are exact in any order.
    """
    period = choose(PERIODS, freq)
    grouped = star.dated(star.fact).groupBy("city_id", *period).agg(F.avg("aqi").alias("avg_aqi"))
    ranked = dense_ranks(grouped, period, {"rank": F.col("avg_aqi")})
    return (
        star.named(ranked)
        .select("city_id", "city_name", *period, "avg_aqi", "rank")
        .orderBy(*period, "rank", "city_id")
    )


def high_aqi_days(star: Star) -> DataFrame:
    """City-hours with an AQI above 150."""
    high = star.fact.filter(F.col("aqi") > HIGH_AQI)
    return star.dated(star.timed(star.named(high))).select(
        "aq_id", "city_name", "full_date", "hour", "aqi", "pm25", "pm10", "no2", "o3", "co", "so2"
    )


def compare_pollution_metrics_by_city(star: Star, freq: str, digits: int = 9) -> DataFrame:
    """Average AQI, PM2.5 and PM10 per city and period, each ranked within the period.

    PM averages are ranked at ``digits`` decimals: sums of fractions differ in the last
    bits with the order of the rows, and equal cities must not get different ranks.
    """
    period = choose(PERIODS, freq)
    averages = {f"avg_{m}": F.avg(m) for m in ("aqi", "pm25", "pm10")}
    grouped = star.dated(star.fact).groupBy("city_id", *period).agg(*(v.alias(n) for n, v in averages.items()))
    ranks = {
        "rank_aqi": F.col("avg_aqi"),
        "rank_pm25": F.round("avg_pm25", digits),
        "rank_pm10": F.round("avg_pm10", digits),
    }
    ranked = dense_ranks(grouped, period, ranks)
    return (
        star.named(ranked)
        .select("city_id", "city_name", *period, *averages, *ranks)
        .orderBy(*period, "rank_aqi", "city_id")
    )


def peak_pollution_hours(star: Star, limit: int = 1, city_id: int | None = None) -> DataFrame:
    """The ``limit`` hours of the day with the highest average AQI in each city.

    Equal averages keep the order of city name and hour. A window sees at most 24 rows.
    """
    hourly = star.of_city(city_id).fact.groupBy("city_id", "time_id").agg(F.avg("aqi").alias("aqi"))
    worst_first = Window.partitionBy("city_id").orderBy(F.desc("aqi"), "city_name", "hour")
    return (
        star.named(star.timed(hourly))
        .withColumn("rank_aqi", F.row_number().over(worst_first))
        .filter(F.col("rank_aqi") <= limit)
        .select("city_id", "city_name", "hour", "aqi", "rank_aqi")
        .orderBy("city_id", "rank_aqi", "hour")
    )
