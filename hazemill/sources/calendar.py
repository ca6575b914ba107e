"""Generated calendar rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.functions.dates import day_of_week, is_weekend, time_bucket


def with_date_parts(days: DataFrame, day: str = "full_date") -> DataFrame:
    return days.select(
        F.col(day).alias("full_date"),
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        is_weekend(day).alias("is_weekend"),
        day_of_week(day).alias("day_of_week"),
    )


def days_of_years(years: DataFrame, year: str = "year") -> DataFrame:
    """One row per day of every year listed."""
    days = f"explode(sequence(make_date({year}, 1, 1), make_date({year}, 12, 31), INTERVAL 1 DAY)) AS full_date"
    return with_date_parts(years.selectExpr(days))


def generate_dates(spark: SparkSession, year: int | None = None) -> DataFrame:
    """Every day of ``year``, the current one by default."""
    one = spark.range(0, 1, 1, 1)
    return days_of_years(one.select((F.year(F.current_date()) if year is None else F.lit(year)).alias("year")))


def generate_hours(spark: SparkSession) -> DataFrame:
    """The 24 hours of a day."""
    return spark.range(0, 24, 1, 1).select(
        F.col("id").cast("int").alias("hour"),
        F.lit(0).alias("minute"),
        F.lit(0).alias("second"),
        time_bucket(F.col("id")).alias("time_bucket"),
    )
