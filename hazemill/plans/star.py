"""The star schema seen from one fact table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.functions.dates import iso_week

DATE_ATTRIBUTES = ("full_date", "day", "month", "year", "quarter", "is_weekend", "day_of_week")


@dataclass(frozen=True)
class Star:
    """A fact table with its dimensions.

    Loading has checked the keys, so every fact matches each dimension once. Reports rely
    on that: they join only the dimensions they need, and attach city names after they
    have aggregated by ``city_id``.
    """

    fact: DataFrame
    city: DataFrame
    date: DataFrame
    time: DataFrame

    def view(self, week: bool = False) -> DataFrame:
        """Denormalised rows: fact columns, city name, hour and date attributes (and ISO week)."""
        measures = [c for c in self.fact.columns if c != "full_date"]
        named = self.dated(self.named(self.timed(self.fact)))
        weeks = [iso_week("full_date").alias("week")] if week else []
        return named.select(*measures, "city_name", "hour", *DATE_ATTRIBUTES, *weeks)

    def dated(self, rows: DataFrame) -> DataFrame:
        """Attach date attributes. Where rows carry the partition column, joining on it as well
        lets a filter on the dates prune partitions."""
        keys = ["date_id", "full_date"] if "full_date" in rows.columns else ["date_id"]
        return rows.join(self.date.select("date_id", *DATE_ATTRIBUTES), keys)

    def timed(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.time.select("time_id", "hour"), "time_id")

    def named(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.city.select("city_id", "city_name"), "city_id")

    def of_city(self, city_id: int | None) -> "Star":
        if city_id is None:
            return self
        return Star(self.fact.filter(F.col("city_id") == city_id), self.city, self.date, self.time)


def choose(options: dict, name: str) -> list[str]:
    if name not in options:
        raise ValueError(f"freq must be one of {list(options)}, not {name!r}")
    return options[name]
