"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data, BENCH_CPUS (default 8) the cores.
``load_fact`` checks, numbers and loads the processed rows of a month through the warehouse, again
over what it holds. ``daily_facts`` and ``incremental_facts`` (the third of three runs, with new
files) take landed JSON Lines of some days through cleaning into the warehouse.
``store_facts`` derives both fact tables from the given tables, AQI included, and writes
them; the reports then read those tables, as they would read the warehouse. ``clean_weather``
and ``clean_air`` read landed JSON Lines made of the given tables, explode and clean them (and
compute the AQI). The other queries read the given tables. Each query runs once to warm up; its value is the median of
the next three runs. Results go to the noop sink, which computes every column of every row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession

from checks import fixtures as fx
from checks.queries import QUERIES, REPORTS, correlation
from hazemill.operators.clean import clean_air, clean_weather, with_aqi
from hazemill.plans.jobs import Zones, daily_facts, incremental_facts
from hazemill.plans.star import Star
from hazemill.session import build_session, scratch_path
from hazemill.sources import calendar, landing
from hazemill.warehouse import Warehouse

FROM_TABLES = [
    "aqi_hourly",
    "dedup_first",
    "latest_snapshot",
    "clean_city",
    "first_geocode",
    "fetch_manifest",
    "upsert_city",
    "load_fact_aq",
    "load_fact_weather",
    "fk_violations",
    "null_violations",
    "lookup_misses",
]
RUNS = 3


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], None]) -> float:
    runs = []
    for _ in range(1 + RUNS):
        start = time.perf_counter()
        action()
        runs.append(time.perf_counter() - start)
    return round(statistics.median(runs[1:]), 4)


def stored_stars(spark: SparkSession, sf_dir: str, root: str) -> dict[str, Star]:
    dims = {"city": fx.dim_city(spark, sf_dir), "date": fx.dim_date(spark), "time": fx.dim_time(spark)}
    for name, dim in dims.items():
        dim.write.mode("overwrite").parquet(f"{root}/{name}")
    city, date, hour = (spark.read.parquet(f"{root}/{name}") for name in dims)
    return {
        fact: Star(spark.read.parquet(f"{root}/fact_{fact}"), city, date, hour) for fact in ("air", "weather")
    }


# Days whose rows the load path is timed on.
MONTH = "full_date >= DATE'2024-02-01' AND full_date < DATE'2024-03-01'"


def load_path(spark: SparkSession, sf_dir: str, root: str) -> dict[str, float]:
    warehouse = Warehouse(spark, f"{root}/warehouse")
    warehouse.create()
    for year in fx.YEARS:
        warehouse.add_to_dimension("dim_date", calendar.generate_dates(spark, year))
    warehouse.add_to_dimension("dim_time", calendar.generate_hours(spark))
    warehouse.add_to_dimension("dim_city", fx.dim_city(spark, sf_dir))
    rows = fx.readings(spark, sf_dir).filter(MONTH).withColumnRenamed("full_date", "date")
    with_aqi(rows.selectExpr("*", "CAST(NULL AS STRING) AS reject")).write.parquet(f"{root}/processed_month")
    processed = spark.read.parquet(f"{root}/processed_month")
    seconds = {"load_fact": timed(lambda: warehouse.load_fact("fact_air_quality", processed))}

    month = f"date_format(run_date, 'yyyy-MM') = '{fx.FIRST_DAY[:7]}'"
    documents = {"weather": fx.weather_documents(spark, sf_dir), "aq": fx.air_documents(spark, sf_dir)}
    zones = Zones(f"{root}/landing", f"{root}/landed")
    for domain, of_month in documents.items():
        drop = "date_add(run_date, CAST(batch AS INT))"
        landing.write_drop(of_month.filter(month).selectExpr("* EXCEPT (run_date, batch)", f"{drop} AS run_date"), f"{zones.landing}/{domain}")
    seconds["daily_facts"] = timed(lambda: daily_facts(warehouse, zones))
    runs = []
    for run in range(3):
        for domain in documents:
            # Files of other cities in each run.
            new = spark.read.json(f"{zones.landing}/{domain}").filter(f"city_id % 3 = {run}")
            new.write.mode("append").partitionBy("run_date").json(f"{root}/arriving/{domain}")
        start = time.perf_counter()
        incremental_facts(warehouse, Zones(f"{root}/arriving", f"{root}/arrived"), f"{root}/offsets", layouts=("lines",))
        runs.append(time.perf_counter() - start)
    seconds["incremental_facts"] = round(runs[-1], 4)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "bench")

    def store_facts() -> None:
        for name, derive in (("air", fx.fact_air), ("weather", fx.fact_weather)):
            derive(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/fact_{name}")

    seconds = {name: timed(lambda: noop(QUERIES[name](spark, sf_dir))) for name in FROM_TABLES}
    for domain, documents, clean in (
        ("weather", fx.weather_documents, clean_weather),
        ("aq", fx.air_documents, clean_air),
    ):
        # A city has several documents in a month here, and none is a copy: each is its own drop.
        landing.write_drop(documents(spark, sf_dir), f"{root}/{domain}")
        seconds[clean.__name__] = timed(
            lambda: noop(clean(landing.read_landing(spark, f"{root}/{domain}", domain), drop=("run_date", "source")))
        )
    seconds |= load_path(spark, sf_dir, root)
    seconds["store_facts"] = timed(store_facts)
    stars = stored_stars(spark, sf_dir, root)
    for name, (fact, report) in REPORTS.items():
        seconds[name] = timed(lambda: noop(report(stars[fact])))
    seconds["weather_aqi_corr"] = timed(lambda: noop(correlation(stars["weather"].fact, stars["air"].fact)))
    result = {
        "metric": "warm_median_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
