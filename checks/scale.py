"""Time reports on many copies of the events, a third of them from one user.

    python -m checks.scale FOLDER COPIES

writes the copies to FOLDER (new, with room for them) and prints one line per query.
"""

from __future__ import annotations

import sys
import time

from bench import noop, stored_stars
from checks import fixtures as fx
from checks.queries import QUERIES, REPORTS, correlation
from hazemill.session import build_session

SOURCE = "/root/testdata/sf0.1"
TABLES = ("nation", "region", "customer", "orders")
FROM_TABLES = ("aqi_hourly", "dedup_first", "latest_snapshot", "load_fact_aq", "lookup_misses", "fk_violations")


def main(folder: str, copies: int) -> None:
    spark = build_session(
        "scale",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "32",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in TABLES:
        fx.table(spark, SOURCE, name).write.parquet(f"{folder}/{name}.parquet")
    events = fx.table(spark, SOURCE, "events")
    size = events.count()
    events.selectExpr("*", f"explode(sequence(0, {copies} - 1)) AS copy").selectExpr(
        f"event_id + copy * {size}L AS event_id",
        "ts",
        "IF(event_id % 3 = 0, 7L, user_id + copy * 25 * 13) AS user_id",
        "event_type",
        "value",
        "props",
    ).repartition(64).write.parquet(f"{folder}/events.parquet")

    def timed(name, action):
        start = time.perf_counter()
        action()
        print(f"{name:20s} {time.perf_counter() - start:7.2f}", flush=True)

    for name in FROM_TABLES:
        timed(name, lambda: noop(QUERIES[name](spark, folder)))

    def store_facts() -> None:
        for name, derive in (("air", fx.fact_air), ("weather", fx.fact_weather)):
            derive(spark, folder).write.parquet(f"{folder}/fact_{name}")

    timed("store_facts", store_facts)
    stars = stored_stars(spark, folder, folder)
    for name, (fact, report) in REPORTS.items():
        timed(name, lambda: noop(report(stars[fact])))
    timed("weather_aqi_corr", lambda: noop(correlation(stars["weather"].fact, stars["air"].fact)))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]))
