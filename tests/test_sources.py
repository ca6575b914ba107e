import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from hazemill import storage
from hazemill.functions.dates import iso_week
from hazemill.schemas import HOURLY_AIR
from hazemill.sources import calendar, landing, manifest, processed
from tests.conftest import final_plan, rows


def city(city_id, name="Đà Nẵng", lat="16.0"):
    return {"city_id": city_id, "name": name, "lat": lat, "lon": 108.2, "place_rank": 8}


def write_array(folder, name, documents):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(documents, ensure_ascii=False, indent=4), encoding="utf-8")


def test_both_layouts_are_read(spark, tmp_path):
    write_array(tmp_path / "run_date=2024-01-01", "city_2024-01-01.json", [city(1), city(2, lat=16.5)])
    schema = "city_id long, name string, lat string, lon string, run_date date"
    lines = spark.createDataFrame([(3, "Huế", "16.4", "107.6", date(2024, 1, 2))], schema)
    landing.write_drop(lines, str(tmp_path))
    found = landing.read_landing(spark, str(tmp_path), "city")
    assert rows(found.select("city_id", "name", "lat", "run_date")) == [
        (1, "Đà Nẵng", "16.0", date(2024, 1, 1)),
        (2, "Đà Nẵng", "16.5", date(2024, 1, 1)),
        (3, "Huế", "16.4", date(2024, 1, 2)),
    ]


def test_source_keeps_the_order_of_the_file(spark, tmp_path):
    write_array(tmp_path / "run_date=2024-01-01", "city_2024-01-01.json", [city(i) for i in (5, 3, 9, 1)])
    found = landing.read_landing(spark, str(tmp_path), "city").orderBy("source")
    assert [r["city_id"] for r in found.collect()] == [5, 3, 9, 1]


def test_a_rerun_replaces_its_drop_only(spark, tmp_path):
    schema = "city_id long, name string, lat string, lon string, run_date date"
    first, second = date(2024, 1, 1), date(2024, 1, 2)
    for name in ("a", "b"):
        landing.write_drop(spark.createDataFrame([(1, name, "1", "1", first)], schema), str(tmp_path))
    landing.write_drop(spark.createDataFrame([(2, "c", "1", "1", second)], schema), str(tmp_path))
    found = landing.read_landing(spark, str(tmp_path), "city")
    assert rows(found.select("name", "run_date")) == [("b", first), ("c", second)]
    assert rows(landing.latest_drop(found).select("name")) == [("c",)]


def test_latest_drop_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 5 AS INT)) AS run_date").write.partitionBy(
        "run_date"
    ).parquet(path)
    newest = landing.latest_drop(spark.read.parquet(path))
    plan = final_plan(newest)
    assert newest.count() == 2
    assert "PartitionFilters: [isnotnull(run_date" in plan and "Subquery" in plan


def test_malformed_document(spark, tmp_path):
    folder = tmp_path / "run_date=2024-01-01"
    folder.mkdir()
    (folder / "city_1.json").write_text('[{"city_id": 1, "name": ')
    path = str(tmp_path)
    assert landing.read_landing(spark, path, "city").filter("name IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        landing.read_landing(spark, path, "city", strict=True).select("name").collect()


def test_latest_file(spark, tmp_path):
    assert landing.latest_file(spark, str(tmp_path), "city_*.json") is None
    with pytest.raises(FileNotFoundError):
        landing.latest_file(spark, str(tmp_path), "date_*.parquet", required=True)
    for name, age in (("city_b.json", 2000), ("city_a.json", 1000), ("other.json", 1)):
        write_array(tmp_path, name, [city(1)])
        os.utime(tmp_path / name, (1_700_000_000 - age,) * 2)
    assert landing.latest_file(spark, str(tmp_path), "city_*.json").endswith("/city_a.json")


def test_latest_run_date_lists_folders(spark, tmp_path):
    write_array(tmp_path, "city_0.json", [city(1)])
    assert landing.latest_run_date(spark, str(tmp_path)) is None
    for day in ("2024-02-01", "2024-10-01"):
        write_array(tmp_path / "zone" / f"run_date={day}", f"city_{day}.json", [city(1)])
    path = str(tmp_path / "zone")
    assert landing.latest_run_date(spark, path) == date(2024, 10, 1)
    one = landing.read_landing(spark, path, "city", run_date=date(2024, 2, 1))
    assert rows(one.select("city_id", "run_date")) == [(1, date(2024, 2, 1))]
    assert all("2024-02-01" in file for file in one.inputFiles())


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 2, "c"), (1, 2, "d")], "k int, t int, v string")
    assert rows(landing.latest_per_key(df, ["k"], ["t"])) == [(1, 3, "b"), (2, 2, "c")]


@pytest.mark.parametrize(("year", "days"), [(2023, 365), (2024, 366)])
def test_days_of_a_year(spark, year, days):
    generated = calendar.generate_dates(spark, year)
    assert generated.count() == days
    first = generated.orderBy("full_date").first()
    assert (first["full_date"], first["quarter"]) == (date(year, 1, 1), 1)


def test_current_year_by_default(spark):
    assert rows(calendar.generate_dates(spark).select("year").distinct()) == rows(
        spark.range(1).select(F.year(F.current_date()))
    )


def test_week_days(spark):
    found = {r["full_date"]: r for r in calendar.generate_dates(spark, 2024).collect()}
    monday, saturday, sunday = (found[date(2024, 1, d)] for d in (1, 6, 7))
    assert (monday["day_of_week"], monday["is_weekend"]) == ("0", False)
    assert saturday["is_weekend"]
    assert (sunday["day_of_week"], sunday["is_weekend"]) == ("6", True)
    assert rows(spark.sql("SELECT DATE'2021-01-01' AS d").select(iso_week("d"))) == [(53,)]


def test_hours(spark):
    bucket = {r["hour"]: r["time_bucket"] for r in calendar.generate_hours(spark).collect()}
    assert len(bucket) == 24
    assert [bucket[h] for h in (5, 6, 11, 12, 17, 18, 21, 22)] == [
        "Đêm", "Sáng", "Sáng", "Chiều", "Chiều", "Tối", "Tối", "Đêm",
    ]


CITIES = "city_id int, city_name string, lat double, lon double"


def test_manifest_asks_for_yesterday(spark):
    cities = spark.createDataFrame([(1, "a", 1.0, 2.0)], CITIES)
    (row,) = manifest.fetch_manifest(cities).collect()
    yesterday = spark.range(1).select(F.date_sub(F.current_date(), 1)).first()[0]
    assert (row["city_id"], row["start_date"], row["end_date"]) == (1, yesterday, yesterday)


def test_manifest_lists_gaps(spark):
    cities = spark.createDataFrame([(1, "a", 1.0, 2.0), (2, "b", 1.0, 2.0)], CITIES)
    first, last = date(2024, 1, 1), date(2024, 1, 2)
    loaded = spark.createDataFrame([(1, first), (1, first), (2, last)], "city_id int, full_date date")
    gaps = manifest.fetch_manifest(cities, F.lit(first), F.lit(last), loaded)
    assert rows(gaps.select("city_id", "start_date")) == [(1, last), (2, first)]
    plan = final_plan(gaps)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_attach_results(spark):
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "city_id int, city_name string")
    answers = spark.createDataFrame(
        [(1, (["2024-01-01T00:00"], [1.0])), (2, ([], []))],
        "city_id int, hourly struct<time: array<string>, pm2_5: array<double>>",
    )
    spread = manifest.hourly_variables(answers, HOURLY_AIR)
    attached = manifest.attach_results(asked, spread)
    assert rows(attached.select("city_id", "city_name", F.size("time"), F.size("ozone"))) == [
        (1, "a", 1, 0),
        (2, "b", 0, 0),
    ]
    assert rows(manifest.failed_fetches(asked, spread)) == [(3, "c")]


def test_results_of_several_days(spark):
    asked = spark.createDataFrame([(1, "a", "d1"), (1, "a", "d2"), (2, "b", "d1")], "city_id int, city_name string, start_date string")
    answers = spark.createDataFrame([(1, "d1", 5), (2, "d1", 6)], "city_id int, start_date string, n int")
    assert rows(manifest.attach_results(asked, answers).select("city_id", "start_date", "n")) == [(1, "d1", 5), (2, "d1", 6)]
    assert rows(manifest.failed_fetches(asked, answers).select("city_id", "start_date")) == [(1, "d2")]


def test_first_geocode(spark):
    provinces = spark.createDataFrame([(1, "Tỉnh A"), (2, "Tỉnh B"), (3, "Tỉnh C"), (4, "Tỉnh D")], "code int, name string")
    geocodes = spark.createDataFrame(
        [
            (1, [("A", "1.0", "2.0"), ("other", "9", "9")]),
            (2, [(None, "3.0", "4.0")]),
            (3, []),
            (4, None),
        ],
        "code int, detail array<struct<name: string, lat: string, lon: string>>",
    )
    assert rows(manifest.first_geocode(provinces, geocodes)) == [(1, "A", "1.0", "2.0"), (2, "Tỉnh B", "3.0", "4.0")]


def test_processed_rerun_replaces_its_drop(spark, tmp_path):
    path = str(tmp_path)
    for value in (1.0, 2.0):
        df = spark.createDataFrame([(7, value, date(2024, 1, 1))], "city_id long, pm10 double, run_date date")
        processed.write_processed(df, path)
    assert rows(processed.read_processed(spark, path, "aq").select("city_id", "pm10", "aqi")) == [(7, 2.0, None)]


def test_responses_of_other_days_leave_before_the_join(spark):
    cities = spark.range(20_000).selectExpr("id AS city_id", "'x' AS city_name", "0D AS lat", "0D AS lon")
    asked = manifest.fetch_manifest(cities, F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 3)))
    day = "IF(id < 3, DATE'2024-01-02', DATE'2023-01-01') AS start_date"
    answers = spark.range(40_000).selectExpr("id % 20000 AS city_id", day, "id AS n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50KB")
    try:
        attached = manifest.attach_results(asked, answers)
        plan = final_plan(attached)
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        assert rows(attached.select("city_id", "city_name", "n")) == [(i, "x", i) for i in range(3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_landed_drop_is_one_file_from_many_tasks(spark, tmp_path):
    documents = spark.range(0, 40, 1, 8).selectExpr("id AS city_id", "date_add(DATE'2024-01-01', CAST(id % 2 AS INT)) AS run_date")
    landing.write_drop(documents, str(tmp_path / "drops"))
    assert [len(list((tmp_path / "drops" / f"run_date=2024-01-0{d}").glob("part-*.json"))) for d in (1, 2)] == [1, 1]
    assert spark.read.json(str(tmp_path / "drops")).count() == 40


def test_names_and_holds(spark, tmp_path):
    folder = tmp_path / "listed"
    assert storage.names(spark, str(folder)) == [] and not storage.holds(spark, str(folder))
    (folder / "_temporary").mkdir(parents=True)
    (folder / ".part.crc").write_text("")
    assert storage.names(spark, str(folder)) == [] and not storage.holds(spark, str(folder))
    for name in ("run_date=2024-01-02", "run_date=2024-01-01", "với dấu cách"):
        (folder / name).mkdir()
    assert storage.names(spark, str(folder)) == ["run_date=2024-01-01", "run_date=2024-01-02", "với dấu cách"]
    assert storage.holds(spark, str(folder))
