from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from hazemill.operators.clean import (
    COUNTRY,
    NO_INDEX,
    RAGGED,
    clean_air,
    clean_city,
    clean_weather,
    conform,
    dedup_first,
    explode_hourly,
    impute_zero,
    with_date_and_hour,
)
from hazemill.schemas import FACT_WEATHER, RAW_AIR, RAW_CITY, RAW_WEATHER
from tests.conftest import final_plan, rows

DAY = date(2024, 1, 1)
TIMES = [f"2024-01-01T{h:02d}:00" for h in range(24)]
EXTRA = [StructField("run_date", DateType()), StructField("source", IntegerType())]


def documents(spark, schema, *docs):
    full = StructType(schema.fields + EXTRA)
    return spark.createDataFrame([[d.get(f.name) for f in full.fields] for d in docs], full)


def air(position, city_id=1, hours=24, run_date=DAY, **arrays):
    doc = {f.name: [float(h) for h in range(hours)] for f in RAW_AIR.fields if f.name not in ("city_id", "city_name")}
    doc |= {"time": TIMES[:hours], "city_id": city_id, "city_name": f"city {city_id}"}
    return doc | {"run_date": run_date, "source": position} | arrays


def weather(position, city_id=1, hours=24, run_date=DAY, **arrays):
    doc = {
        f.name: [h if "long" in f.dataType.simpleString() or "bigint" in f.dataType.simpleString() else float(h)
                 for h in range(hours)]
        for f in RAW_WEATHER.fields
        if f.name not in ("city_id", "city_name", "time")
    }
    doc |= {"time": TIMES[:hours], "city_id": city_id, "city_name": f"city {city_id}"}
    return doc | {"run_date": run_date, "source": position} | arrays


def test_one_row_per_hour(spark):
    found = clean_air(documents(spark, RAW_AIR, air(0))).orderBy("hour").collect()
    assert [r["hour"] for r in found] == list(range(24))
    assert {r["date"] for r in found} == {DAY}
    assert [r["pm25"] for r in found] == [float(h) for h in range(24)]
    assert all(r["reject"] is None for r in found)


def test_missing_element_counts_as_zero(spark):
    found = clean_weather(documents(spark, RAW_WEATHER, weather(0, hours=2, weather_code=[None, 3.0]))).collect()
    assert sorted(r["weather_code"] for r in found) == [0, 3]


def test_empty_arrays_give_one_row_without_date(spark):
    empty = {f.name: [] for f in RAW_AIR.fields if f.name not in ("city_id", "city_name")}
    (row,) = clean_air(documents(spark, RAW_AIR, air(0, **empty))).collect()
    assert (row["city_id"], row["date"], row["hour"], row["pm25"], row["reject"]) == (1, None, None, 0.0, None)


def test_absent_arrays_count_as_empty(spark):
    absent = {f.name: None for f in RAW_AIR.fields if f.name not in ("city_id", "city_name")}
    assert clean_air(documents(spark, RAW_AIR, air(0, **absent))).count() == 1


def test_empty_next_to_single_element_is_even(spark):
    (row,) = clean_air(documents(spark, RAW_AIR, air(0, hours=1, ozone=[]))).collect()
    assert (row["o3"], row["reject"]) == (0.0, None)


def test_ragged_document_is_rejected_whole(spark):
    docs = documents(spark, RAW_AIR, air(0, ozone=[1.0] * 23), air(1, city_id=2))
    found = clean_air(docs)
    assert rows(found.filter("reject IS NOT NULL").select("city_id", "reject")) == [(1, RAGGED)]
    assert found.filter("reject IS NULL").count() == 24
    with pytest.raises(PySparkException, match=RAGGED):
        clean_air(docs, strict=True).collect()


def test_row_without_index_is_rejected(spark):
    off = {v: [x, 0.0] for v, x in zip(
        ("pm2_5", "pm10", "carbon_monoxide", "sulphur_dioxide", "nitrogen_dioxide", "ozone"),
        (35.5, 50.5, 5050.0, 50.5, 40.5, 100.5),
    )}
    docs = documents(spark, RAW_AIR, air(0, hours=2, **off))
    found = clean_air(docs).orderBy("hour").collect()
    assert [(r["aqi"], r["reject"]) for r in found] == [(None, NO_INDEX), (0, None)]
    with pytest.raises(PySparkException):
        clean_air(docs, strict=True).collect()


def test_co_is_converted_for_the_index_only(spark):
    (row,) = clean_air(documents(spark, RAW_AIR, air(0, hours=1, carbon_monoxide=[5000.0]))).collect()
    assert (row["co"], row["co_mg"], row["aqi"]) == (5000.0, 5.0, 50)


def test_weather_keeps_the_first_document_of_a_drop(spark):
    second_day = date(2024, 1, 2)
    docs = documents(
        spark,
        RAW_WEATHER,
        weather(5, hours=1, rain=[5.0]),
        weather(2, hours=1, rain=[2.0]),
        weather(9, hours=1, rain=[9.0], run_date=second_day),
    )
    found = clean_weather(docs)
    assert rows(found.select("run_date", "rain")) == [(DAY, 2.0), (second_day, 9.0)]
    assert found.schema["dew_point"].dataType.simpleString() == "array<double>"


def test_air_keeps_repeated_documents_unless_asked(spark):
    docs = documents(spark, RAW_AIR, air(0, hours=1, pm10=[1.0]), air(1, hours=1, pm10=[2.0]))
    assert rows(clean_air(docs).select("pm10")) == [(1.0,), (2.0,)]
    assert rows(clean_air(docs, dedup=True).select("pm10")) == [(1.0,)]


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS position")
    plan = final_plan(dedup_first(df, ["k"], ["position"]))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_wall_clock_ignores_the_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01T23:30",), ("no time",)], "time string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
    try:
        assert rows(with_date_and_hour(df).select("date", "hour")) == [(None, None), (DAY, 23)]
        with pytest.raises(PySparkException):
            with_date_and_hour(df, strict=True).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clean_city(spark):
    raw = spark.createDataFrame(
        [
            (1, "Hà Nội", "21.0", "105.8"),
            (1, "Hà Nội", "21.0", "105.8"),
            (2, "Huế", None, "107.6"),
            (3, "Vinh", "north", "105.7"),
            (4, None, "10", "106"),
        ],
        RAW_CITY,
    )
    assert rows(clean_city(raw)) == [(1, "Hà Nội", 21.0, 105.8, COUNTRY)]
    assert COUNTRY == "Việt Nam"
    with pytest.raises(PySparkException):
        clean_city(raw, strict=True).collect()


def test_impute_and_conform(spark):
    df = spark.createDataFrame([Row(a=None, b=1.5)], "a bigint, b double")
    assert rows(impute_zero(df, ["a"])) == [(0, 1.5)]
    source = {f.name: "1" for f in FACT_WEATHER.fields} | {"full_date": "2024-01-01", "wind_direction": 180}
    wide = spark.createDataFrame([source])
    result = conform(wide, FACT_WEATHER)
    assert result.schema.simpleString() == FACT_WEATHER.simpleString()
    assert result.first()["wind_direction"] == "180"


def test_explode_needs_no_shuffle(spark):
    docs = documents(spark, RAW_AIR, air(0))
    assert "Exchange" not in final_plan(explode_hourly(docs, ["pm10", "ozone"]))
