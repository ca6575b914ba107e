import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from hazemill.plans import air, weather
from hazemill.plans.correlation import weather_pollution_correlation
from hazemill.plans.star import Star
from hazemill.sources import calendar
from tests.conftest import final_plan, rows

WEATHER = (
    "weather_id long, city_id int, date_id int, time_id int, temperature double, humidity double, "
    "wind_speed double, rain double"
)
AIR = (
    "aq_id long, city_id int, date_id int, time_id int, aqi double, pm25 double, pm10 double, "
    "no2 double, so2 double, o3 double, co double, co2 double"
)


def star(spark, fact, schema):
    dates = calendar.generate_dates(spark, 2024).withColumn("date_id", F.dayofyear("full_date"))
    hours = calendar.generate_hours(spark).withColumn("time_id", F.col("hour") + 1)
    cities = spark.createDataFrame([(i, f"city {i}") for i in range(1, 5)], "city_id int, city_name string")
    return Star(spark.createDataFrame(fact, schema), cities, dates, hours)


def air_star(spark, *cells):
    """Cells are (city_id, day of year, hour, aqi)."""
    fact = [(i, c, d, h + 1, float(a), a / 2, a * 2.0, 0.0, 0.0, 0.0, 0.0, 0.0) for i, (c, d, h, a) in enumerate(cells)]
    return star(spark, fact, AIR)


def weather_star(spark, *cells):
    fact = [(i, c, d, h + 1, float(t), 50.0, 2.0, 0.0) for i, (c, d, h, t) in enumerate(cells)]
    return star(spark, fact, WEATHER)


def test_view_has_all_attributes(spark):
    view = air_star(spark, (1, 1, 5, 20)).view(week=True)
    (row,) = view.collect()
    assert view.columns[-10:] == [
        "city_name", "hour", "full_date", "day", "month", "year", "quarter", "is_weekend", "day_of_week", "week",
    ]
    assert (row["city_name"], row["hour"], row["full_date"], row["week"]) == ("city 1", 5, date(2024, 1, 1), 1)


def test_average_weather(spark):
    s = weather_star(spark, (1, 1, 0, 10), (1, 1, 1, 20), (1, 32, 0, 40), (2, 1, 0, 30))
    by_day = weather.avg_weather_by_time(s, "day")
    assert [(r["city_id"], r["full_date"], r["avg_temp"]) for r in by_day.collect()] == [
        (1, date(2024, 1, 1), 15.0),
        (1, date(2024, 2, 1), 40.0),
        (2, date(2024, 1, 1), 30.0),
    ]
    by_month = weather.avg_weather_by_time(s, "month", city_id=1)
    assert rows(by_month.select("year", "month", "avg_temp")) == [(2024, 1, 15.0), (2024, 2, 40.0)]
    assert rows(weather.national_weather_summary(s).select("month", "avg_temp")) == [(1, 20.0), (2, 40.0)]


def test_hours_are_listed_not_averaged(spark):
    s = weather_star(spark, (2, 1, 3, 1), (1, 1, 3, 2), (1, 1, 0, 3), (1, 2, 0, 4))
    listed = weather.avg_weather_by_time(s, "hour", city_id=2)
    assert listed.columns == ["city_id", "city_name", "hour", "rain", "wind_speed", "humidity", "temperature"]
    assert [(r["city_id"], r["hour"]) for r in listed.collect()] == [(1, 0), (1, 0), (1, 3), (2, 3)]


@pytest.mark.parametrize("report", [air.extreme_avg_aqi_by_time, air.compare_pollution_metrics_by_city])
def test_unknown_period(spark, report):
    with pytest.raises(ValueError):
        report(air_star(spark, (1, 1, 0, 1)), "week")
    with pytest.raises(ValueError):
        weather.avg_weather_by_time(weather_star(spark, (1, 1, 0, 1)), "year")


def test_equal_averages_share_a_dense_rank(spark):
    s = air_star(spark, (1, 1, 0, 50), (2, 1, 0, 40), (2, 1, 1, 60), (3, 1, 0, 10), (4, 40, 0, 5))
    ranked = air.extreme_avg_aqi_by_time(s, "month")
    assert [(r["month"], r["city_id"], r["rank"]) for r in ranked.collect()] == [(1, 1, 1), (1, 2, 1), (1, 3, 2), (2, 4, 1)]
    yearly = air.compare_pollution_metrics_by_city(s, "year")
    found = [(r["city_id"], r["rank_aqi"], r["rank_pm25"], r["rank_pm10"]) for r in yearly.collect()]
    assert found == [(1, 1, 1, 1), (2, 1, 1, 1), (3, 2, 2, 2), (4, 3, 3, 3)]


def test_ranks_start_at_one_without_gaps(spark):
    cells = [(c, d, 0, (c * d) % 7) for c in (1, 2, 3, 4) for d in (1, 40, 70)]
    ranked = air.extreme_avg_aqi_by_time(air_star(spark, *cells), "month").collect()
    for month in (1, 2, 3):
        found = sorted({r["rank"] for r in ranked if r["month"] == month})
        assert found == list(range(1, len(found) + 1))


def test_high_aqi_is_strict_and_pushed_down(spark, tmp_path):
    s = air_star(spark, (1, 1, 0, 150), (1, 1, 1, 151))
    assert rows(air.high_aqi_days(s).select("hour", "aqi")) == [(1, 151.0)]
    path = str(tmp_path / "fact")
    s.fact.write.parquet(path)
    plan = final_plan(air.high_aqi_days(Star(spark.read.parquet(path), s.city, s.date, s.time)))
    assert "GreaterThan(aqi,150.0)" in plan
    assert "co2" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "Cartesian" not in plan and "hashpartitioning" not in plan


def test_peak_hours(spark):
    s = air_star(spark, (1, 1, 7, 90), (1, 2, 3, 90), (1, 1, 9, 95), (2, 1, 4, 1), (2, 1, 4, 3))
    first = air.peak_pollution_hours(s, limit=2)
    assert [(r["city_id"], r["hour"], r["aqi"], r["rank_aqi"]) for r in first.collect()] == [
        (1, 9, 95.0, 1),
        (1, 3, 90.0, 2),
        (2, 4, 2.0, 1),
    ]
    assert rows(air.peak_pollution_hours(s, city_id=2).select("city_id", "hour")) == [(2, 4)]
    plan = final_plan(first)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_date_filter_prunes_fact_partitions(spark, tmp_path):
    s = air_star(spark, *((1, d, 0, 10) for d in range(1, 60)))
    dated = s.fact.withColumn("full_date", F.date_add(F.lit(date(2023, 12, 31)), F.col("date_id")))
    paths = [str(tmp_path / n) for n in ("fact", "date")]
    dated.write.partitionBy("full_date").parquet(paths[0])
    s.date.write.parquet(paths[1])
    stored = Star(spark.read.parquet(paths[0]), s.city, spark.read.parquet(paths[1]), s.time)
    february = stored.view().filter("month = 2")
    assert february.count() == 28
    assert "dynamicpruning" in final_plan(february)


def facts(spark, cells):
    """Cells are (city, date, time, weather values, air values)."""
    w, a = [], []
    for c, d, t, temperature, aqi in cells:
        w += [(c, d, t, float(x), float(x) * 2, -float(x), float(x % 3)) for x in temperature]
        a += [(c, d, t, float(x), float(x) + c, float(x * x)) for x in aqi]
    keys = "city_id int, date_id int, time_id int, "
    return (
        spark.createDataFrame(w, keys + "temperature double, humidity double, wind_speed double, rain double"),
        spark.createDataFrame(a, keys + "aqi double, pm25 double, pm10 double"),
    )


def brute_force(weather_rows, air_rows, p, w):
    pairs = [(a[p], b[w]) for a in air_rows for b in weather_rows if all(a[k] == b[k] for k in ("city_id", "date_id", "time_id"))]
    n = len(pairs)
    mx, my = (sum(x[i] for x in pairs) / n for i in (0, 1))
    sxy = sum((x - mx) * (y - my) for x, y in pairs)
    sxx, syy = sum((x - mx) ** 2 for x, _ in pairs), sum((y - my) ** 2 for _, y in pairs)
    return sxy / math.sqrt(sxx * syy)


def test_correlation_equals_brute_force_over_pairs(spark):
    w, a = facts(spark, [(1, 1, 1, [3, 9, 4], [50, 61]), (1, 1, 2, [5], [70, 12, 33]), (2, 1, 1, [8], [20]), (3, 1, 1, [1], [])])
    ws, as_ = w.collect(), a.collect()
    found = {r["metric"]: r for r in weather_pollution_correlation(w, a).collect()}
    for label, p in (("AQI", "aqi"), ("PM10", "pm10"), ("PM2.5", "pm25")):
        for m in ("rain", "wind_speed", "humidity", "temperature"):
            assert found[label][m] == pytest.approx(brute_force(ws, as_, p, m), abs=1e-12)
    legacy = {r["metric"]: r for r in weather_pollution_correlation(w, a, legacy_labels=True).collect()}
    assert legacy["PM2.5"]["rain"] == found["PM10"]["rain"]
    assert legacy["PM10"]["rain"] == found["PM2.5"]["rain"]


def test_correlation_of_small_spreads_around_large_values(spark):
    cells = [(1, 1, h, 1e6 + h / 1000, 5e5 + h / 500) for h in range(24)]
    w = spark.createDataFrame(cells, "city_id int, date_id int, time_id int, temperature double, rain double")
    w = w.selectExpr("*", "rain AS wind_speed", "-temperature AS humidity")
    a = spark.createDataFrame(cells, "city_id int, date_id int, time_id int, aqi double, pm10 double").selectExpr("*", "1e6D AS pm25")
    found = {r["metric"]: r for r in weather_pollution_correlation(w, a).collect()}
    assert found["AQI"]["temperature"] == pytest.approx(1.0, abs=1e-9)
    assert found["AQI"]["humidity"] == pytest.approx(-1.0, abs=1e-9)
    assert math.isnan(found["PM2.5"]["rain"])


def test_correlation_is_centred_on_the_joined_pairs(spark):
    """Small spreads around a million, beside rows at a thousand million that have no partner."""
    cells = "id AS city_id", "1 AS date_id", "1 AS time_id"
    x = "1e6D + (id * 37 % 200 - 100) / 1e4D"
    w = spark.range(200).selectExpr(*cells, f"{x} AS rain", f"-({x}) AS humidity", "id % 7 + 0D AS wind_speed", "3D AS temperature")
    far = spark.range(1000, 1200).selectExpr(*cells, "1e9D AS rain", "1e9D AS humidity", "1e9D AS wind_speed", "1e9D AS temperature")
    a = spark.range(200).selectExpr(*cells, f"{x} AS aqi", f"2 * ({x}) AS pm10", "id % 5 + 0D AS pm25")
    found = {r["metric"]: r for r in weather_pollution_correlation(w.union(far), a).collect()}
    pairs = w.join(a, ["city_id", "date_id", "time_id"])
    for label, p in (("AQI", "aqi"), ("PM10", "pm10"), ("PM2.5", "pm25")):
        for m in ("rain", "humidity", "wind_speed"):
            assert found[label][m] == pytest.approx(pairs.agg(F.corr(p, m)).first()[0], abs=1e-9)
        assert math.isnan(found[label]["temperature"])
    assert found["AQI"]["rain"] == pytest.approx(1.0, abs=1e-12)


def test_correlation_without_variance_is_nan(spark):
    w, a = facts(spark, [(1, 1, t, [7], [t, t + 1]) for t in range(1, 9)])
    assert all(math.isnan(r["temperature"]) for r in weather_pollution_correlation(w, a).collect())
    tenths = a.select("city_id", "date_id", "time_id", *(F.lit(0.1).alias(m) for m in ("aqi", "pm25", "pm10")))
    w2, _ = facts(spark, [(1, 1, t, [t], [t]) for t in range(1, 9)])
    assert all(math.isnan(r["temperature"]) for r in weather_pollution_correlation(w2, tenths).collect())
    none = weather_pollution_correlation(w, a.limit(0)).collect()
    assert len(none) == 3 and all(math.isnan(r["rain"]) for r in none)


def test_a_hot_cell_makes_no_pairs(spark):
    cell = ("1 AS city_id", "1 AS date_id", "1 AS time_id")
    n = 30_000
    measures = {"rain": 7, "wind_speed": 5, "humidity": 3, "temperature": 11}
    w = spark.range(n).selectExpr(*cell, *(f"id % {size} + 0D AS {m}" for m, size in measures.items()))
    a = spark.range(n).selectExpr(*cell, "id % 13 + 0D AS aqi", "id % 17 + 0D AS pm10", "id % 19 + 0D AS pm25")
    result = weather_pollution_correlation(w, a)
    # Inside one cell the two sides are independent.
    assert all(abs(r["rain"]) < 1e-9 for r in result.collect())
    assert "Join" not in final_plan(result)  # of the cells, which were joined one to one before
