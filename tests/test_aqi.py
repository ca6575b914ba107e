import pytest
from pyspark.errors import PySparkException

from hazemill.functions.aqi import CONCENTRATION_BANDS, INDEX_BANDS, aqi, co_milligrams, sub_index


def indices(spark, pollutant, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, c double")
    return [r["x"] for r in df.select("i", sub_index(pollutant, "c").alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("pollutant", CONCENTRATION_BANDS)
def test_band_edges_and_gaps(spark, pollutant):
    bands = CONCENTRATION_BANDS[pollutant]
    values, expected = [-0.1, bands[-1][1] + 0.1], [None, None]
    for (low, high), (i_low, i_high) in zip(bands, INDEX_BANDS):
        values += [low, high]
        expected += [i_low, i_high]
    for (_, high), (low, _) in zip(bands, bands[1:]):
        values.append((high + low) / 2)
        expected.append(None)
    assert indices(spark, pollutant, values) == expected


def test_named_values(spark):
    assert indices(spark, "pm25", [-1, 0, 35, 35.5, 36, 75, 500, 501]) == [None, 0, 50, None, 51, 100, 500, None]
    assert indices(spark, "co", [5, 5.05, 5.1]) == [50, None, 51]


def test_halves_round_to_even(spark):
    assert indices(spark, "so2", [0.5, 1.5, 2.5]) == [0, 2, 2]
    assert indices(spark, "pm10", [251]) == [151]
    assert indices(spark, "o3", [50.5]) == [25]
    assert indices(spark, "pm25", [0.35]) == [round(50 / 35 * 0.35)]


@pytest.mark.parametrize("pollutant", CONCENTRATION_BANDS)
def test_inside_bands_equals_python_rounding(spark, pollutant):
    values, expected = [], []
    for (low, high), (i_low, i_high) in zip(CONCENTRATION_BANDS[pollutant], INDEX_BANDS):
        for step in range(101):
            c = low + (high - low) * step / 100
            if c <= high:
                values.append(c)
                expected.append(round((i_high - i_low) / (high - low) * (c - low) + i_low))
    found = indices(spark, pollutant, values)
    assert found == expected
    assert found == sorted(found)
    assert 0 <= found[0] and found[-1] <= 500


def test_unknown_pollutant():
    with pytest.raises(ValueError):
        sub_index("radon", "c")


COLUMNS = "pm25 double, pm10 double, co double, so2 double, no2 double, o3 double"


def of_row(spark, *values, strict=False):
    df = spark.createDataFrame([values], COLUMNS).withColumn("co_mg", co_milligrams())
    return df.select(aqi(strict=strict).alias("aqi")).first()["aqi"]


def test_aqi_is_the_largest_sub_index(spark):
    assert of_row(spark, 35.0, 10.0, 0.0, 0.0, 41.0, 0.0) == 51
    assert of_row(spark, -1.0, -1.0, 5000.0, -1.0, -1.0, -1.0) == 50
    assert of_row(spark, None, None, None, 2.5, None, None) == 2


def test_no_sub_index_at_all(spark):
    nothing = (35.5, 50.5, 5050.0, 50.5, 40.5, 100.5)
    assert of_row(spark, *nothing) is None
    assert of_row(spark, *[None] * 6) is None
    with pytest.raises(PySparkException, match="every sub-index is empty"):
        of_row(spark, *nothing, strict=True)


def test_generated_method_is_small_enough_for_the_jit(spark, tmp_path):
    path = str(tmp_path / "air")
    spark.range(10).selectExpr(
        "id", *(f"CAST(id AS DOUBLE) AS {c}" for c in ("pm25", "pm10", "co_mg", "so2", "no2", "o3"))
    ).write.parquet(path)
    df = spark.read.parquet(path).select("id", aqi().alias("aqi"))
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert 0 < max(sizes) < 8000
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


# Both ends of every band, (concentration, index), written out by hand.
BAND_ENDS = {
    "pm25": ((0, 0), (35, 50), (36, 51), (75, 100), (76, 101), (115, 150), (116, 151), (150, 200), (151, 201), (250, 300), (251, 301), (350, 400), (351, 401), (500, 500)),
    "pm10": ((0, 0), (50, 50), (51, 51), (100, 100), (101, 101), (250, 150), (251, 151), (350, 200), (351, 201), (430, 300), (431, 301), (500, 400), (501, 401), (600, 500)),
    "co": ((0, 0), (5, 50), (5.1, 51), (10, 100), (10.1, 101), (35, 150), (35.1, 151), (60, 200), (60.1, 201), (90, 300), (90.1, 301), (120, 400), (120.1, 401), (150, 500)),
    "so2": ((0, 0), (50, 50), (51, 51), (100, 100), (101, 101), (350, 150), (351, 151), (500, 200), (501, 201), (750, 300), (751, 301), (1000, 400), (1001, 401), (1200, 500)),
    "no2": ((0, 0), (40, 50), (41, 51), (80, 100), (81, 101), (180, 150), (181, 151), (280, 200), (281, 201), (400, 300), (401, 301), (500, 400), (501, 401), (600, 500)),
    "o3": ((0, 0), (100, 50), (101, 51), (160, 100), (161, 101), (215, 150), (216, 151), (265, 200), (266, 201), (800, 300), (801, 301), (1000, 400), (1001, 401), (1200, 500)),
}


def test_every_band_by_hand(spark):
    for pollutant, ends in BAND_ENDS.items():
        df = spark.createDataFrame([(float(c), i) for c, i in ends], "c double, expected int")
        assert df.select(sub_index(pollutant, "c").alias("i"), "expected").filter("not i <=> expected").collect() == []
