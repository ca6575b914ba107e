from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hazemill.operators import constraints, load
from hazemill.operators.constraints import ConstraintError
from hazemill.schemas import TABLES
from hazemill.sources import calendar
from hazemill import storage
from hazemill.session import scratch, scratch_path, shared_dir
from hazemill.warehouse import COUNTS, Warehouse
from tests.conftest import final_plan, rows

DAY, NEXT = date(2024, 1, 1), date(2024, 1, 2)
CITY = "city_id int, city_name string, country string, lon double, lat double"
AIR = (
    "city_id long, date date, hour int, aqi int, pm25 double, pm10 double, no2 double, so2 double, "
    "o3 double, co double, co2 double, reject string"
)


def cities(spark, *pairs):
    return spark.createDataFrame([(i, name, "Việt Nam", 1.0, 2.0) for i, name in pairs], CITY)


def reading(city_id=1, day=DAY, hour=0, aqi=10, reject=None, pm25=1.0):
    return (city_id, day, hour, aqi, pm25, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, reject)


def report(**counts):
    return dict.fromkeys(COUNTS, 0) | counts


@pytest.fixture
def warehouse(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.create()
    warehouse.add_to_dimension("dim_date", calendar.generate_dates(spark, 2024))
    warehouse.add_to_dimension("dim_time", calendar.generate_hours(spark))
    warehouse.add_to_dimension("dim_city", cities(spark, (1, "Huế"), (2, "Vinh")))
    return warehouse


def scan(spark, tmp_path, name, *readings, files=1):
    path = str(tmp_path / name)
    spark.createDataFrame(list(readings), AIR).repartition(files).write.parquet(path)
    return spark.read.parquet(path)


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([(1, "old")], "k int, v string")
    incoming = spark.createDataFrame([(1, "new", 0), (2, "second", 2), (2, "first", 1)], "k int, v string, nth int")
    assert rows(load.insert_if_absent(existing, incoming, ["k"], ["nth"]).select("k", "v")) == [(2, "first")]
    assert load.insert_if_absent(existing, incoming, ["k"]).count() == 1


def test_dim_ids_follow_the_largest(spark):
    existing = spark.createDataFrame([(7, 100)], "id int, k int")
    new = spark.createDataFrame([(300,), (200,)], "k int")
    assert rows(load.with_dim_ids(new, existing, "id", "k")) == [(200, 8), (300, 9)]
    assert rows(load.with_dim_ids(new, existing.limit(0), "id", "k")) == [(200, 1), (300, 2)]


def test_fact_ids_are_dense_and_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(7).write.parquet(path)
    numbered = load.with_fact_ids(spark.read.parquet(path), "aq_id", 11)
    ids = sorted(r["aq_id"] for r in numbered.collect())
    assert ids == list(range(11, 1011))
    # Other task boundaries, same ids.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        again = load.with_fact_ids(spark.read.parquet(path), "aq_id", 11)
        assert again.rdd.getNumPartitions() > 7
        assert rows(again) == rows(numbered)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    some = load.with_fact_ids(spark.read.parquet(path).filter("id % 3 = 0"), "aq_id", 11).collect()
    assert len({r["aq_id"] for r in some}) == len(some) == 334
    assert max(r["aq_id"] for r in some) <= 10 + load.file_spans(spark.read.parquet(path).filter("id % 3 = 0")).agg(F.sum("_rows")).first()[0]


def test_create_gives_every_table(warehouse):
    warehouse.create()
    for table, schema in TABLES.items():
        found = warehouse.read(table)
        assert found.count() == 0
        assert found.schema.simpleString() == schema.simpleString()


def test_dimension_rerun_changes_nothing(spark, warehouse):
    warehouse.add_to_dimension("dim_date", calendar.generate_dates(spark, 2024))
    warehouse.add_to_dimension("dim_city", cities(spark, (1, "renamed"), (3, "Huế 2")))
    dates = warehouse.read("dim_date")
    assert dates.count() == dates.select("date_id").distinct().count() == 366
    assert rows(warehouse.read("dim_city").select("city_id", "city_name")) == [(1, "Huế"), (2, "Vinh"), (3, "Huế 2")]


def test_dimension_constraints(spark, warehouse):
    with pytest.raises(ConstraintError, match="city_name"):
        warehouse.add_to_dimension("dim_city", cities(spark, (3, "Huế")))
    with pytest.raises(ConstraintError, match="null"):
        warehouse.add_to_dimension("dim_city", cities(spark, (3, None)))
    assert warehouse.read("dim_city").count() == 2


def test_load_and_rerun(spark, warehouse, tmp_path):
    batch = scan(spark, tmp_path, "p", *(reading(hour=h) for h in range(24)), files=3)
    assert warehouse.load_fact("fact_air_quality", batch) == report(read=24, loaded=24)
    warehouse.load_fact("fact_air_quality", batch)
    facts = warehouse.read("fact_air_quality")
    assert facts.count() == 24
    warehouse.load_fact("fact_air_quality", batch, mode="append")
    facts = warehouse.read("fact_air_quality")
    assert facts.count() == facts.select("aq_id").distinct().count() == 48


def test_filtered_loads_never_share_ids(spark, warehouse, tmp_path):
    days = [DAY, NEXT, date(2024, 3, 5)]
    path = str(tmp_path / "all")
    readings = [reading(day=d, hour=h) for d in days for h in range(24)]
    spark.createDataFrame(readings, AIR).coalesce(1).write.parquet(path)
    table = spark.read.schema(AIR).parquet(path)
    warehouse.load_fact("fact_air_quality", table)
    warehouse.load_fact("fact_air_quality", table.filter(F.col("date") == days[2]))
    warehouse.load_fact("fact_air_quality", table.filter(F.col("date") == days[1]), mode="append")
    facts = warehouse.read("fact_air_quality")
    assert facts.count() == facts.select("aq_id").distinct().count() == 96
    assert facts.agg(F.max("aq_id")).first()[0] <= warehouse.last_id("fact_air_quality")


def test_replace_keeps_other_cities_of_a_date(spark, warehouse, tmp_path):
    for _ in range(2):
        warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, f"a{_}", *(reading(city_id=1, hour=h) for h in range(24))))
        warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, f"b{_}", *(reading(city_id=2, hour=h) for h in range(24))))
    facts = warehouse.read("fact_air_quality")
    assert rows(facts.groupBy("city_id").count()) == [(1, 24), (2, 24)]
    assert facts.select("aq_id").distinct().count() == 48


def test_replace_leaves_other_dates_alone(spark, warehouse, tmp_path):
    warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, "a", reading(day=DAY), reading(day=NEXT)))
    warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, "b", reading(day=NEXT, aqi=99)))
    facts = warehouse.read("fact_air_quality")
    assert rows(facts.select("full_date", "aqi")) == [(DAY, 10.0), (NEXT, 99.0)]


def test_rows_that_are_not_loaded_are_counted(spark, warehouse, tmp_path):
    batch = scan(
        spark,
        tmp_path,
        "p",
        reading(),
        reading(city_id=99, reject="bad"),
        reading(city_id=99, day=None),
        reading(day=date(2030, 1, 1)),
    )
    assert warehouse.load_fact("fact_air_quality", batch) == report(read=4, rejected=1, unmatched=2, loaded=1)
    assert warehouse.read("fact_air_quality").count() == 1


def test_violations_stop_a_load_before_it_writes(spark, warehouse, tmp_path):
    with pytest.raises(ConstraintError, match="unknown_city"):
        warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, "a", reading(), reading(city_id=99)))
    with pytest.raises(ConstraintError, match="null_pm25"):
        warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, "b", reading(pm25=None)))
    with pytest.raises(ValueError, match="mode"):
        warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, "c", reading()), mode="merge")
    assert warehouse.read("fact_air_quality").count() == 0


VERSIONED = AIR + ", run_date date, file_time timestamp, file string"


def version(day, hour, path):
    return (day, datetime(2024, 6, 1, hour), path)


def versioned(spark, tmp_path, name, *readings):
    path = str(tmp_path / name)
    spark.createDataFrame(list(readings), VERSIONED).write.parquet(path)
    return spark.read.parquet(path)


# Ever newer: by drop, then by time of the file, then by its path.
VERSIONS = [version(DAY, 5, "z"), version(NEXT, 1, "a"), version(NEXT, 2, "a"), version(NEXT, 2, "b")]


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1), None])
def test_the_newest_version_counts_in_any_order(spark, warehouse, tmp_path, order):
    loads = [[reading(hour=h, aqi=100 + i) + v for h in range(24)] for i, v in enumerate(VERSIONS)]
    loads[1] += [reading(city_id=2, hour=h, aqi=7) + VERSIONS[1] for h in range(24)]
    if order is None:
        found = warehouse.load_fact("fact_air_quality", versioned(spark, tmp_path, "all", *sum(loads, [])))
        assert found == report(read=120, superseded=72, loaded=48)
    for i in order or ():
        warehouse.load_fact("fact_air_quality", versioned(spark, tmp_path, f"p{i}", *loads[i]))
    facts = warehouse.read("fact_air_quality")
    assert rows(facts.groupBy("city_id", "aqi").count()) == [(1, 103.0, 24), (2, 7.0, 24)]
    assert facts.select("aq_id").distinct().count() == 48
    assert facts.schema.simpleString() == TABLES["fact_air_quality"].simpleString()


def test_a_rejected_version_replaces_nothing(spark, warehouse, tmp_path):
    warehouse.load_fact("fact_air_quality", versioned(spark, tmp_path, "a", reading(aqi=5) + VERSIONS[0]))
    newer = versioned(spark, tmp_path, "b", reading(aqi=6, reject="spoilt") + VERSIONS[1])
    assert warehouse.load_fact("fact_air_quality", newer) == report(read=1, rejected=1)
    older = versioned(spark, tmp_path, "c", *(reading(aqi=a) + v for a, v in ((8, VERSIONS[0]), (9, VERSIONS[2]))))
    assert warehouse.load_fact("fact_air_quality", older) == report(read=2, superseded=1, loaded=1)
    assert rows(warehouse.read("fact_air_quality").select("aqi")) == [(9.0,)]


def test_versions_without_rows_of_their_own_are_lowest(spark, warehouse, tmp_path):
    warehouse.load_fact("fact_air_quality", versioned(spark, tmp_path, "a", reading(aqi=5) + VERSIONS[0]))
    assert warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, "b", reading(aqi=6))) == report(read=1, superseded=1)
    assert warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, "c", reading(aqi=6)), mode="append") == report(read=1, loaded=1)
    assert rows(warehouse.read("fact_air_quality").select("aqi")) == [(5.0,), (6.0,)]


def test_repeated_cells_are_counted(spark, warehouse, tmp_path):
    hours = [0, 0, 0, 23, 23, 5]
    batch = scan(spark, tmp_path, "p", *(reading(hour=h) for h in hours), reading(day=NEXT), reading(city_id=2), reading(hour=5, reject="x"), files=3)
    assert warehouse.load_fact("fact_air_quality", batch) == report(read=9, rejected=1, repeated=3, loaded=8)


def test_the_id_log_stays_one_entry_per_table(spark, warehouse, tmp_path):
    folder = f"{warehouse.path('id_log')}/fact_air_quality"
    first = [warehouse._reserve_ids("fact_air_quality", 10) for _ in range(1000)]
    assert first == list(range(1, 10_001, 10)) and warehouse.last_id("fact_air_quality") == 10_000
    assert len(storage.names(spark, folder)) == 1
    assert warehouse.last_id("fact_weather") == 0
    # A load that died between its entry and the removal of the older one.
    storage.mark(spark, f"{folder}/{10_005:020d}")
    assert warehouse._reserve_ids("fact_air_quality", 1) == 10_006
    assert len(storage.names(spark, folder)) == 1


def test_a_load_leaves_nothing_in_the_shared_folder(spark, warehouse, tmp_path):
    before = set(storage.names(spark, shared_dir(spark)))
    warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, "a", reading()))
    warehouse.add_to_dimension("dim_city", cities(spark, (3, "Hội An")))
    with pytest.raises(ConstraintError):
        warehouse.load_fact("fact_air_quality", scan(spark, tmp_path, "b", reading(city_id=99)))
    assert set(storage.names(spark, shared_dir(spark))) == before


def test_scratch_scopes_nest(spark):
    def exists(path):
        return path.rpartition("/")[2] in storage.names(spark, shared_dir(spark))

    paths = []
    with scratch(spark):
        paths.append(scratch_path(spark, "outer"))
        spark.range(3).write.parquet(paths[0])
        with scratch(spark):
            paths.append(scratch_path(spark, "inner"))
            spark.range(3).write.parquet(paths[1])
        assert [exists(p) for p in paths] == [True, False]
    kept_path = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept_path)
    assert [exists(p) for p in (*paths, kept_path)] == [False, False, True]


def test_reset_does_not_reuse_ids(spark, warehouse, tmp_path):
    batch = scan(spark, tmp_path, "p", reading(), reading(hour=1))
    warehouse.load_fact("fact_air_quality", batch)
    warehouse.reset("fact_air_quality")
    assert warehouse.read("fact_air_quality").count() == 0
    warehouse.load_fact("fact_air_quality", batch)
    assert rows(warehouse.read("fact_air_quality").select("aq_id")) == [(3,), (4,)]


def test_lookups_do_not_shuffle_the_rows(spark, warehouse, tmp_path):
    batch = scan(spark, tmp_path, "p", reading()).selectExpr("*", "1L AS aq_id")
    located = load.fact_rows("fact_air_quality", batch, warehouse.read("dim_date"), warehouse.read("dim_time"))
    plan = final_plan(located)
    assert plan.count("BroadcastHashJoin") == 2
    assert "hashpartitioning" not in plan


def test_check_queries(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, 3)], "k int, v int")
    assert rows(constraints.null_violations(df, ["k", "v"], "t")) == [("t", "k", 1), ("t", "v", 1)]
    assert rows(constraints.unique_violations(df, ["k"])) == [(1, 2)]
    assert rows(constraints.fk_violations(df.dropna(subset=["k"]), df.filter("k > 5"), "k")) == [(1, 2)]
    constraints.require_empty(df.limit(0), "nothing")
    with pytest.raises(ConstraintError, match="k"):
        constraints.require_empty(df, "rows")


def test_rows_in_equal_rows_out_plus_misses(spark, warehouse):
    days = [DAY, NEXT, date(2031, 5, 5), None]
    readings = [reading(day=days[i % 4], hour=i % 26) for i in range(60)]
    processed = spark.createDataFrame(readings, AIR)
    dates, hours = warehouse.read("dim_date"), warehouse.read("dim_time")
    misses = constraints.lookup_misses(processed, dates, hours)
    lost = sum(r["row_count"] for r in misses.collect())
    assert load.locate(processed, dates, hours).count() + lost == 60


def test_a_load_lists_the_folders_of_its_dates_alone(spark, warehouse, tmp_path, monkeypatch):
    """Also one that wins nothing; and rows without a city are neither loaded nor an error."""
    listed = []
    stored = Warehouse._stored
    monkeypatch.setattr(Warehouse, "_stored", lambda *args: listed.append(stored(*args)) or listed[-1])
    for day in (DAY, date(2024, 3, 9)):
        newer = versioned(spark, tmp_path, f"new{day}", (*reading(1, day, 5), *version(NEXT, 2, "b")))
        assert warehouse.load_fact("fact_air_quality", newer) == report(read=1, loaded=1)
    listed.clear()
    older = (*reading(1, DAY, 6), *version(DAY, 2, "a")), (*reading(None, DAY, 7), *version(DAY, 2, "a"))
    found = warehouse.load_fact("fact_air_quality", versioned(spark, tmp_path, "older", *older))
    assert found == report(read=2, superseded=2)
    assert [{path.split("/")[-2] for path in df.inputFiles()} for df in listed] == [{f"full_date={DAY:%Y-%m-%d}"}]
    held = [(DAY, 6), (date(2024, 3, 9), 6)]
    assert rows(warehouse.read("fact_air_quality").select("full_date", "time_id")) == held
    again = versioned(spark, tmp_path, "added", *older)
    assert warehouse.load_fact("fact_air_quality", again, mode="append") == report(read=2, superseded=1, loaded=1)
    assert rows(warehouse.read("fact_air_quality").select("full_date", "time_id")) == [held[0], (DAY, 7), held[1]]
