"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from checks import fixtures as fx
from hazemill import storage
from hazemill.functions.aqi import CONCENTRATION_BANDS, aqi, co_milligrams, sub_index
from hazemill.functions.dates import iso_week
from hazemill.operators import clean, constraints, load
from hazemill.plans import air, weather
from hazemill.plans.correlation import weather_pollution_correlation
from hazemill.plans.jobs import Zones, daily_facts, incremental_facts, refresh_dimensions
from hazemill.plans.star import Star
from hazemill.schemas import HOURLY_AIR, HOURLY_WEATHER, RAW
from hazemill.session import at_once, scratch_path
from hazemill.sources import calendar, landing, manifest, processed
from hazemill.streaming.ingest import ingest_new_files, read_ingested
from hazemill.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Averages are compared at this many decimals: summation order changes the last bits, and at
# fewer decimals averages of 64 or 128 tenths lie halfway between two values.
DIGITS = 9

AIR_OUT = ("city_id", "full_date", "hour", "aqi", "pm25", "pm10", "no2", "so2", "o3", "co", "co2")
WEATHER_OUT = (
    "city_id",
    "full_date",
    "hour",
    "temperature",
    "humidity",
    "wind_speed",
    "precipitation",
    "weather_code",
    "cloud_cover",
    "rain",
    "wind_direction",
    "apparent_temperature",
)


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def rounded(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


# Scans, sources, sinks


@query("latest_snapshot")
def latest_snapshot(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return landing.latest_per_key(events, ["user_id"], ["ts", "event_id"])


@query("latest_drop")
def latest_drop(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select(
        "event_id", "value", F.col("ts").cast("date").alias("run_date")
    )
    return landing.latest_drop(events)


def _landed(spark: SparkSession, documents: DataFrame, domain: str) -> str:
    """Land documents, each block of event ids in a zone of its own, as JSON Lines."""
    path = scratch_path(spark, f"landing-{domain}")
    landing.write_drop(documents, path)
    return path


@query("scan_raw_json")
def scan_raw_json(spark, sf_dir):
    path = _landed(spark, fx.air_documents(spark, sf_dir), "aq")
    total = F.aggregate("pm2_5", F.lit(0.0), lambda total, value: total + value)
    return landing.read_landing(spark, path, "aq").select(
        "city_id",
        "city_name",
        "run_date",
        F.size("time").alias("n_hours"),
        F.array_min("time").alias("first_time"),
        F.round(total, DIGITS).alias("total_pm25"),
    )


@query("scan_unreadable")
def scan_unreadable(spark, sf_dir):
    """What becomes of documents with fractional codes, values that are no numbers or times, and ragged arrays."""
    documents = fx.weather_documents(spark, sf_dir)
    text = {f.name: F.col(f.name).cast("array<string>") for f in HOURLY_WEATHER.fields}
    kind = F.col("city_id") % 5
    first = lambda value, c: F.concat(F.array(F.lit(value)), F.slice(text[c], 2, F.size(c)))
    spoilt = documents.withColumns(
        text
        | {
            "wind_direction_10m": F.when(kind == 0, F.transform("wind_direction_10m", lambda v: F.concat(v.cast("string"), F.lit(".5")))).otherwise(text["wind_direction_10m"]),
            "temperature_2m": F.when(kind == 1, first("n/a", "temperature_2m")).otherwise(text["temperature_2m"]),
            "rain": F.when(kind == 2, F.concat(text["rain"], F.array(F.lit("0"), F.lit("0")))).otherwise(text["rain"]),
            "time": F.when(kind == 3, first("noon", "time")).otherwise(F.col("time")),
        }
    )
    schema = StructType([*RAW["weather"].fields, StructField("batch", LongType())])
    landed = landing.read_landing(spark, _landed(spark, spoilt, "weather"), "weather", schema)
    rows = clean.clean_weather(landed, drop=("run_date", "batch"))
    codes = StructType([StructField("city_id", LongType()), StructField("reject", StringType()), StructField("wind_direction", StringType())])
    return clean.conform(rows, codes).groupBy("city_id", "reject").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("wind_direction").alias("least_direction"),
        F.max("wind_direction").alias("greatest_direction"),
    )


@query("raw_json_roundtrip")
def raw_json_roundtrip(spark, sf_dir):
    cities = fx.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS city_id",
        "concat('Tỉnh ', c_name) AS name",
        "CAST(c_nationkey AS STRING) AS lat",
        "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS lon",
        "DATE'2024-01-01' AS run_date",
    )
    return landing.read_landing(spark, _landed(spark, cities, "city"), "city").select("city_id", "name", "lat", "lon", "run_date")


@query("sink_roundtrip")
def sink_roundtrip(spark, sf_dir):
    rows = _air_rows(spark, sf_dir).withColumn("run_date", F.trunc("full_date", "month"))
    path = scratch_path(spark, "processed")
    processed.write_processed(rows, path)
    processed.write_processed(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    path = _landed(spark, fx.air_documents(spark, sf_dir), "aq")
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "offsets")
    for _ in range(2):
        ingest_new_files(spark, "aq", path, target, checkpoint, layout="lines")
    return read_ingested(spark, target, "aq").select(
        "city_id", "city_name", "date", "hour", "pm25", "o3", "co", "co_mg", "aqi"
    )


def _cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS city_id", "c_name AS city_name", "c_nationkey * 0.5e0 AS lat", "c_nationkey * 1.5e0 AS lon"
    )


@query("fetch_manifest")
def fetch_manifest(spark, sf_dir):
    loaded = fx.table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS city_id", "CAST(o_orderdate AS DATE) AS full_date"
    )
    first, last = F.lit(date(1996, 1, 1)), F.lit(date(1996, 1, 31))
    return manifest.fetch_manifest(_cities(spark, sf_dir), first, last, loaded)


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with only two of the variables; users stand for the cities asked."""
    events = fx.table(spark, sf_dir, "events").selectExpr(
        "user_id AS city_id",
        f"event_id DIV {fx.BATCH} AS batch",
        "CAST(hour(ts) AS STRING) AS time",
        "value * 0.5e0 AS pm2_5",
    )
    hourly = F.struct(F.collect_list("time").alias("time"), F.collect_list("pm2_5").alias("pm2_5"))
    return events.groupBy("city_id", "batch").agg(hourly.alias("hourly"))


@query("attach_results")
def attach_results(spark, sf_dir):
    responses = manifest.hourly_variables(_responses(spark, sf_dir), HOURLY_AIR)
    attached = manifest.attach_results(_cities(spark, sf_dir), responses)
    return attached.select(
        "city_id",
        "city_name",
        "batch",
        F.size("time").alias("n_hours"),
        F.size("ozone").alias("n_ozone"),
        F.array_max("pm2_5").alias("worst_pm25"),
    )


@query("fetch_failures")
def fetch_failures(spark, sf_dir):
    return manifest.failed_fetches(_cities(spark, sf_dir), _responses(spark, sf_dir))


# Days of orders that the dated requests ask for.
ASKED = (date(1996, 1, 1), date(1996, 3, 31))


def _dated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Requests for every city on several days, and a response for each city and day with orders."""
    requests = manifest.fetch_manifest(_cities(spark, sf_dir), *(F.lit(d) for d in ASKED))
    orders = fx.table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS city_id", "CAST(o_orderdate AS DATE) AS start_date", "CAST(o_totalprice AS DOUBLE) AS pm2_5", "o_orderkey"
    )
    hourly = F.array_sort(F.collect_list(F.struct("o_orderkey", "pm2_5"))).getField("pm2_5")
    responses = orders.groupBy("city_id", "start_date").agg(F.struct(hourly.alias("pm2_5")).alias("hourly"))
    return requests, manifest.hourly_variables(responses, HOURLY_AIR)


@query("attach_results_dated")
def attach_results_dated(spark, sf_dir):
    """Each response goes to the request of its city and day; cities repeat over the days."""
    return manifest.attach_results(*_dated(spark, sf_dir)).select(
        "city_id", "start_date", "city_name", F.size("pm2_5").alias("n_hours"), F.array_max("pm2_5").alias("worst_pm25")
    )


@query("fetch_failures_dated")
def fetch_failures_dated(spark, sf_dir):
    return manifest.failed_fetches(*_dated(spark, sf_dir))


@query("first_geocode")
def first_geocode(spark, sf_dir):
    customers = fx.table(spark, sf_dir, "customer")
    provinces = customers.selectExpr("c_custkey AS code", "c_name AS name")
    geocodes = customers.selectExpr(
        "c_custkey AS code",
        """CASE WHEN c_acctbal >= 0 THEN array(
             named_struct('name', CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) END,
                          'lat', CAST(c_nationkey AS STRING), 'lon', CAST(c_custkey AS STRING)),
             named_struct('name', 'second', 'lat', '0', 'lon', '0'))
           WHEN c_acctbal >= -500 THEN array() END AS detail""",
    )
    return manifest.first_geocode(provinces, geocodes)


@query("gen_dim_date")
def gen_dim_date(spark, sf_dir):
    rows = fx.readings(spark, sf_dir)
    counts = rows.groupBy("full_date").agg(F.count(F.lit(1)).alias("n_readings"))
    days = calendar.days_of_years(counts.select(F.year("full_date").alias("year")).distinct())
    return days.join(counts, "full_date", "left").fillna(0, ["n_readings"])


@query("gen_dim_time")
def gen_dim_time(spark, sf_dir):
    counts = fx.readings(spark, sf_dir).groupBy("hour").agg(F.count(F.lit(1)).alias("n_readings"))
    return calendar.generate_hours(spark).join(counts, "hour", "left").fillna(0, ["n_readings"])


# Cleaning


@query("clean_city")
def clean_city(spark, sf_dir):
    raw = fx.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS city_id",
        "c_name AS name",
        "CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS STRING) END AS lat",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'unknown' ELSE '105.25' END AS lon",
    )
    return clean.clean_city(raw.union(raw))


@query("impute_zero")
def impute_zero(spark, sf_dir):
    rows = fx.readings(spark, sf_dir).selectExpr(
        "event_id",
        "CASE WHEN event_type <> 'error' THEN rain END AS rain",
        "CASE WHEN event_type <> 'click' THEN weather_code END AS weather_code",
    )
    return clean.impute_zero(rows, ["rain", "weather_code"])


@query("dedup_first")
def dedup_first(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return clean.dedup_first(events, ["user_id", "event_type"], ["ts", "event_id"])


@query("explode_hourly")
def explode_hourly(spark, sf_dir):
    documents = fx.weather_documents(spark, sf_dir)
    rows = clean.clean_weather(documents, drop=("run_date", "batch"), order="batch")
    return rows.select(
        "city_id",
        "city_name",
        "time",
        "date",
        F.col("hour").cast("int").alias("hour"),
        *WEATHER_OUT[3:],
        F.size("dew_point").alias("n_dew_point"),
    )


# AQI and scalar functions


def _air_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.readings(spark, sf_dir).withColumn("co_mg", co_milligrams()).withColumn("aqi", aqi())
    return rows.select("event_id", *AIR_OUT, "co_mg")


@query("aqi_hourly")
def aqi_hourly(spark, sf_dir):
    return _air_rows(spark, sf_dir)


# Factors that stretch the readings over all bands of every table.
STRETCH = {"pm25": 9.0, "pm10": 9.0, "co": 9.0, "so2": 12.6, "no2": 9.0, "o3": 9.0}


def _sub_index_query(pollutant: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        value = co_milligrams() if pollutant == "co" else F.col(pollutant)
        stretched = (value * F.lit(STRETCH[pollutant])).alias("concentration")
        rows = fx.readings(spark, sf_dir).select("event_id", stretched)
        return rows.withColumn("sub_index", sub_index(pollutant, "concentration"))

    return run


for _pollutant in CONCENTRATION_BANDS:
    QUERIES[f"aqi_subindex_{_pollutant}"] = _sub_index_query(_pollutant)


@query("iso_week")
def iso_week_of_readings(spark, sf_dir):
    return fx.readings(spark, sf_dir).select("event_id", "full_date", iso_week("full_date").alias("week"))


@query("conform_schema")
def conform_schema(spark, sf_dir):
    return fx.fact_weather(spark, sf_dir)


# Warehouse


def _processed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.readings(spark, sf_dir).withColumnRenamed("full_date", "date")
    rows = clean.with_aqi(rows.withColumn("reject", F.lit(None).cast("string")))
    path = scratch_path(spark, "processed")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.create()
    for year in fx.YEARS:
        warehouse.add_to_dimension("dim_date", calendar.generate_dates(spark, year))
    warehouse.add_to_dimension("dim_time", calendar.generate_hours(spark))
    warehouse.add_to_dimension("dim_city", fx.dim_city(spark, sf_dir))
    return warehouse


def _counts(warehouse: Warehouse, tables: Iterable[str], name: str) -> DataFrame:
    counts = None
    for table in tables:
        one = warehouse.read(table).agg(F.count(F.lit(1)).alias(name)).select(F.lit(table).alias("table_name"), name)
        counts = one if counts is None else counts.unionByName(one)
    # The next step empties the tables, so the counts are taken now.
    return counts.checkpoint()


@query("init_dw")
def init_dw(spark, sf_dir):
    tables = ["dim_city", "dim_date", "dim_time", "fact_weather", "fact_air_quality"]
    warehouse = _warehouse(spark, sf_dir)
    warehouse.load_fact("fact_air_quality", _processed_scan(spark, sf_dir))
    before = _counts(warehouse, tables, "rows_before")
    warehouse.create()
    return before.join(_counts(warehouse, tables, "rows_after"), "table_name")


@query("reset_fact")
def reset_fact(spark, sf_dir):
    tables = ["dim_city", "fact_air_quality"]
    warehouse = _warehouse(spark, sf_dir)
    warehouse.load_fact("fact_air_quality", _processed_scan(spark, sf_dir))
    before = _counts(warehouse, tables, "rows_before")
    warehouse.reset("fact_air_quality")
    return before.join(_counts(warehouse, tables, "rows_after"), "table_name")


@query("upsert_city")
def upsert_city(spark, sf_dir):
    existing = fx.table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS city_id", "s_name AS city_name")
    incoming = fx.table(spark, sf_dir, "customer").selectExpr("c_custkey AS city_id", "c_name AS city_name")
    copies = incoming.withColumn("nth", F.lit(1)).union(
        incoming.selectExpr("city_id", "upper(city_name) AS city_name", "2 AS nth")
    )
    return existing.union(load.insert_if_absent(existing, copies, ["city_id"], ["nth"]).drop("nth"))


@query("upsert_date")
def upsert_date(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("full_date"))
    existing = calendar.with_date_parts(orders.distinct())
    days = fx.readings(spark, sf_dir).select("full_date").distinct()
    incoming = calendar.days_of_years(days.select(F.year("full_date").alias("year")).distinct())
    return existing.union(load.insert_if_absent(existing, incoming, ["full_date"]))


@query("upsert_time")
def upsert_time(spark, sf_dir):
    seen = fx.readings(spark, sf_dir).filter("pm25 > 150").select("hour").distinct()
    existing = seen.select("hour", F.lit("seen").alias("time_bucket"))
    incoming = calendar.generate_hours(spark).select("hour", "time_bucket")
    return existing.union(load.insert_if_absent(existing, incoming, ["hour"]))


@query("surrogate_dim")
def surrogate_dim(spark, sf_dir):
    known = fx.readings(spark, sf_dir).filter("event_type = 'error'").select("full_date").distinct()
    existing = known.withColumn("date_id", F.datediff("full_date", F.lit(fx.FIRST_DAY).cast("date")) + 1)
    incoming = fx.dim_date(spark).select("full_date")
    new = load.insert_if_absent(existing, incoming, ["full_date"])
    return existing.unionByName(load.with_dim_ids(new, existing, "date_id", "full_date"))


@query("surrogate_fact")
def surrogate_fact(spark, sf_dir):
    numbered = load.with_fact_ids(_processed_scan(spark, sf_dir), "aq_id", 1)
    return numbered.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("aq_id").alias("n_ids"),
        F.min("aq_id").alias("first_id"),
        F.max("aq_id").alias("last_id"),
    )


@query("load_overlapping")
def load_overlapping(spark, sf_dir):
    """Three loads of one processed table, each of some dates and cities; ids stay unique."""
    warehouse = _warehouse(spark, sf_dir)
    processed = _processed_scan(spark, sf_dir)
    for part in ("city_id % 2 = 0", "city_id % 2 = 1", "city_id % 3 = 0"):
        warehouse.load_fact("fact_air_quality", processed.filter(part))
    last = warehouse.last_id("fact_air_quality")
    return warehouse.read("fact_air_quality").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("aq_id").alias("n_ids"),
        F.count_if(F.col("aq_id") > last).alias("n_above_log"),
    )


@query("load_report")
def load_report(spark, sf_dir):
    """What a load reports, cells that it stores more than once included."""
    warehouse = _warehouse(spark, sf_dir)
    processed = _processed_scan(spark, sf_dir)
    spoilt = processed.selectExpr("* EXCEPT (reject)", "IF(event_type = 'error' AND hour < 12, 'spoilt', reject) AS reject")
    path = scratch_path(spark, "spoilt")
    spoilt.write.parquet(path)
    report = warehouse.load_fact("fact_air_quality", spark.read.parquet(path))
    return spark.createDataFrame(list(report.items()), "outcome string, n bigint")


def _first_year(spark: SparkSession) -> DataFrame:
    return fx.dim_date(spark).filter(F.col("year") == fx.YEARS[0])


@query("load_fact_aq")
def load_fact_aq(spark, sf_dir):
    rows = _air_rows(spark, sf_dir).withColumnRenamed("full_date", "date")
    return load.fact_rows("fact_air_quality", rows, _first_year(spark), fx.dim_time(spark), "event_id")


@query("load_fact_weather")
def load_fact_weather(spark, sf_dir):
    rows = fx.readings(spark, sf_dir).withColumnRenamed("full_date", "date")
    return load.fact_rows("fact_weather", rows, _first_year(spark), fx.dim_time(spark), "event_id")


@query("load_idempotent")
def load_idempotent(spark, sf_dir):
    warehouse = _warehouse(spark, sf_dir)
    rows = _processed_scan(spark, sf_dir)
    for _ in range(2):
        warehouse.load_fact("fact_air_quality", rows)
    facts = warehouse.read("fact_air_quality").drop("full_date")
    return facts.join(warehouse.read("dim_date").select("date_id", "full_date"), "date_id").join(
        warehouse.read("dim_time").select("time_id", "hour"), "time_id"
    ).select(*AIR_OUT)


@query("fk_violations")
def fk_violations(spark, sf_dir):
    nation, region = fx.table(spark, sf_dir, "nation"), fx.table(spark, sf_dir, "region")
    known = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).filter("r_name <> 'ASIA'")
    cities = known.select(F.col("n_nationkey").alias("city_id"))
    return constraints.fk_violations(fx.fact_air(spark, sf_dir), cities, "city_id")


@query("null_violations")
def null_violations(spark, sf_dir):
    rows = fx.readings(spark, sf_dir).selectExpr(
        "city_id",
        "CASE WHEN event_type <> 'error' THEN rain END AS rain",
        "CASE WHEN pm25 <= 150 THEN humidity END AS humidity",
        "wind_speed",
    )
    return constraints.null_violations(rows, rows.columns, "fact_weather")


@query("unique_violations")
def unique_violations(spark, sf_dir):
    existing = fx.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("city_id"))
    new = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("city_id"))
    return constraints.unique_violations(existing.union(new), ["city_id"])


@query("lookup_misses")
def lookup_misses(spark, sf_dir):
    rows = fx.readings(spark, sf_dir).selectExpr(
        "CASE WHEN event_type <> 'error' OR rain = 0 THEN full_date END AS date", "hour"
    )
    hours = fx.dim_time(spark).filter("hour < 22")
    return constraints.lookup_misses(rows, _first_year(spark), hours)


# Reports

STARS = {"air": fx.star_air, "weather": fx.star_weather}
REPORTS: dict[str, tuple[str, Callable[[Star], DataFrame]]] = {}


def report(name: str, fact: str) -> Callable:
    """Register a function of a star schema, and its query over the star of the given tables."""

    def register(function: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
        REPORTS[name] = (fact, function)
        QUERIES[name] = lambda spark, sf_dir: function(STARS[fact](spark, sf_dir))
        return function

    return register


@report("star_weather", "weather")
def star_weather(star):
    return star.view()


@report("star_air", "air")
def star_air(star):
    return star.view(week=True)


@report("avg_weather_hour", "weather")
def avg_weather_hour(star):
    return weather.avg_weather_by_time(star, "hour")


@report("avg_weather_day", "weather")
def avg_weather_day(star):
    return rounded(weather.avg_weather_by_time(star, "day"), weather.AVERAGES)


@report("avg_weather_day_city", "weather")
def avg_weather_day_city(star):
    return rounded(weather.avg_weather_by_time(star, "day", city_id=7), weather.AVERAGES)


@report("avg_weather_month", "weather")
def avg_weather_month(star):
    return rounded(weather.avg_weather_by_time(star, "month"), weather.AVERAGES)


@report("national_month", "weather")
def national_month(star):
    return rounded(weather.national_weather_summary(star), ["avg_temp", "avg_hum", "avg_wind"])


@report("extreme_aqi_month", "air")
def extreme_aqi_month(star):
    return rounded(air.extreme_avg_aqi_by_time(star, "month"), ["avg_aqi"])


@report("extreme_aqi_year", "air")
def extreme_aqi_year(star):
    return rounded(air.extreme_avg_aqi_by_time(star, "year"), ["avg_aqi"])


@report("high_aqi", "air")
def high_aqi(star):
    return air.high_aqi_days(star)


@report("compare_month", "air")
def compare_month(star):
    return rounded(air.compare_pollution_metrics_by_city(star, "month"), ["avg_aqi", "avg_pm25", "avg_pm10"])


@report("compare_year", "air")
def compare_year(star):
    return rounded(air.compare_pollution_metrics_by_city(star, "year"), ["avg_aqi", "avg_pm25", "avg_pm10"])


@report("peak_hours", "air")
def peak_hours(star):
    return rounded(air.peak_pollution_hours(star, limit=2), ["aqi"])


@report("peak_hours_city", "air")
def peak_hours_city(star):
    return rounded(air.peak_pollution_hours(star, limit=3, city_id=7), ["aqi"])


def correlation(fact_weather: DataFrame, fact_air: DataFrame, legacy_labels: bool = False) -> DataFrame:
    found = weather_pollution_correlation(fact_weather, fact_air, legacy_labels)
    return rounded(found, ["rain", "wind_speed", "humidity", "temperature"])


@query("weather_aqi_corr")
def weather_aqi_corr(spark, sf_dir):
    return correlation(fx.fact_weather(spark, sf_dir), fx.fact_air(spark, sf_dir))


@query("weather_aqi_corr_legacy")
def weather_aqi_corr_legacy(spark, sf_dir):
    return correlation(fx.fact_weather(spark, sf_dir), fx.fact_air(spark, sf_dir), legacy_labels=True)


# Jobs


def _zones(spark: SparkSession, sf_dir: str) -> Zones:
    root = scratch_path(spark, "zones")
    cities = fx.dim_city(spark, sf_dir).selectExpr(
        "CAST(city_id AS BIGINT) AS city_id",
        "city_name AS name",
        "CAST(lat AS STRING) AS lat",
        "CAST(lon AS STRING) AS lon",
        "DATE'2024-01-01' AS run_date",
    )
    landing.write_drop(cities, f"{root}/landing/city")
    return Zones(f"{root}/landing", f"{root}/processed")


@query("job_dims")
def job_dims(spark, sf_dir):
    customers = fx.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS city_id",
        "c_name AS name",
        "CAST(c_nationkey AS STRING) AS lat",
        "CASE WHEN c_acctbal >= 0 THEN '105.25' END AS lon",
        "DATE'2024-01-01' AS run_date",
    )
    root = scratch_path(spark, "zones")
    landing.write_drop(customers, f"{root}/landing/city")
    zones = Zones(f"{root}/landing", f"{root}/processed")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    warehouse.create()
    for _ in range(2):
        refresh_dimensions(warehouse, zones, fx.YEARS[0])
    parts = (
        ("dim_city", ["city_id", "city_name", "country"]),
        ("dim_date", ["date_id", "CAST(full_date AS STRING)", "day_of_week"]),
        ("dim_time", ["time_id", "CAST(hour AS STRING)", "time_bucket"]),
    )
    tables = [
        warehouse.read(t).selectExpr(f"'{t}' AS table_name", f"{i} AS id", f"{k} AS natural_key", f"{a} AS attribute")
        for t, (i, k, a) in parts
    ]
    return tables[0].union(tables[1]).union(tables[2])


def _job(spark: SparkSession, sf_dir: str, load_facts: Callable[[Warehouse, Zones], object]) -> DataFrame:
    zones = _zones(spark, sf_dir)
    # One document per city and drop: each month of each block of event ids is a drop of its own.
    drop = F.expr(
        f"date_add(DATE'{fx.FIRST_DAY}', CAST(batch * 13 + months_between(run_date, DATE'{fx.FIRST_DAY}') AS INT))"
    )
    for domain, documents in (
        ("weather", fx.weather_documents(spark, sf_dir)),
        ("aq", fx.air_documents(spark, sf_dir)),
    ):
        landing.write_drop(documents.withColumn("run_date", drop).drop("batch"), f"{zones.landing}/{domain}")
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.create()
    for year in fx.YEARS:
        refresh_dimensions(warehouse, zones, year)
    load_facts(warehouse, zones)
    wide = []
    for fact, measures in (
        ("fact_weather", ("temperature", "rain", "wind_direction")),
        ("fact_air_quality", ("aqi", "o3", "pm25")),
    ):
        numbers = (F.col(m).cast("double").alias(f"m{i}") for i, m in enumerate(measures, 1))
        view = warehouse.star(fact).view()
        wide.append(view.select(F.lit(fact).alias("table_name"), "city_name", "full_date", "hour", *numbers))
    return wide[0].union(wide[1])


@query("job_daily")
def job_daily(spark, sf_dir):
    return _job(spark, sf_dir, daily_facts)


@query("job_incremental")
def job_incremental(spark, sf_dir):
    checkpoint = scratch_path(spark, "offsets")

    def load_twice(warehouse: Warehouse, zones: Zones) -> None:
        for _ in range(2):
            incremental_facts(warehouse, zones, checkpoint)

    return _job(spark, sf_dir, load_twice)


def _recrawled(spark: SparkSession, sf_dir: str) -> tuple[Zones, list[date]]:
    """Air-quality documents, a drop for each block of event ids, so that drops share city-dates; and
    files with other values that landed later, of a third of the cities, in the same drops."""
    zones = _zones(spark, sf_dir)
    drop = F.expr(f"date_add(DATE'{fx.FIRST_DAY}', CAST(batch AS INT))")
    documents = fx.air_documents(spark, sf_dir).withColumn("run_date", drop).drop("batch")
    landing.write_drop(documents, f"{zones.landing}/aq")
    again = documents.filter("city_id % 3 = 0").withColumn("pm2_5", F.transform("pm2_5", lambda v: v + 1.0))
    again.write.mode("append").option("ignoreNullFields", "false").partitionBy("run_date").json(f"{zones.landing}/aq")
    drops = [date.fromisoformat(n.removeprefix("run_date=")) for n in storage.names(spark, f"{zones.landing}/aq")]
    return zones, drops


@query("load_groupings")
def load_groupings(spark, sf_dir):
    """The same files loaded at once, drop by drop from the newest on, and as they land: the newest version counts."""
    zones, drops = _recrawled(spark, sf_dir)

    def by_drop(warehouse: Warehouse, zones: Zones) -> None:
        daily_facts(warehouse, zones, run_date=drops[::-1])

    groupings = {
        "at once": daily_facts,
        "newest drop first": by_drop,
        "as they land": lambda warehouse, zones: incremental_facts(warehouse, zones, scratch_path(spark, "offsets")),
    }

    def loaded(name: str) -> DataFrame:
        own = Zones(zones.landing, scratch_path(spark, "processed"))
        warehouse = _warehouse(spark, sf_dir)
        groupings[name](warehouse, own)
        view = warehouse.star("fact_air_quality").view()
        return view.select(F.lit(name).alias("grouping_name"), "city_name", "full_date", "hour", "pm25", "aqi")

    # Each has a warehouse and processed tables of its own: the many small loads of one leave cores to the others.
    found = at_once(spark, [lambda name=name: loaded(name) for name in groupings])
    return found[0].union(found[1]).union(found[2])
