"""Fixed schemas of landed documents, processed tables and the star schema."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

INT, LONG, DOUBLE, STRING, DATE = IntegerType(), LongType(), DoubleType(), StringType(), DateType()


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Variable names of the weather and air-quality services and the names used here.
WEATHER_NAMES = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "dew_point_2m": "dew_point",
    "wind_speed_10m": "wind_speed",
    "wind_direction_10m": "wind_direction",
    "cloud_cover_low": "cloud_cover",
}
AIR_NAMES = {
    "pm2_5": "pm25",
    "carbon_monoxide": "co",
    "carbon_dioxide": "co2",
    "nitrogen_dioxide": "no2",
    "sulphur_dioxide": "so2",
    "ozone": "o3",
}

# Hourly measures unnested into rows; dew_point stays an array in processed weather.
WEATHER_MEASURES = (
    "temperature",
    "humidity",
    "wind_speed",
    "weather_code",
    "precipitation",
    "cloud_cover",
    "rain",
    "wind_direction",
    "apparent_temperature",
)
AIR_MEASURES = ("co", "co2", "no2", "so2", "o3", "pm10", "pm25")

_DOUBLES, _STRINGS = ArrayType(DOUBLE), ArrayType(STRING)

HOURLY_WEATHER = _struct(
    temperature_2m=_DOUBLES,
    relative_humidity_2m=_DOUBLES,
    dew_point_2m=_DOUBLES,
    wind_speed_10m=_DOUBLES,
    wind_direction_10m=_DOUBLES,
    precipitation=_DOUBLES,
    weather_code=_DOUBLES,
    apparent_temperature=_DOUBLES,
    rain=_DOUBLES,
    cloud_cover_low=_DOUBLES,
    time=_STRINGS,
)
HOURLY_AIR = _struct(
    pm10=_DOUBLES,
    pm2_5=_DOUBLES,
    carbon_monoxide=_DOUBLES,
    carbon_dioxide=_DOUBLES,
    nitrogen_dioxide=_DOUBLES,
    sulphur_dioxide=_DOUBLES,
    ozone=_DOUBLES,
    time=_STRINGS,
)

_CITY_TAG = [StructField("city_name", STRING), StructField("city_id", LONG)]
RAW_WEATHER = StructType(HOURLY_WEATHER.fields + _CITY_TAG)
RAW_AIR = StructType(HOURLY_AIR.fields + _CITY_TAG)
# lat/lon arrive as strings or numbers; a string field accepts both.
RAW_CITY = _struct(city_id=LONG, name=STRING, lat=STRING, lon=STRING)
RAW = {"weather": RAW_WEATHER, "aq": RAW_AIR, "city": RAW_CITY}

# The version of a city's date is its drop, then the time and the path of the landed file: the
# greatest counts. Facts are stored with it.
VERSION = _struct(run_date=DATE, file_time=TimestampType(), file=STRING)

# ``reject`` says why a row must not be loaded (null for good rows).
PROCESSED_WEATHER = _struct(
    city_id=LONG,
    city_name=STRING,
    time=STRING,
    date=DATE,
    hour=INT,
    temperature=DOUBLE,
    humidity=DOUBLE,
    wind_speed=DOUBLE,
    weather_code=DOUBLE,
    precipitation=DOUBLE,
    cloud_cover=DOUBLE,
    rain=DOUBLE,
    wind_direction=DOUBLE,
    apparent_temperature=DOUBLE,
    dew_point=_DOUBLES,
    reject=STRING,
    file_time=TimestampType(),
    file=STRING,
    run_date=DATE,
)
PROCESSED_AIR = _struct(
    city_id=LONG,
    city_name=STRING,
    time=STRING,
    date=DATE,
    hour=INT,
    co=DOUBLE,
    co2=DOUBLE,
    no2=DOUBLE,
    so2=DOUBLE,
    o3=DOUBLE,
    pm10=DOUBLE,
    pm25=DOUBLE,
    co_mg=DOUBLE,
    aqi=INT,
    reject=STRING,
    file_time=TimestampType(),
    file=STRING,
    run_date=DATE,
)
PROCESSED_CITY = _struct(city_id=LONG, city_name=STRING, lat=DOUBLE, lon=DOUBLE, country=STRING)
PROCESSED = {"weather": PROCESSED_WEATHER, "aq": PROCESSED_AIR, "city": PROCESSED_CITY}

DIM_CITY = _struct(city_id=INT, city_name=STRING, country=STRING, lon=DOUBLE, lat=DOUBLE)
DIM_DATE = _struct(
    date_id=INT,
    full_date=DATE,
    day=INT,
    month=INT,
    year=INT,
    quarter=INT,
    is_weekend=BooleanType(),
    day_of_week=STRING,
)
DIM_TIME = _struct(time_id=INT, hour=INT, minute=INT, second=INT, time_bucket=STRING)
# Fact ids are LONG: at hourly grain they pass 2^31. full_date is the partition column.
FACT_WEATHER = _struct(
    weather_id=LONG,
    date_id=INT,
    city_id=INT,
    time_id=INT,
    temperature=DOUBLE,
    humidity=DOUBLE,
    wind_speed=DOUBLE,
    precipitation=DOUBLE,
    weather_code=STRING,
    cloud_cover=DOUBLE,
    rain=DOUBLE,
    wind_direction=STRING,
    apparent_temperature=DOUBLE,
    full_date=DATE,
)
FACT_AIR = _struct(
    aq_id=LONG,
    time_id=INT,
    city_id=INT,
    date_id=INT,
    aqi=DOUBLE,
    pm25=DOUBLE,
    pm10=DOUBLE,
    no2=DOUBLE,
    so2=DOUBLE,
    o3=DOUBLE,
    co=DOUBLE,
    co2=DOUBLE,
    full_date=DATE,
)
TABLES = {
    "dim_city": DIM_CITY,
    "dim_date": DIM_DATE,
    "dim_time": DIM_TIME,
    "fact_weather": FACT_WEATHER,
    "fact_air_quality": FACT_AIR,
}
FACT_IDS = {"fact_weather": "weather_id", "fact_air_quality": "aq_id"}
# As they are stored: facts with their version, which readers of the table do not see.
STORED = {name: StructType([*schema.fields, *(VERSION.fields if name in FACT_IDS else [])]) for name, schema in TABLES.items()}
