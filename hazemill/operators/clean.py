"""From landed documents to processed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazemill.functions.aqi import aqi, co_milligrams
from hazemill.functions.dates import wall_clock
from hazemill.schemas import AIR_MEASURES, AIR_NAMES, PROCESSED, WEATHER_MEASURES, WEATHER_NAMES

COUNTRY = "Việt Nam"
RAGGED = "arrays of different lengths"
NO_TIME = "unreadable time"
NO_INDEX = "no pollutant has a sub-index"


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in ``order``.

    The rank filter becomes a group limit below the shuffle, so a key that holds a large
    share of the rows sends one row per task, not all of them to one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def impute_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing measures count as 0."""
    return df.fillna(0, list(columns))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, in order and cast to its types; a cast that loses a value fails.

    Codes are text in the warehouse: a whole number is written without a fraction, 180.0 as '180',
    any other as it is, '180.5'.
    """
    kinds = dict(df.dtypes)
    casts = []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        cast = f"CAST({f.name} AS {kind})"
        if kind == "string" and kinds.get(f.name) == "double":
            cast = f"CASE WHEN {f.name} = rint({f.name}) AND abs({f.name}) < 1e15D THEN CAST(CAST({f.name} AS BIGINT) AS STRING) ELSE {cast} END"
        casts.append(f"{cast} AS {f.name}")
    return df.selectExpr(*casts)


def explode_hourly(documents: DataFrame, measures: Sequence[str], strict: bool = False) -> DataFrame:
    """One row per array position, all arrays in lock-step with ``time``.

    An absent or empty array counts as one empty position, so a document whose arrays are
    all empty gives one row without measures. A document with other differences in length
    gives one row with ``reject`` set, or an error with ``strict``. Rows of a document with an
    ``unreadable`` field are rejected for that.
    """
    arrays = [*measures, "time"]
    kinds = {f.name: f.dataType for f in documents.schema.fields}
    present = documents.withColumns(
        {c: F.coalesce(F.col(c), F.array().cast(kinds[c])) for c in arrays}
    )
    lengths = [F.greatest(F.size(c), F.lit(1)) for c in arrays]
    even = F.least(*lengths) == F.greatest(*lengths)
    rows = F.when(even, F.arrays_zip(*arrays))
    if strict:
        rows = rows.otherwise(F.raise_error(F.lit(RAGGED)))
    others = [c for c in documents.columns if c not in arrays]
    reject = F.when(~even, F.lit(RAGGED))
    if "unreadable" in documents.columns:
        reject = F.coalesce(F.concat(F.lit("unreadable "), "unreadable"), reject)
    return present.select(*others, reject.alias("reject"), rows.alias("_rows")).select(
        *others, "reject", F.inline_outer("_rows")
    )


def with_date_and_hour(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``date`` and ``hour``; where a time cannot be read, ``reject`` (if present) says so."""
    moment = wall_clock("time", strict)
    dated = {"date": F.to_date(moment), "hour": F.hour(moment)}
    if "reject" in df.columns:
        dated["reject"] = F.coalesce("reject", F.when(F.col("time").isNotNull() & moment.isNull(), F.lit(NO_TIME)))
    return df.withColumns(dated)


def _in_schema(df: DataFrame, domain: str, extra: Sequence[str] = ()) -> DataFrame:
    wanted = [*(f.name for f in PROCESSED[domain].fields), *extra]
    return df.select(*(c for c in wanted if c in df.columns))


def clean_weather(
    documents: DataFrame,
    strict: bool = False,
    drop: Sequence[str] = ("run_date",),
    order: str = "source",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Weather documents to one row per city-hour; the first document of a city in a drop wins.

    ``extra`` names columns of the documents to keep besides those of the processed table.
    """
    keys = [*drop, "city_id", "city_name"]
    first = dedup_first(documents.withColumnsRenamed(WEATHER_NAMES), keys, [order])
    hourly = impute_zero(explode_hourly(first, WEATHER_MEASURES, strict), WEATHER_MEASURES)
    return _in_schema(with_date_and_hour(hourly, strict), "weather", extra)


def clean_air(
    documents: DataFrame,
    strict: bool = False,
    dedup: bool = False,
    drop: Sequence[str] = ("run_date",),
    order: str = "source",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Air-quality documents to one row per city-hour with its AQI.

    Repeated documents are all kept unless ``dedup``. A row without any sub-index gets
    ``reject``, or fails the job with ``strict``. ``extra`` as for weather.
    """
    documents = documents.withColumnsRenamed(AIR_NAMES)
    if dedup:
        documents = dedup_first(documents, [*drop, "city_id"], [order])
    hourly = impute_zero(explode_hourly(documents, AIR_MEASURES, strict), AIR_MEASURES)
    return _in_schema(with_aqi(with_date_and_hour(hourly, strict), strict), "aq", extra)


def with_aqi(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``co_mg`` and ``aqi``; where there is no index, ``reject`` (if present) says so."""
    indexed = df.withColumn("co_mg", co_milligrams()).withColumn("aqi", aqi(strict=strict))
    if "reject" not in df.columns:
        return indexed
    return indexed.withColumn("reject", F.coalesce("reject", F.when(F.col("aqi").isNull(), F.lit(NO_INDEX))))


def clean_city(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Distinct complete cities. A coordinate that is no number drops the row, or fails with ``strict``.

    Landed cities keep the newest file they are in (``file_time``, ``file``) and their place in it (``source``).
    """
    lat, lon = (F.col(c).cast("double") if strict else F.col(c).try_cast("double") for c in ("lat", "lon"))
    named = raw.withColumn("city_name", F.col("name")).withColumns({"lat": lat, "lon": lon})
    keys = ["city_id", "city_name", "lat", "lon"]
    complete = named.dropna("any", subset=keys)
    # Only key columns are left, so copies are equal.
    distinct = complete.select(*keys).dropDuplicates()
    if "source" in raw.columns:
        version = [c for c in ("file_time", "file") if c in raw.columns]
        per_file = complete.groupBy(*keys, *version).agg(F.min("source").alias("source"))
        newest = F.max_by(F.struct(*version, "source"), F.struct(F.lit(0), *version)).alias("newest")
        distinct = per_file.groupBy(*keys).agg(newest).select(*keys, "newest.*")
    return distinct.withColumn("country", F.lit(COUNTRY))
