"""Which city-days to fetch, and what came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazemill.session import kept


def fetch_manifest(
    cities: DataFrame,
    start: Column | None = None,
    end: Column | None = None,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """One request per city and day, yesterday by default.

    With ``loaded`` (city_id, full_date of the facts) only the gaps remain: the facts
    are reduced to city-days before they are shuffled.
    """
    yesterday = F.date_sub(F.current_date(), 1)
    first = yesterday if start is None else start
    last = first if end is None else end
    requests = cities.select(
        "city_id",
        "city_name",
        "lat",
        "lon",
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("start_date"),
    ).withColumn("end_date", F.col("start_date"))
    if loaded is None:
        return requests
    done = loaded.select("city_id", F.col("full_date").alias("start_date")).distinct()
    return requests.join(done, ["city_id", "start_date"], "left_anti").select(*requests.columns)


def hourly_variables(responses: DataFrame, hourly: StructType, source: str = "hourly") -> DataFrame:
    """Spread the requested variables of the ``hourly`` struct; a missing one becomes an empty array."""
    present = set(responses.schema[source].dataType.names)
    rest = [c for c in responses.columns if c != source]
    spread = [
        F.coalesce(F.col(f"{source}.{f.name}").cast(f.dataType), F.array().cast(f.dataType)).alias(f.name)
        if f.name in present
        else F.array().cast(f.dataType).alias(f.name)
        for f in hourly.fields
    ]
    return responses.select(*rest, *spread)


def request_keys(manifest: DataFrame, responses: DataFrame) -> tuple[str, ...]:
    """City and day where both sides have days, else the city."""
    dated = "start_date" in manifest.columns and "start_date" in responses.columns
    return ("city_id", "start_date") if dated else ("city_id",)


def attach_results(manifest: DataFrame, responses: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Responses tagged with the id and name of the city asked for. A request without a
    response drops out; a response with empty arrays stays.

    With days among the keys, responses of other days than those asked for drop out before anything
    is shuffled by key, and what is left is stored: Spark then knows its size, and a manifest of far more
    requests than answers is not shuffled.
    """
    keys = keys or request_keys(manifest, responses)
    payload = [c for c in responses.columns if c not in keys and c != "city_name"]
    answers = responses.select(*keys, *payload)
    if "start_date" in keys:
        asked = manifest.select("start_date").distinct()
        answers = kept(answers.join(asked, "start_date", "left_semi"), "answers")
    tagged = manifest.select(*keys, "city_name").join(answers, list(keys))
    return tagged.select(*keys, "city_name", *payload)


def failed_fetches(manifest: DataFrame, responses: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Requests nothing came back for."""
    keys = keys or request_keys(manifest, responses)
    return manifest.join(responses.select(*keys), list(keys), "left_anti")


def first_geocode(provinces: DataFrame, geocodes: DataFrame) -> DataFrame:
    """Province (code, name) with its first geocode match spread over it.

    ``geocodes`` has the province ``code`` and ``detail``, an array of structs. Provinces
    without a match drop out, and a name in the match replaces the province's.
    """
    matched = geocodes.filter(F.size("detail") > 0).select("code", F.element_at("detail", 1).alias("match"))
    fields = matched.schema["match"].dataType.names
    name = F.coalesce("match.name", "name") if "name" in fields else F.col("name")
    others = [F.col(f"match.{f}") for f in fields if f not in ("name", "city_id")]
    return provinces.join(matched, "code").select(F.col("code").alias("city_id"), name.alias("name"), *others)
