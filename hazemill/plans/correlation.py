"""Correlation of weather with pollution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.session import kept

POLLUTION = ("aqi", "pm10", "pm25")
WEATHER = ("rain", "wind_speed", "humidity", "temperature")
CELL = ("city_id", "date_id", "time_id")
LABELS = {"aqi": "AQI", "pm10": "PM10", "pm25": "PM2.5"}
# The labels older reports used: the two PM rows are swapped.
LEGACY_LABELS = {"aqi": "AQI", "pm10": "PM2.5", "pm25": "PM10"}


def weather_pollution_correlation(
    fact_weather: DataFrame, fact_air: DataFrame, legacy_labels: bool = False
) -> DataFrame:
    """Pearson correlation of each pollution measure with each weather measure.

    The statistic is over all pairs of a weather and an air row in the same city, date and
    hour. Pairs are never formed: each side is reduced to moments per cell (rows, mean, sum of
    squares about the mean) before the cells are joined, in one scan of it. Inside a cell every
    row of one side meets every row of the other, so a cell's pairs have the moments of its two
    sides, weighted by the rows of the other one, and no co-moment of their own; a cell with very
    many rows costs no more than any other.

    The moments of the joined cells are then put together about the mean of the joined pairs, so
    that neither a small spread around a large value is lost nor a row that has no partner matters.
    The joined cells, one row each, are written to the shared folder for that. A measure whose
    pairs all have the same value has no variance, and its correlations are NaN.
    """
    measures = (*POLLUTION, *WEATHER)
    joined = _moments(fact_weather, WEATHER, "weather_rows").join(_moments(fact_air, POLLUTION, "air_rows"), list(CELL))
    cells = kept(joined.drop(*CELL).withColumn("n", F.col("weather_rows") * F.col("air_rows")), "cells")
    means = cells.agg(*(F.try_divide(F.sum(F.col("n") * F.col(f"{m}_mean")), F.sum("n")).alias(m) for m in measures))
    off = cells.withColumns({f"{m}_off": F.col(f"{m}_mean") - means.select(m).scalar() for m in measures})
    pairs = [(p, w) for p in POLLUTION for w in WEATHER]
    sums = [F.sum("n").alias("n")]
    for m in measures:
        others = "weather_rows" if m in POLLUTION else "air_rows"
        sums += [
            F.expr(f"sum(n * {m}_off)").alias(f"{m}_rest"),  # what rounding of the mean has left
            F.expr(f"sum(n * {m}_off * {m}_off + {others} * {m}_squares)").alias(f"{m}_squares"),
            F.expr(f"min({m}_least) < max({m}_most)").alias(f"{m}_varies"),
        ]
    sums += [F.expr(f"sum(n * {p}_off * {w}_off)").alias(f"{p}_{w}") for p, w in pairs]
    about = lambda x, a, b: f"{x} - {a}_rest * try_divide({b}_rest, n)"
    deviations = [
        f"CASE WHEN {m}_varies THEN sqrt(greatest({about(f'{m}_squares', m, m)}, 0D)) ELSE 0D END AS {m}_deviation"
        for m in measures
    ]
    joint = [f"{about(f'{p}_{w}', p, w)} AS {p}_{w}" for p, w in pairs]
    # Deviations one after the other: their product could pass the range of a double.
    ratios = [f"try_divide(try_divide({p}_{w}, {p}_deviation), {w}_deviation) AS {p}_{w}" for p, w in pairs]
    # Rounding can carry a perfect correlation past 1.
    bounded = [f"CASE WHEN abs({p}_{w}) > 1D THEN signum({p}_{w}) ELSE {p}_{w} END AS {p}_{w}" for p, w in pairs]
    labels = LEGACY_LABELS if legacy_labels else LABELS
    rows = [
        f"named_struct('metric', '{labels[p]}', "
        + ", ".join(f"'{w}', coalesce({p}_{w}, DOUBLE('NaN'))" for w in WEATHER)
        + ")"
        for p in POLLUTION
    ]
    found = off.agg(*sums).selectExpr(*deviations, *joint)
    return found.selectExpr(*ratios).selectExpr(*bounded).selectExpr(f"inline(array({', '.join(rows)}))")


def _moments(fact: DataFrame, measures: tuple[str, ...], rows: str) -> DataFrame:
    """Moments per cell. Pair counts pass the range of a LONG long before they lose precision as doubles."""
    found = [F.count(F.lit(1)).cast("double").alias(rows)]
    for m in measures:
        found += [
            F.avg(m).alias(f"{m}_mean"),
            (F.var_pop(m) * F.count(m)).alias(f"{m}_squares"),
            F.min(m).alias(f"{m}_least"),
            F.max(m).alias(f"{m}_most"),
        ]
    return fact.groupBy(*CELL).agg(*found)
