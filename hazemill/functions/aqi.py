"""Air Quality Index as native column expressions.

A sub-index interpolates a concentration linearly inside its band. The bands are
closed on both ends and leave gaps, and a value in a gap, below the first band or
above the last one has no sub-index (null). The AQI is the largest sub-index.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Index range of each band, the same for every pollutant.
INDEX_BANDS = ((0, 50), (51, 100), (101, 150), (151, 200), (201, 300), (301, 400), (401, 500))

# Concentration range of each band (µg/m³; co in mg/m³).
CONCENTRATION_BANDS = {
    "pm25": ((0, 35), (36, 75), (76, 115), (116, 150), (151, 250), (251, 350), (351, 500)),
    "pm10": ((0, 50), (51, 100), (101, 250), (251, 350), (351, 430), (431, 500), (501, 600)),
    "co": ((0, 5), (5.1, 10), (10.1, 35), (35.1, 60), (60.1, 90), (90.1, 120), (120.1, 150)),
    "so2": ((0, 50), (51, 100), (101, 350), (351, 500), (501, 750), (751, 1000), (1001, 1200)),
    "no2": ((0, 40), (41, 80), (81, 180), (181, 280), (281, 400), (401, 500), (501, 600)),
    "o3": ((0, 100), (101, 160), (161, 215), (216, 265), (266, 800), (801, 1000), (1001, 1200)),
}


def _raw_index(pollutant: str, concentration: str) -> str:
    # SQL text, because building the 42 bands of an AQI from Column calls takes over a second.
    # The coalesce makes a value that cannot be null, which keeps the generated code below the
    # 8000 bytes a method may have to be compiled by the JVM. NaN sorts above every band.
    c = f"coalesce(CAST({concentration} AS DOUBLE), DOUBLE('NaN'))"
    bands = zip(CONCENTRATION_BANDS[pollutant], INDEX_BANDS)
    cases = (
        f"WHEN {c} >= {low}D AND {c} <= {high}D "
        f"THEN {i_high - i_low}D / ({high}D - {low}D) * ({c} - {low}D) + {i_low}D"
        for (low, high), (i_low, i_high) in bands
    )
    return f"CASE {' '.join(cases)} END"


def sub_index(pollutant: str, concentration: str) -> Column:
    """Sub-index (INT, null outside every band) of one pollutant.

    ``concentration`` is a column name or SQL expression; co is expected in mg/m³.
    """
    if pollutant not in CONCENTRATION_BANDS:
        raise ValueError(f"unknown pollutant {pollutant!r}, expected one of {list(CONCENTRATION_BANDS)}")
    # rint rounds halves to even; round() would round them up.
    return F.expr(f"CAST(rint({_raw_index(pollutant, concentration)}) AS INT)")


def co_milligrams(co: str = "co") -> Column:
    """µg/m³ to mg/m³, the unit of the co bands; the stored co stays in µg/m³."""
    return F.col(co) / F.lit(1000.0)


def aqi(
    pm25: str = "pm25",
    pm10: str = "pm10",
    co_mg: str = "co_mg",
    so2: str = "so2",
    no2: str = "no2",
    o3: str = "o3",
    strict: bool = False,
) -> Column:
    """Largest sub-index; null when there is none, or an error with ``strict``."""
    measured = {"pm25": pm25, "pm10": pm10, "co": co_mg, "so2": so2, "no2": no2, "o3": o3}
    raw = ", ".join(_raw_index(name, c) for name, c in measured.items())
    # Rounding keeps the order, so one rounding after the maximum is enough.
    worst = F.expr(f"CAST(rint(greatest({raw})) AS INT)")
    if strict:
        return F.coalesce(worst, F.raise_error(F.lit("AQI: every sub-index is empty")).cast("int"))
    return worst
