"""Dense ranks within a period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_ranks(df: DataFrame, period: Sequence[str], ranks: Mapping[str, Column]) -> DataFrame:
    """Add one descending dense rank per entry of ``ranks`` (name to value) within each period.

    One shuffle serves all ranks. ``df`` has one row per city and period, so a window holds the
    cities, however many facts they have.
    """
    window = Window.partitionBy(*period)
    return df.withColumns({name: F.dense_rank().over(window.orderBy(value.desc())) for name, value in ranks.items()})
