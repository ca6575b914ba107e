"""Insert-if-absent, surrogate keys and fact lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazemill.operators.clean import conform, dedup_first
from hazemill.schemas import FACT_IDS, TABLES
from hazemill.session import kept


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``incoming`` whose key ``existing`` lacks, the first one (in ``order``) per key.

    Existing rows never change. Without ``order`` any of the copies may stay.
    """
    single = dedup_first(incoming, keys, order) if order else incoming.dropDuplicates(list(keys))
    return single.join(existing.select(*keys), list(keys), "left_anti")


def with_dim_ids(new: DataFrame, existing: DataFrame, id_column: str, order: str) -> DataFrame:
    """Number new dimension rows after the largest id in use.

    The window has no partitions: only for the calendars, whose size time itself bounds
    (24 hours, 366 days a year).
    """
    last = existing.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    position = F.row_number().over(Window.orderBy(order))
    return new.withColumn(id_column, (last + position).cast("int"))


def file_spans(table: DataFrame) -> DataFrame:
    """The ids that numbering a Parquet scan consumes in each of its files: up to the last row read.

    Stored in the shared folder, one row per file, so that Spark knows its size when it plans.
    """
    file = F.col("_metadata.file_path")
    return kept(table.groupBy(file.alias("_file")).agg((F.max("_metadata.row_index") + 1).alias("_rows")), "spans")


def with_fact_ids(table: DataFrame, id_column: str, first_id: int, spans: DataFrame | None = None) -> DataFrame:
    """Number the rows of a Parquet scan from ``first_id`` on.

    A row's number is its index in its file plus the spans of the files before, so a task that
    runs again gives the same ids. Filters on ``table`` leave gaps; all ids lie within the sum
    of ``spans``, which is what a caller must reserve.
    """
    file = F.col("_metadata.file_path")
    before = F.sum("_rows").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    spans = file_spans(table) if spans is None else spans
    # The first id is added here and not to each row: the code generated for the rows is then the same in every load.
    offsets = spans.select("_file", (F.lit(first_id).cast("long") + F.coalesce(before, F.lit(0))).alias("_before"))
    located = table.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_index"))
    numbered = located.join(offsets, "_file").withColumn(id_column, F.col("_before") + F.col("_index"))
    return numbered.drop("_file", "_index", "_before")


def locate(processed: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Replace date and hour by their ids. Rows without a match drop out (see lookup_misses).

    Both dimensions are small enough for Spark to broadcast, so the rows are not shuffled.
    """
    dates = dim_date.select("date_id", F.col("full_date").alias("date"))
    hours = dim_time.select("time_id", "hour")
    return processed.join(dates, "date").join(hours, "hour").withColumn("full_date", F.col("date"))


def fact_rows(
    table: str,
    processed: DataFrame,
    dim_date: DataFrame,
    dim_time: DataFrame,
    id_column: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Rows of a fact table from processed rows that carry their id in ``id_column``."""
    located = locate(processed, dim_date, dim_time)
    return conform(located.withColumn(FACT_IDS[table], F.col(id_column or FACT_IDS[table])), schema or TABLES[table])
