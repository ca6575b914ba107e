"""What the operators share: documents, intermediate tables, files in the shared folder, components."""

from __future__ import annotations

import io
import math
import re
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import hazemill
from hazemill.session import scratch_path

#: Rows of a batch: texts of a few kilobytes make a few megabytes.
ROWS_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
#: Applications whose executors have this package.
_SHIPPED: set[str] = set()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage is cut, their size is known."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a filter per key, and at most; a full one lets other keys pass too.
FILTER_BITS, MOST_BITS = 16, 1 << 28


def key_filter(keys: DataFrame) -> Callable[[np.ndarray], np.ndarray] | None:
    """Whether a task's keys may be among ``keys`` (key: bigint, well mixed); None where there are none.

    A table of bits for all executors, of at most ``MOST_BITS``: it never misses a key, and lets
    few others pass; what passes is joined with ``keys`` afterwards.
    """
    spark = keys.sparkSession
    count = keys.count()
    if not count:
        return None
    bits = max(1 << 15, min(MOST_BITS, 1 << (FILTER_BITS * count).bit_length()))
    place = F.pmod("key", F.lit(bits)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    table = np.zeros(bits // 8, np.uint8)
    for r in parts.collect():
        low = (r["part"] - 1) * 4096
        table[low : low + 4096] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(table)

    def passes(key: np.ndarray) -> np.ndarray:
        at = key % bits
        return (shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    return passes


def part_bytes(total: int) -> int:
    """Bytes of a part of ``total``: parts grow in number and in size, from 4 MB to 1 GB."""
    return min(max(math.isqrt(total << 20), 4 << 20), 1 << 30)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder and the path in it; works in tasks of any executor."""
    if re.match(r"[a-z0-9+]+://", uri):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


def ship_package(spark: SparkSession) -> None:
    """Let the executors import this package, from an archive in the shared folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(hazemill.__file__).parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for module in sorted(root.rglob("*.py")):
            archive.write(module, module.relative_to(root.parent))
    uri = f"{scratch_path(spark, 'package')}.zip"
    system, path = file_system(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path) as out:
        out.write(buffer.getvalue())
    context.addPyFile(uri)
    _SHIPPED.add(context.applicationId)


Batches = Iterator[pa.RecordBatch]


def in_tasks(df: DataFrame, function: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """``function`` over the Arrow batches of each partition.

    A batch has ``BATCH_ROWS`` rows at most, for which the session's setting is lowered, and Spark
    closes it at ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB), so long texts do not add up.
    """
    spark = df.sparkSession
    ship_package(spark)
    if int(spark.conf.get(ROWS_SETTING)) > BATCH_ROWS:
        spark.conf.set(ROWS_SETTING, BATCH_ROWS)

    def run(batches: Batches) -> Batches:
        yield from function(batches)
        pa.default_memory_pool().release_unused()  # the worker lives on and shares the executor's memory

    return df.mapInArrow(run, schema)


def _forest(batches: Batches) -> Batches:
    """Reduce a partition's links to one link per node, to the smallest node it is joined with here."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, r) for x in parent if (r := root(x)) != x]
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)]
    yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: bigint); root is the smallest node reachable.

    Links are reduced to a forest in each partition, then joined by alternating large-star and
    small-star rounds, each a few shuffles of one row per link; a round's links are written to
    the shared folder. A node with very many links only meets pre-aggregated minima and a join
    whose skewed side Spark can split.
    """
    links = stored(in_tasks(links.filter("a <> b"), _forest, "a bigint, b bigint"), "links")
    before = None
    while True:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        least = least.select("node", F.least("node", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        joined = large.join(small, F.col("a") == F.col("node"))
        links = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("node", "m"))
        links = stored(in_tasks(links.filter("a <> b").distinct(), _forest, "a bigint, b bigint"), "links")
        state = links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
