"""Vector code compression: a byte for each of four parts of a vector, in whole numbers only.

A component x becomes the integer floor(1024 x). Vectors are cut into four equal consecutive
parts; each part position has a codebook of up to 256 entries, which starts as the parts of the
256 smallest vec_ids and is moved by four rounds of assignment and floored means.

Nearest entries are found under an integer Walsh-Hadamard transform of parts and entries, both
padded with zeros to a power of two P: sums and differences only, and squared distances of the
transforms are P times those of the parts. Squared differences are accumulated in sequency order,
a few coefficients at a time; an entry whose sum exceeds the whole distance of the entry that led
after the first coefficients cannot be nearest and is eliminated. Entries that tie are never
eliminated, and the lowest index wins. Nothing is rounded: where 64 bits could overflow, the same
steps run on Python's integers.

Spark reads the vectors once a round; a task sends one sum per part and entry, so the driver holds
``PARTS`` x ``ENTRIES`` entries and no more, whatever the table.

Rows with a null vector, or null or non-finite components, are dropped. Shorter vectors are padded
with zeros to the longest, and that to a multiple of four, before they are cut; an empty vector is
all zeros. Components are clamped to +-2^30, errors to 2^63 - 1. Rows without a vec_id come last
in the start order, where equal vec_ids are ordered by their vectors; repeated rows count each; with fewer than 256
vectors the codebooks have fewer entries; any type of label will do; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hazemill.llm.common import Batches, in_tasks, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Greatest component, and vectors that are assigned at once.
LIMIT, BLOCK = 2.0**30, 256
#: Coefficients that are added between eliminations, as a share of P.
STEPS = 4
MOST = (1 << 63) - 1


def sequency_order(size: int) -> np.ndarray:
    """Rows of the butterflies' transform by their number of sign changes; ``size`` is a power of two."""
    bits = size.bit_length() - 1
    number = np.arange(size)
    gray = number ^ number >> 1
    return sum((gray >> b & 1) << (bits - 1 - b) for b in range(bits)) + np.zeros(size, np.int64)


def walsh(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the last axis, zero-padded to a power of two, in sequency order."""
    length = parts.shape[-1]
    size = 1 << max(length - 1, 0).bit_length()
    x = np.zeros((*parts.shape[:-1], size), parts.dtype)
    x[..., :length] = parts
    half = 1
    while half < size:
        pairs = x.reshape(*x.shape[:-1], size // (2 * half), 2, half)
        a, b = pairs[..., 0, :], pairs[..., 1, :]
        x = np.stack([a + b, a - b], axis=-2).reshape(x.shape)
        half *= 2
    return x[..., sequency_order(size)]


def integers(lists: pa.ListArray, width: int) -> np.ndarray:
    """floor(1024 x) of each list of doubles as a row of ``width`` integers."""
    offsets = lists.offsets.to_numpy()
    values = np.clip(lists.values.to_numpy(zero_copy_only=False), -LIMIT, LIMIT)
    values = np.floor(values * SCALE).astype(np.int64)  # scaling by a power of two is exact
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], sizes)
    result = np.zeros((len(sizes), width), np.int64)
    result[row, place] = values[offsets[0] : offsets[-1]]
    return result


class Codebooks:
    """Entries of all part positions, and the nearest of them: ``entries`` is (parts, entries, length)."""

    def __init__(self, entries: np.ndarray, greatest: int):
        size = 1 << max(entries.shape[2] - 1, 0).bit_length()
        safe = size * max(entries.shape[2], 1) * (2 * greatest) ** 2 <= MOST
        self.dtype, self.size = (np.dtype(np.int64) if safe else np.dtype(object)), size
        self.transformed = walsh(entries.astype(self.dtype))

    def nearest(self, part: int, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and the squared distance to it, for each row of ``parts``."""
        found = [self._block(part, walsh(parts[i : i + BLOCK].astype(self.dtype))) for i in range(0, len(parts), BLOCK)]
        found.append((np.zeros(0, np.int64), np.zeros(0, self.dtype)))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _block(self, part: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entries = self.transformed[part]
        step = max(1, self.size // STEPS)
        gap = rows[:, None, :step] - entries[None, :, :step]
        so_far = (gap * gap).sum(axis=2)
        gap = rows - entries[so_far.argmin(axis=1)]
        bound = (gap * gap).sum(axis=1)  # the whole distance of the entry that leads
        row, entry = np.nonzero(so_far <= bound[:, None])
        so_far = so_far[row, entry]
        for low in range(step, self.size, step):
            gap = rows[row, low : low + step] - entries[entry, low : low + step]
            so_far = so_far + (gap * gap).sum(axis=1)
            alive = so_far <= bound[row]
            row, entry, so_far = row[alive], entry[alive], so_far[alive]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        least = np.minimum.reduceat(so_far, first)
        best = np.flatnonzero(so_far == least[row])  # rows and entries ascend
        best = best[np.concatenate([[True], row[best][1:] != row[best][:-1]])]
        return entry[best], least // self.size


def _kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label and embedding (doubles) of the rows that take part."""
    numbers = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", numbers.alias("embedding"))
    whole = "embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    return rows.filter(F.coalesce(F.expr(whole), F.lit(False)))


def _moved(kept: DataFrame, entries: np.ndarray, greatest: int, width: int) -> np.ndarray:
    """The entries after a round: floored means of the parts assigned to each."""
    length = entries.shape[2]
    shared = kept.sparkSession.sparkContext.broadcast(entries)

    def add(batches: Batches) -> Batches:
        books = Codebooks(shared.value, greatest)
        sums = np.zeros(entries_shape, object if books.dtype == object else np.int64)
        counts = np.zeros(entries_shape[:2], np.int64)
        for batch in batches:
            parts = integers(batch.column(0), width).reshape(batch.num_rows, PARTS, length)
            for k in range(PARTS):
                index, _ = books.nearest(k, parts[:, k])
                np.add.at(sums[k], index, parts[:, k])
                np.add.at(counts[k], index, 1)
        part, entry = np.nonzero(counts)
        totals = [list(map(str, sums[k, e].tolist())) for k, e in zip(part, entry, strict=True)]
        columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), pa.array(totals, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    entries_shape = entries.shape
    added = in_tasks(kept.select("embedding"), add, "part int, entry int, n bigint, sums array<string>")
    # A sum of a task is below 2^40 a row; decimals hold the sum of any table.
    place = added.select("part", "entry", "n", F.posexplode_outer("sums").alias("place", "total"))
    by_place = place.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(28,0)")).alias("total"))
    moved = entries.copy()
    for r in by_place.collect():  # one row for each component of the codebooks
        if r["place"] is not None:
            moved[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return moved


def fit_codebooks(kept: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, int, int]:
    """Entries (parts, entries, length) after ``rounds``, the padded width, the greatest component."""
    bounds = kept.agg(
        F.max(F.size("embedding")).alias("width"),
        F.max(F.expr("aggregate(embedding, 0D, (m, x) -> greatest(m, abs(x)))")).alias("most"),
    ).first()
    length = -(-(bounds["width"] or 0) // PARTS)
    width = PARTS * length
    greatest = int(min(bounds["most"] or 0.0, LIMIT) * SCALE) + 1
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(ENTRIES).collect()
    lists = pa.array([r["embedding"] for r in start], pa.list_(pa.float64()))
    entries = np.ascontiguousarray(integers(lists, width).reshape(len(start), PARTS, length).transpose(1, 0, 2))
    for _ in range(rounds if len(start) else 0):
        entries = _moved(kept, entries, greatest, width)
    return entries, width, greatest


def digest(entries: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, entries.ravel().tolist())).encode()).hexdigest()


def encode_vectors(kept: DataFrame, entries: np.ndarray, width: int, greatest: int) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every row."""
    shared = kept.sparkSession.sparkContext.broadcast(entries)
    length = width // PARTS

    def encode(batches: Batches) -> Batches:
        books = Codebooks(shared.value, greatest)
        for batch in batches:
            parts = integers(batch.column(2), width).reshape(batch.num_rows, PARTS, length)
            found = [books.nearest(k, parts[:, k]) for k in range(PARTS)]
            codes = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
            errors = [min(e, MOST) for e in sum(f[1].astype(object) for f in found).tolist()]
            columns = [*batch.columns[:2], pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    label = kept.schema["label"].dataType
    schema = StructType([StructField("vec_id", LongType()), StructField("label", label), StructField("code", StringType()), StructField("error", LongType())])
    return in_tasks(kept.select("vec_id", "label", "embedding"), encode, schema)


def compress_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept vector."""
    kept = _kept(vectors)
    entries, width, greatest = fit_codebooks(kept)
    codes = stored(encode_vectors(kept, entries, width, greatest), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(28,0)")), F.lit(str(MOST)).cast("decimal(28,0)")).cast("bigint")
    sums = stored(codes.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "label_errors")
    joined = codes.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(entries)).alias("codebooks_sha256"))


def _oracle(rounds: int = ROUNDS) -> str:
    """The rounds written out, a CTE for each assignment and each move."""
    steps = [f"""
WITH kept AS (
  SELECT vec_id, label, embedding AS v, CAST(len(embedding) / {PARTS} AS BIGINT) AS length FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbers AS (
  SELECT vec_id, (j - 1) // length AS part, (j - 1) % length AS place, CAST(floor(CAST(v[j] AS DOUBLE) * {SCALE}) AS BIGINT) AS x
  FROM kept, LATERAL (SELECT unnest(range(1, len(v) + 1)) AS j)
), started AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES}
), book0 AS (
  SELECT part, entry, place, x FROM numbers JOIN started USING (vec_id)
)"""]
    for r in range(rounds + 1):
        steps.append(f"""codes{r} AS MATERIALIZED (
  SELECT vec_id, part, min(entry) AS entry, any_value(least) AS error FROM (
    SELECT vec_id, n.part, b.entry, sum((n.x - b.x) * (n.x - b.x)) AS gap, min(gap) OVER (PARTITION BY vec_id, n.part) AS least
    FROM numbers n JOIN book{r} b ON n.part = b.part AND n.place = b.place GROUP BY vec_id, n.part, b.entry
  ) WHERE gap = least GROUP BY vec_id, part
)""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce(moved.x, b.x) AS x FROM book{r} b LEFT JOIN (
    SELECT part, entry, place, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
    FROM numbers JOIN codes{r} USING (vec_id, part) GROUP BY part, entry, place
  ) moved USING (part, entry, place)
)""")
    return ", ".join(steps) + f""", coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error
  FROM codes{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


ORACLE = _oracle()
