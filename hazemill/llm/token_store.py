"""Token ids in binary shards, with a minimal perfect hash index from document key to record.

A store is a folder. ``shard-*.ids`` hold the raw ids of consecutive documents in ascending
doc_id order (little-endian, two bytes where the vocabulary fits), then the records' byte
offsets. ``index-*.npz`` hold, for one part of the keys each, a minimal perfect hash whose slot
gives the key's fingerprint, shard, record and number of copies. A lookup hashes the key once
per level, checks the fingerprint and reads one record.

Null doc_ids come first and share one key; null texts are empty; rows that repeat a doc_id are
consecutive records of one key; an empty table gives a store without shards; extra columns are
ignored. Texts are encoded whole, however long. Index parts grow in number with the table, not in
size; shards in number and, up to 1 GB of text, in size: a task holds one's offsets. A file is
written under a name of its own and then renamed, so a task that runs again replaces it by its equal.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.llm.common import Batches, file_system, in_tasks, part_bytes, shuffle_partitions, stored
from hazemill.llm.wordbpe import word_ids

#: Keys of one part of the index, on average.
KEYS_PER_PART = 200_000
#: Bits per key on each level of the hash, and levels before the rest is kept sorted.
GAMMA, LEVELS = 1.5, 40
KEY = "coalesce(xxhash64(doc_id), xxhash64('null', 'key'))"
RECORD = "doc_id bigint, shard int, record bigint, n_tokens bigint"


@dataclass(frozen=True)
class Store:
    """A written store. ``first_token`` and ``records`` have one entry per shard."""

    path: str
    width: int
    parts: int
    first_token: list[int]
    records: list[int]


def _put(folder: str, name: str, write) -> None:
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        write(out)
    system.move(draft, f"{path}/{name}")


def write_store(documents: DataFrame, path: str, tokenizer_file: str, end_id: int) -> Store:
    """Encode ``documents`` (doc_id, text) into a store at ``path``, a new folder in shared storage."""
    spark = documents.sparkSession

    def write_shard(batches: Batches) -> Batches:
        ids, shard = word_ids(tokenizer_file), TaskContext.get().partitionId()
        end = np.array([end_id], ids.dtype).tobytes()
        rows: list[pa.RecordBatch] = []

        def write(out) -> None:
            offsets = [0]
            for batch in batches:
                for found in ids.encode(batch.column(1)):
                    payload = found.tobytes() + end
                    out.write(payload)
                    offsets.append(offsets[-1] + len(payload))
                n = batch.num_rows
                at = np.array(offsets[-n - 1 :], np.int64) if n else np.zeros(1, np.int64)
                columns = [
                    batch.column(0),
                    pa.array(np.full(n, shard, np.int32)),
                    pa.array(np.arange(len(offsets) - 1 - n, len(offsets) - 1, dtype=np.int64)),
                    pa.array(np.diff(at) // ids.dtype.itemsize),
                ]
                rows.append(pa.RecordBatch.from_arrays(columns, names=["doc_id", "shard", "record", "n_tokens"]))
            out.write(np.array([*offsets, len(offsets)], "<i8").tobytes())

        _put(path, f"shard-{shard:06d}.ids", write)
        yield from rows

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    shards = max(1, -(-total // part_bytes(total)))
    ordered = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    records = stored(in_tasks(ordered, write_shard, RECORD), "records")
    written = records.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t")).collect()
    count = max((r["shard"] for r in written), default=-1) + 1
    sizes, tokens = [0] * count, [0] * count
    for r in written:  # one row per shard
        sizes[r["shard"]], tokens[r["shard"]] = r["n"], r["t"]
    parts = max(1, -(-sum(sizes) // KEYS_PER_PART))
    first_token = np.concatenate([[0], np.cumsum(tokens)[:-1]]).astype(int).tolist() if count else []
    _write_index(records, path, parts)
    return Store(path, word_ids(tokenizer_file).dtype.itemsize, parts, first_token, sizes)


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """Another hash of 64-bit keys for every level."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash: each key of a set has its own slot in 0 … n - 1.

    On each level the keys still left are hashed into a bit array; those alone at their bit
    are placed there, and the slot is the number of bits set before. Whatever is left after
    the last level is kept sorted.
    """

    def __init__(self, bits: list[np.ndarray], rest: np.ndarray):
        self.bits, self.rest = bits, rest
        self.ranks = [np.cumsum(b, dtype=np.int64) - 1 for b in bits]
        self.base = np.concatenate([[0], np.cumsum([int(b.sum()) for b in bits])]).astype(np.int64)

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        bits = []
        while len(keys) and len(bits) < LEVELS:
            at = (_mix(keys, len(bits)) % np.uint64(int(GAMMA * len(keys)) + 1)).astype(np.int64)
            alone = np.bincount(at, minlength=int(GAMMA * len(keys)) + 1) == 1
            bits.append(alone)
            keys = keys[~alone[at]]
        return PerfectHash(bits, np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot for each key; keys outside the set get any slot, or -1."""
        slots, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, alone in enumerate(self.bits):
            at = (_mix(keys[left], level) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[at]
            slots[left[hit]] = self.base[level] + self.ranks[level][at[hit]]
            left = left[~hit]
        if len(self.rest) and len(left):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            found = self.rest[at] == keys[left]
            slots[left[found]] = self.base[-1] + at[found]
        return slots


def _part(parts: int):
    return F.expr(f"cast(pmod({KEY}, {parts}) as int)")


def _write_index(records: DataFrame, path: str, parts: int) -> None:
    first = F.min(F.struct("shard", "record")).alias("at")
    keys = records.groupBy("doc_id").agg(first, F.count(F.lit(1)).alias("copies"))
    rows = keys.select(F.expr(KEY).alias("key"), _part(parts).alias("part"), "at.shard", "at.record", "copies")

    def write_part(batches: Batches) -> Batches:
        table = pa.Table.from_batches(list(batches), schema=None) if (batches := list(batches)) else None
        if table is not None and table.num_rows:
            key, part, shard, record, copies = (table.column(i).to_numpy() for i in range(5))
            key = key.view(np.uint64)
            hashed = PerfectHash.build(key)
            order = np.argsort(hashed.slots(key))
            arrays = {
                "sizes": np.array([len(b) for b in hashed.bits], np.int64),
                "bits": np.packbits(np.concatenate([*hashed.bits, np.zeros(0, bool)])),
                "rest": hashed.rest,
                "fingerprint": _mix(key, LEVELS)[order],
                "shard": shard[order],
                "record": record[order],
                "copies": copies[order],
            }
            buffer = io.BytesIO()
            np.savez(buffer, **arrays)
            _put(path, f"index-{int(part[0]):06d}.npz", lambda out: out.write(buffer.getvalue()))
        yield pa.RecordBatch.from_arrays([pa.array([0 if table is None else table.num_rows], pa.int64())], names=["n"])

    in_tasks(rows.repartitionById(parts, "part"), write_part, "n bigint").agg(F.sum("n")).collect()


class IndexPart:
    """One index file, loaded."""

    def __init__(self, path: str, part: int):
        system, folder = file_system(path)
        with system.open_input_file(f"{folder}/index-{part:06d}.npz") as file:
            data = np.load(io.BytesIO(file.read()))
            self.fingerprint, self.shard, self.record, self.copies = (
                data[k] for k in ("fingerprint", "shard", "record", "copies")
            )
            ends = np.cumsum(data["sizes"])
            bits = np.unpackbits(data["bits"], count=int(ends[-1]) if len(ends) else 0).astype(bool)
            self.hashed = PerfectHash(np.split(bits, ends[:-1]) if len(ends) else [], data["rest"])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the keys that the store has, and their slots."""
        slots = self.hashed.slots(keys)
        there = np.flatnonzero(slots >= 0)
        there = there[self.fingerprint[slots[there]] == _mix(keys[there], LEVELS)]
        return there, slots[there]


def lookup(spark: SparkSession, store: Store, keys: DataFrame) -> DataFrame:
    """Records of the different ``doc_id`` in ``keys``, by the index: doc_id, shard, record.

    Keys that the store lacks give no row, a repeated doc_id one row per record.
    """
    sizes = np.array(store.records, np.int64)
    before = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def find(batches: Batches) -> Batches:
        index = None
        for batch in batches:
            if not batch.num_rows:
                continue
            index = index or IndexPart(store.path, batch.column(2)[0].as_py())
            there, slots = index.find(batch.column(1).to_numpy().view(np.uint64))
            copies, first = index.copies[slots], before[index.shard[slots]] + index.record[slots]
            for low in range(0, len(there), 1000):  # copies of a key may be many
                part = slice(low, low + 1000)
                yield from _expand(batch.column(0).take(pa.array(there[part])), first[part], copies[part], before)

    rows = keys.select(F.col("doc_id").cast("bigint")).distinct()
    rows = rows.select("doc_id", F.expr(KEY).alias("key"), _part(store.parts).alias("part"))
    return in_tasks(rows.repartitionById(store.parts, "part"), find, "doc_id bigint, shard int, record bigint")


def _expand(ids: pa.Array, first: np.ndarray, copies: np.ndarray, before: np.ndarray) -> Batches:
    steps = [np.arange(0, int(copies.max()), 100_000)] if len(copies) else []
    for low in (int(x) for s in steps for x in s):
        n = np.clip(copies - low, 0, 100_000)
        which = np.repeat(np.arange(len(n)), n)
        number = first[which] + low + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        shard = np.searchsorted(before, number, "right") - 1
        columns = [ids.take(pa.array(which)), pa.array(shard.astype(np.int32)), pa.array(number - before[shard])]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "shard", "record"])


def read_records(spark: SparkSession, store: Store, located: DataFrame) -> DataFrame:
    """Read records from the shards: doc_id, start, n_tokens, ids (binary, four bytes an id)."""

    def read(batches: Batches) -> Batches:
        system, folder = file_system(store.path)
        shard, file, offsets = -1, None, np.zeros(1, np.int64)
        for batch in batches:
            start, count, payload = [], [], []
            for s, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if s != shard:
                    shard, file = s, system.open_input_file(f"{folder}/shard-{s:06d}.ids")
                    file.seek(file.size() - 8)
                    n = int.from_bytes(file.read(8), "little")
                    file.seek(file.size() - 8 * (n + 1))
                    offsets = np.frombuffer(file.read(8 * n), "<i8")
                    file.seek(0)
                low, high = int(offsets[r]), int(offsets[r + 1])
                if file.tell() != low:
                    file.seek(low)
                ids = np.frombuffer(file.read(high - low), f"<u{store.width}")
                start.append(store.first_token[s] + low // store.width)
                count.append(len(ids))
                payload.append(ids.astype("<u4").tobytes())
            columns = [batch.column(0), pa.array(start, pa.int64()), pa.array(count, pa.int64()), pa.array(payload, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    near = located.repartition(shuffle_partitions(spark), "shard").sortWithinPartitions("shard", "record")
    return in_tasks(near, read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


