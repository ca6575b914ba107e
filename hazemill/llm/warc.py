"""WARC archives: a deterministic sharded writer, and its reader.

Pages are sorted by page_id over the cluster and written shard by shard. Shard edges come from
the data alone: of the rows whose key's hash falls on zero, cut by payload bytes, so that the same
table gives the same files however it is partitioned. Within a shard files are rolled
when the next record would take their compressed size beyond ``file_bytes``. Each record is a gzip
member of its own; its headers are made anew, with digests of block and payload.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest page_id is a
response, the others are revisits without the payload: they name the response and keep payload digest
and length. Payloads are named by SHA-1 and length; these names alone are grouped and joined, the payloads move once, to their shards.

Commit: a file is written under a temporary name and renamed when it is whole; a task that runs
again replaces it by its equal. The manifest, a row per file, is written last, under a temporary
name too, and renamed. Readers open the files of the manifest and no others.

Null payloads are empty; null urls have no target URI, and characters that would break a header
are percent-encoded; rows without a page_id come last; rows with one page_id are ordered by the
hash of url and payload, and of rows repeated as a whole one is the response; a record is held
whole, however long; extra columns are ignored; an empty table gives an archive without files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.llm.common import Batches, file_system, in_tasks, part_bytes, stored

#: Compressed bytes of a file.
FILE_BYTES = 256 << 20
#: Rows that set the edges, for each shard.
SAMPLED = 64
#: Bytes read from a file at once, payload bytes of a batch.
CHUNK, BATCH_BYTES = 1 << 20, 4 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"
KEY = "page_id bigint, hash bigint"
ROW = f"{KEY}, decision boolean, url string, payload binary, first_id bigint, first_hash bigint"
MANIFEST = "shard int, sequence int, file string, records bigint, bytes bigint, sha256 string"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


@dataclass(frozen=True)
class Record:
    page_id: int | None
    url: str | None
    record_type: str
    refers_to: int | None
    payload_digest: str
    payload_bytes: int
    payload: bytes | None

    def to_bytes(self, copy: int, date: str) -> bytes:
        """The uncompressed record; ``copy`` tells records of one page_id apart."""
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {self.payload_bytes}\r\n\r\n".encode()
        block = http + (self.payload or b"")
        headers = [
            ("WARC-Type", self.record_type),
            ("WARC-Record-ID", f"<{_name(self.page_id)}{f':{copy}' if copy else ''}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", None if self.url is None else re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m[0]):02X}", self.url)),
            ("WARC-Payload-Digest", f"sha1:{self.payload_digest}"),
            ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
            ("WARC-Profile", PROFILE if self.record_type == REVISIT else None),
            ("WARC-Refers-To", f"<{_name(self.refers_to)}>" if self.record_type == REVISIT else None),
            ("Content-Type", "application/http;msgtype=response"),
            ("Content-Length", str(len(block))),
        ]
        head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
        return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"

    @staticmethod
    def from_bytes(data: bytes) -> Record | None:
        """The record read from ``data``, its digests verified; None for records of other types."""
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines)
        block = rest[: int(headers["Content-Length"])]
        if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
            raise ValueError(f"broken record {headers.get('WARC-Record-ID')}")
        if headers["WARC-Type"] not in (RESPONSE, REVISIT):
            return None
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        if headers["WARC-Block-Digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
            raise ValueError(f"block digest of {headers['WARC-Record-ID']}")
        whole = headers["WARC-Type"] == RESPONSE
        if whole:
            if (len(payload), base32(hashlib.sha1(payload).digest())) != (size, digest):
                raise ValueError(f"payload digest of {headers['WARC-Record-ID']}")
        refers_to = None if whole else _page_id(headers["WARC-Refers-To"])
        return Record(_page_id(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), headers["WARC-Type"], refers_to, digest, size, payload if whole else None)


def _name(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def _page_id(name: str) -> int | None:
    number = name.strip("<>").split(":")[2]
    return None if number == "none" else int(number)


class ShardWriter:
    """Files of one shard, rolled by compressed size; ``manifest`` has a row per finished file."""

    def __init__(self, folder: str, shard: int, file_bytes: int, date: str):
        self.system, self.path = file_system(folder)
        self.system.create_dir(self.path, recursive=True)
        self.shard, self.file_bytes, self.date = shard, file_bytes, date
        self.manifest: list[tuple] = []
        self.out = None

    def add(self, record: Record, copy: int) -> None:
        self._put(record.to_bytes(copy, self.date))
        self.records += 1

    def _put(self, data: bytes) -> None:
        pack = zlib.compressobj(wbits=31)  # gzip, without a time of its own
        member = pack.compress(data) + pack.flush()
        if self.out is not None and self.records and self.size + len(member) > self.file_bytes:
            self.finish()
        if self.out is None:
            self.name = f"pages-{self.shard:06d}-{len(self.manifest):05d}.warc.gz"
            self.draft = f"{self.path}/.{self.name}-{uuid.uuid4().hex}"
            self.out, self.hash, self.size, self.records = self.system.open_output_stream(self.draft), hashlib.sha256(), 0, 0
            info = f"software: hazemill\r\nshard: {self.shard}\r\nformat: WARC File Format 1.1\r\n".encode()
            head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{self.name}>\r\nWARC-Date: {self.date}\r\nWARC-Filename: {self.name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
            self._put(head.encode() + info + b"\r\n\r\n")
        self.out.write(member)
        self.hash.update(member)
        self.size += len(member)

    def finish(self) -> None:
        if self.out is not None:
            self.out.close()
            self.system.move(self.draft, f"{self.path}/{self.name}")
            self.manifest.append((self.shard, len(self.manifest), self.name, self.records, self.size, self.hash.hexdigest()))
            self.out = None


def _keyed(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    return rows.select("page_id", F.xxhash64("url", "digest").alias("hash"), "url", "payload", "digest", F.length("payload").alias("size"))


def _decisions(keyed: DataFrame, min_bytes: int) -> DataFrame:
    """The key of every record whose payload occurs again, and the key of the response."""
    light = keyed.filter(F.col("size") >= min_bytes).select("page_id", "hash", "digest", "size")
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "hash")).alias("first")
    again = light.groupBy("digest", "size").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = stored(again.select("digest", "size", F.col("first.page_id").alias("first_id"), F.col("first.hash").alias("first_hash")), "payloads")
    return light.join(again, ["digest", "size"]).select("page_id", "hash", "first_id", "first_hash")


def _edges(keyed: DataFrame) -> list[tuple[int, int]]:
    """Keys at which the shards after the first begin; at most ``SAMPLED`` rows a shard reach the driver."""
    n, total = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = -(-total // part_bytes(total)) if total else 1
    every = max(1, n // (SAMPLED * shards))
    chosen = F.expr(f"pmod(xxhash64(page_id, hash, 7), {every}) = 0")
    by_key = keyed.filter(chosen & F.col("page_id").isNotNull()).groupBy("page_id", "hash").agg(F.sum(F.col("size") + 1).alias("size"))
    sample = sorted((r["page_id"], r["hash"], r["size"]) for r in by_key.collect())
    before = np.cumsum([0, *(s[2] for s in sample)])
    cuts = np.unique(np.searchsorted(before, np.arange(1, shards) * before[-1] / shards)) if sample else []
    return [sample[i][:2] for i in cuts if 0 < i < len(sample)]


def _dealt(rows: DataFrame, edges: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with the shard of their key."""
    shared = rows.sparkSession.sparkContext.broadcast(edges)

    def deal(batches: Batches) -> Batches:
        ids, hashes = (np.array([e[i] for e in shared.value], np.int64) for i in (0, 1))
        for batch in batches:
            none = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            page, key = batch.column(0).fill_null(0).to_numpy(), batch.column(1).to_numpy()
            low, high = np.searchsorted(ids, page), np.searchsorted(ids, page, "right")
            shard = low.copy()
            for i in np.flatnonzero(high > low).tolist():  # edges within a page_id
                shard[i] += np.searchsorted(hashes[low[i] : high[i]], key[i], "right")
            shard[none] = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), *batch.columns], names=["shard", *names])

    names = rows.columns
    return in_tasks(rows, deal, f"shard int, {ROW}")


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES, date: str = DATE) -> str:
    """Write ``pages`` (page_id, url, html) as an archive into ``path``, a new folder in shared storage."""
    keyed = _keyed(pages)
    edges = _edges(keyed)
    no = lambda kind: F.lit(None).cast(kind)
    records = keyed.select("page_id", "hash", F.lit(False).alias("decision"), "url", "payload", no("bigint").alias("first_id"), no("bigint").alias("first_hash"))
    decided = _decisions(keyed, min_bytes).select("page_id", "hash", F.lit(True).alias("decision"), no("string").alias("url"), no("binary").alias("payload"), "first_id", "first_hash")
    order = [F.col("page_id").asc_nulls_last(), F.col("hash"), F.col("decision").desc()]
    dealt = _dealt(records.union(decided), edges).repartitionById(len(edges) + 1, "shard").sortWithinPartitions(*order)

    def write(batches: Batches) -> Batches:
        writer = decision = last = None
        copy = 0
        for batch in batches:
            for shard, page_id, key, decides, url, payload, first_id, first_hash in zip(*map(_cells, batch.columns), strict=True):
                if writer is None:
                    writer = ShardWriter(path, shard, file_bytes, date)
                if decides:
                    decision = (page_id, key, first_id, first_hash)
                    continue
                again = decision is not None and decision[:2] == (page_id, key)
                whole = not again or (decision[2:] == (page_id, key) and last != (page_id, key))
                copy = copy + 1 if last is not None and last[0] == page_id else 0
                last = (page_id, key)
                digest = base32(hashlib.sha1(payload).digest())
                writer.add(Record(page_id, url, RESPONSE if whole else REVISIT, None if whole else decision[2], digest, len(payload), payload if whole else None), copy)
        if writer is not None:
            writer.finish()
            columns = zip(*writer.manifest, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shard", "sequence", "file", "records", "bytes", "sha256"]).cast(_MANIFEST_TYPES)

    draft = f"{path}/.manifest-{uuid.uuid4().hex}"
    in_tasks(dealt, write, MANIFEST).write.parquet(draft)
    system, folder = file_system(path)
    system.move(f"{folder}/{draft.rpartition('/')[2]}", f"{folder}/manifest")
    return path


_MANIFEST_TYPES = pa.schema([("shard", pa.int32()), ("sequence", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def _cells(column: pa.Array) -> Iterator:
    """Values one by one: a batch's payloads are not copied all at once."""
    return (x.as_py() for x in column)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _members(file) -> Iterator[bytes]:
    """The gzip members of an open file, one at a time."""
    unpack, parts, data = zlib.decompressobj(31), [], file.read(CHUNK)
    while data:
        parts.append(unpack.decompress(data))
        data = unpack.unused_data if unpack.eof else b""
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []
        data = data or file.read(CHUNK)
    if parts:
        raise ValueError("the file ends within a record")


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All responses and revisits of an archive, read from the files of its manifest and verified."""

    def read(batches: Batches) -> Batches:
        system, folder = file_system(path)
        held: list[Record] = []
        size = 0

        def rows() -> pa.RecordBatch:
            columns = [pa.array([getattr(r, f.name) if payloads or f.name != "payload" else None for r in held], f.type) for f in _RECORD_TYPES]
            return pa.RecordBatch.from_arrays(columns, schema=_RECORD_TYPES)

        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen = 0
                with system.open_input_file(f"{folder}/{name}") as file:
                    for member in _members(file):
                        record = Record.from_bytes(member)
                        if record is None:
                            continue
                        seen += 1
                        held.append(record)
                        size += len(member)
                        if size > BATCH_BYTES:
                            yield rows()
                            held, size = [], 0
                if seen != records:
                    raise ValueError(f"{name} has {seen} records, its manifest {records}")
        yield rows()

    files = manifest(spark, path)
    count = files.count()
    spread = files.select("file", "records").repartitionByRange(max(1, count), "file")
    return in_tasks(spread, read, RECORD)


_RECORD_TYPES = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])


#: SHA-1 in base 32: five hexadecimal digits are four characters.
ORACLE = """
WITH named AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), written AS (
  SELECT page_id, strlen(html) AS payload_bytes, row_number() OVER (PARTITION BY html ORDER BY page_id) AS place,
    min(page_id) OVER (PARTITION BY html) AS first,
    list_transform(range(8), lambda g: list_reduce(list_transform(range(5), lambda d: strpos('0123456789abcdef', substr(hex, g * 5 + d + 1, 1)) - 1), lambda a, x: a * 16 + x)) AS groups
  FROM named
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(groups, lambda g: array_to_string(list_transform([32768, 1024, 32, 1],
    lambda w: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((g // w) % 32 AS INTEGER) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN first END AS refers_to
FROM written
"""
