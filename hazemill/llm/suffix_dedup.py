"""Removal of repeated byte strings with a sparse suffix array.

A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else.
Sorting all suffixes would move each byte ``length`` times. Here suffixes are sampled by
content: of every window of ``length`` bytes, the 32-byte gram of least hash is its anchor, so
equal windows have anchors at the same place, and consecutive windows of one anchor form a run.
A suffix's leading tokens are two 64-bit names: of what all windows of its run share, and of
all that they hold. Three rounds sort ever finer suffixes; each goes on with what is undecided:

1. runs (one per about 85 bytes): token 1 is the anchor's gram, token 2 the whole run;
2. blocks of up to 16 windows of the runs whose gram repeats but not the whole run;
3. single windows of blocks whose common part repeats but not the whole block.

In each round splitters from a sample range-partition the suffixes by their tokens, buckets
sort locally by multikey quicksort and compare neighbours. Equal suffixes meet in one bucket
unless a splitter falls on them twice; then the sample itself shows that they repeat, which
settles the comparison across the boundary, and they are dealt over all buckets it opens.
So no suffix, however frequent, lands in one task. A task holds its bucket: the number of buckets
follows from the bytes of text, so a bucket stays at some three million suffixes for any table.

Texts are bytes of UTF-8, matches stay within a document (documents of equal text match each
other). Nulls are empty; texts below ``length`` bytes are kept whole; repeated rows match each
other and each give a row; columns beyond doc_id and text are carried if asked for; an empty
table gives an empty result. Texts beyond ``CHUNK`` bytes are named in overlapping segments.
Names are 64 bits; a removal needs two independent ones to agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hazemill.llm.common import Batches, in_tasks, shuffle_partitions, stored

LENGTH, GRAM, BLOCK = 200, 32, 16
#: Bytes that are named at once; positions in a chunk take the low bits of a hash.
CHUNK_BITS = 18
CHUNK = 1 << CHUNK_BITS
#: Documents whose suffixes set the splitters, and suffixes of one document that count.
SAMPLE_DOCS, SAMPLE_EACH = 2000, 64
#: Bytes of text whose suffixes a bucket sorts, about: some three million.
BUCKET_BYTES = 256 << 20
SUFFIX = "bucket int, h1 bigint, h2 bigint, k0 bigint, k1 bigint, at int, n int, rel int"
FOUND = "k0 bigint, k1 bigint, at int, n int, rel int, state int"
#: States of a suffix: undecided, repeated, and repeated but also a partner for undecided ones.
UNDECIDED, REPEATED, PARTNER = 1, 2, 3
RESULT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
RESULT_TYPES = [LongType(), LongType(), LongType(), LongType(), StringType(), StringType()]

_random = np.random.default_rng(20240607)
_BYTES = _random.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _random.integers(0, 1 << 63, 32, np.uint64) * np.uint64(2) + np.uint64(1)
_R29, _R32 = np.uint64(29), np.uint64(32)


def _join(left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    """Name of two things side by side."""
    x = left * _ODD[step]
    x ^= x >> _R29
    x += right
    x *= _ODD[step + 1]
    x ^= x >> _R32
    return x


def names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the 32 and the 128 bytes from each position, by doubling."""
    name, size, of32 = _BYTES[data], 1, None
    while size < 128:
        name = _join(name[:-size], name[size:], size.bit_length())
        size *= 2
        of32 = name if size == GRAM else of32
    return of32, name


def _window(of128: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Name of the ``length`` (129 … 256) bytes at each position."""
    return _join(of128[at], of128[at + length - 128], 10)


@dataclass
class Spans:
    """Byte ranges side by side in one buffer: of ``source`` (a row), from its byte ``base`` on."""

    data: np.ndarray
    first: np.ndarray
    size: np.ndarray
    source: np.ndarray
    base: np.ndarray


def runs_of(spans: Spans, length: int) -> tuple[np.ndarray, ...]:
    """Round 1: (h1, h2, span, at, n, rel) of the runs of windows; rel is the anchor's place."""
    of32, of128 = names(spans.data)
    reach = length - GRAM + 1
    places = np.arange(len(of32), dtype=np.uint64)
    mask = np.uint64(CHUNK - 1)
    least, size = (of32 & ~mask) | places, 1
    while 2 * size <= reach:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if size < reach:
        least = np.minimum(least[: len(least) - reach + size], least[reach - size :])
    anchor = (least & mask).astype(np.int64)
    edge = np.zeros(len(anchor) + 1, np.int32)
    whole = spans.size >= length
    edge[spans.first[whole]] += 1
    edge[(spans.first + spans.size - length + 1)[whole]] -= 1
    inside = np.cumsum(edge[:-1]) > 0
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (inside[1:] & ~inside[:-1])])
    at = np.flatnonzero(new & inside)
    stop = np.flatnonzero(np.concatenate([new[1:] | (inside[:-1] & ~inside[1:]), [True]]) & inside)
    n, rel = stop - at + 1, anchor[at] - at
    h1 = of32[anchor[at]]
    h2 = _join(_window(of128, at, length), _window(of128, stop, length), 12)
    h2 = _join(h2, (n << 20 | rel).astype(np.uint64), 14)
    span = np.searchsorted(spans.first, at, "right") - 1
    return h1, h2, span, at - spans.first[span], n, rel


def blocks_of(spans: Spans, n: np.ndarray, rel: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Round 2: blocks of windows whose distance to the anchor is alike up to 16."""
    _, of128 = names(spans.data)
    low, high = rel - n + 1, rel
    each = high // BLOCK - low // BLOCK + 1
    span = np.repeat(np.arange(len(n)), each)
    block = np.arange(len(span)) - np.repeat(np.cumsum(each) - each, each) + (low // BLOCK)[span]
    nearest, farthest = np.maximum(block * BLOCK, low[span]), np.minimum(block * BLOCK + BLOCK - 1, high[span])
    anchor = spans.first[span] + rel[span]
    first, last, count = anchor - farthest, anchor - nearest, farthest - nearest + 1
    h1 = _join(_window(of128, anchor - block * BLOCK, length - BLOCK + 1), block.astype(np.uint64), 16)
    h2 = _join(_window(of128, first, length), _window(of128, last, length), 18)
    h2 = _join(h2, (count << 8 | (nearest - block * BLOCK)).astype(np.uint64), 20)
    return h1, h2, span, first - spans.first[span], count, np.zeros(len(span), np.int64)


def windows_of(spans: Spans, n: np.ndarray, rel: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Round 3: every window."""
    _, of128 = names(spans.data)
    span = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(span)) - np.repeat(np.cumsum(n) - n, n)
    place = spans.first[span] + at
    h1 = _window(of128, place, length)
    h2 = _join(_join(of128[place + length - 128], of128[place + (length - 128) // 2], 22), of128[place], 24)
    return h1, h2, span, at, np.ones(len(span), np.int64), np.zeros(len(span), np.int64)


def _chunks(parts: Iterator[tuple[int, int, bytes]]) -> Iterator[Spans]:
    """Gather (source, base, bytes) into buffers of about a chunk."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def spans() -> Spans:
        sizes = np.array([len(x[2]) for x in held], np.int64)
        data = np.frombuffer(b"".join(x[2] for x in held), np.uint8)
        return Spans(data, np.cumsum(sizes) - sizes, sizes, *(np.array([x[i] for x in held], np.int64) for i in (0, 1)))

    for part in parts:
        if held and size + len(part[2]) > CHUNK:
            yield spans()
            held, size = [], 0
        held.append(part)
        size += len(part[2])
    if held:
        yield spans()


def _segments(texts: list[bytes | None], length: int) -> Iterator[tuple[int, int, bytes]]:
    step = CHUNK - length + 1
    for i, text in enumerate(texts):
        for base in range(0, len(text or b"") - length + 1, step):
            yield i, base, text[base : base + CHUNK]


@dataclass(frozen=True)
class Splitters:
    """Sorted (token 1, token 2) that cut the suffixes into buckets."""

    h1: np.ndarray
    h2: np.ndarray

    @staticmethod
    def of(h1: np.ndarray, h2: np.ndarray, buckets: int) -> Splitters:
        order = np.lexsort((h2, h1))
        # Each sampled suffix is a splitter once at most: equal splitters are different suffixes.
        cuts = order[np.unique(np.arange(1, buckets) * len(order) // buckets)] if len(order) else order
        return Splitters(h1[cuts], h2[cuts])

    def repeated(self) -> tuple[set[int], set[tuple[int, int]]]:
        """Tokens, and pairs of tokens, on which two splitters fall: the sample holds them twice."""
        same1 = self.h1[1:] == self.h1[:-1]
        same2 = same1 & (self.h2[1:] == self.h2[:-1])
        pairs = zip(self.h1[1:][same2].tolist(), self.h2[1:][same2].tolist(), strict=True)
        return set(self.h1[1:][same1].tolist()), set(pairs)

    def buckets(self, h1: np.ndarray, h2: np.ndarray, tie: np.ndarray) -> np.ndarray:
        bucket, high = np.searchsorted(self.h1, h1, "left"), np.searchsorted(self.h1, h1, "right")
        for at in np.unique(bucket[high - bucket > 1]):
            rows = np.flatnonzero((bucket == at) & (high - bucket > 1))
            second = self.h2[at : int(high[rows[0]])]
            low, top = np.searchsorted(second, h2[rows], "left"), np.searchsorted(second, h2[rows], "right")
            bucket[rows] = at + low + np.where(top - low > 1, tie[rows] % np.maximum(top - low + 1, 1), 0)
        return bucket


def multikey_order(tokens: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their tokens: quicksort by the first, then only ties by the next."""
    order = np.argsort(tokens[0], kind="quicksort")
    new = np.concatenate([[True], tokens[0][order][1:] != tokens[0][order][:-1]])
    for token in tokens[1:]:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        rows, group = order[tied], np.cumsum(new)[tied]
        order[tied] = rows[np.lexsort((token[rows], group))]
        new = new | np.concatenate([[True], token[order][1:] != token[order][:-1]])
    return order


def _batch(columns: list[np.ndarray], schema: str) -> pa.RecordBatch:
    types = {"int": pa.int32(), "bigint": pa.int64()}
    fields = [c.split() for c in schema.split(", ")]
    arrays = [pa.array(np.ascontiguousarray(c).astype(types[t].to_pandas_dtype(), copy=False)) for c, (_, t) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[f for f, _ in fields])


def _compare(splitters: Splitters):
    """Sort a bucket, compare neighbours, and give the suffixes that repeat in part or whole."""
    hot1, hot2 = splitters.repeated()

    def compare(batches: Batches) -> Batches:
        held = [[c.to_numpy() for c in b.columns[1:]] for b in batches if b.num_rows]
        if not held:
            return
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        del held
        order = multikey_order(columns[:2])
        h1, h2 = columns[0][order], columns[1][order]
        new1 = np.concatenate([[True], h1[1:] != h1[:-1]])
        new2 = new1 | np.concatenate([[True], h2[1:] != h2[:-1]])
        some, whole = ~(new1 & np.append(new1[1:], True)), ~(new2 & np.append(new2[1:], True))
        at1 = np.flatnonzero(new1)
        mixed = np.repeat(h2[at1] != h2[np.append(at1[1:], len(h1)) - 1], np.diff(np.append(at1, len(h1))))
        if hot1:
            hot = np.isin(h1, np.array(list(hot1), h1.dtype))
            some, mixed = some | hot, mixed | hot
        if hot2:
            for i in np.flatnonzero(np.isin(h2, np.array([x[1] for x in hot2], h2.dtype)) & new2):
                if (int(h1[i]), int(h2[i])) in hot2:
                    whole |= (h1 == h1[i]) & (h2 == h2[i])
        state = np.where(whole, np.where(mixed & new2, PARTNER, REPEATED), np.where(some, UNDECIDED, 0))
        kept = np.flatnonzero(state)
        for low in range(0, len(kept), 100_000):
            part = kept[low : low + 100_000]
            yield _batch([*(c[order[part]] for c in columns[2:]), state[part]], FOUND)

    return compare


def _suffixes(spans: Spans, found: tuple[np.ndarray, ...], keys: list[np.ndarray], splitters: Splitters) -> pa.RecordBatch:
    h1, h2, span, at, n, rel = found
    h1, h2 = h1.view(np.int64), h2.view(np.int64)
    source, place = spans.source[span], at + spans.base[span]
    bucket = splitters.buckets(h1, h2, place + keys[1][source] % 1009)
    return _batch([bucket, h1, h2, keys[0][source], keys[1][source], place, n, rel], SUFFIX)


def _undecided(batches: Batches, length: int) -> Iterator[tuple]:
    """(keys, spans, n, rel) of the listed parts of texts; a batch has k0, k1, text and the list."""
    for batch in batches:
        names_ = batch.schema.names
        keys = [batch.column(names_.index(k)).to_numpy() for k in ("k0", "k1")]
        texts, lists = batch.column(names_.index("body")), batch.column(names_.index("found"))
        sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
        items = lists.flatten()
        at, n, rel = (items.field(f).to_numpy() for f in ("at", "n", "rel"))
        row = np.repeat(np.arange(len(sizes)), sizes)
        held = {}

        def parts(row=row, at=at, n=n, texts=texts, held=held):
            for i, (r, a, k) in enumerate(zip(row.tolist(), at.tolist(), n.tolist(), strict=True)):
                if held.get("row") != r:
                    held.update(row=r, text=texts[r].as_py())
                yield i, a, held["text"][a : a + k + length - 1]

        for spans in _chunks(parts()):
            item = spans.source
            yield keys, Spans(spans.data, spans.first, spans.size, row[item], spans.base), n[item].astype(np.int64), rel[item].astype(np.int64)


def _sampled(docs: DataFrame, length: int) -> tuple[int, list[Splitters]]:
    """The number of buckets, and splitters of the three rounds from the suffixes of a sample of documents
    that have any. The sample has some 32 suffixes a bucket; a bucket's size does not grow with the table."""
    spark = docs.sparkSession
    docs = docs.filter(F.length("body") >= length)
    total, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("body").cast("bigint")), F.lit(0))).first()
    buckets = max(shuffle_partitions(spark), -(-size // BUCKET_BYTES))
    wanted = max(SAMPLE_DOCS, buckets // 2)
    sample = docs.sample(min(1.0, wanted / max(total, 1)), 11).limit(2 * wanted)

    def read(batches: Batches) -> Batches:
        chosen = np.random.default_rng(5)
        for batch in batches:
            for spans in _chunks(_segments(batch.column(batch.schema.names.index("body")).to_pylist(), length)):
                h1, h2, span, at, n, rel = runs_of(spans, length)
                inner = Spans(spans.data, spans.first[span] + at, n, span, at)
                for stage, found in enumerate(((h1, h2, span), blocks_of(inner, n, rel, length), windows_of(inner, n, rel, length))):
                    some = min(len(found[0]), SAMPLE_EACH * len(spans.first))
                    pick = chosen.choice(len(found[0]), some, replace=False) if some else np.zeros(0, np.int64)
                    yield _batch([np.full(some, stage), *(x[pick].view(np.int64) for x in found[:2])], "stage int, h1 bigint, h2 bigint")

    table = in_tasks(sample, read, "stage int, h1 bigint, h2 bigint").toArrow()
    stage, h1, h2 = (table.column(i).to_numpy() for i in range(3))
    return buckets, [Splitters.of(h1[stage == i], h2[stage == i], buckets) for i in range(3)]


def _merged(at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges covered by the given ones."""
    order = np.argsort(at, kind="stable")
    at, end = at[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], at[1:] > end[:-1]])
    return at[new], end[np.append(np.flatnonzero(new)[1:], len(at)) - 1]


def remove_repeats(documents: DataFrame, length: int = LENGTH, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row doc_id, n_bytes, n_removed, n_spans, kept_sha256, ``kept`` and the ``carry`` columns.

    ``kept`` is the text that is left, without the bytes of characters that a cut has parted; the
    digest is of all bytes left. ``length`` may be 176 … 256. A text's key is its doc_id and its hash; rows with equal keys
    have equal text and equal results.
    """
    if not 160 + BLOCK <= length <= 256:
        raise ValueError("length must be between 176 and 256")
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    id_ = F.col("doc_id").cast("bigint")
    docs = documents.select(
        F.coalesce(id_, F.lit(0)).alias("k0"),
        F.xxhash64(F.coalesce(id_.cast("string"), F.lit("null")), body).alias("k1"),
        id_.alias("doc_id"),
        body.alias("body"),
        F.struct(F.lit(True).alias("_"), *(F.col(c) for c in carry)).alias("carried"),
    )
    buckets, splitters = _sampled(docs.select("body"), length)

    def runs(batches: Batches) -> Batches:
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in (0, 1)]
            for spans in _chunks(_segments(batch.column(2).to_pylist(), length)):
                yield _suffixes(spans, runs_of(spans, length), keys, splitters[0])

    def finer(cut, splitter: Splitters):
        def read(batches: Batches) -> Batches:
            for keys, spans, n, rel in _undecided(batches, length):
                yield _suffixes(spans, cut(spans, n, rel, length), keys, splitter)

        return read

    def sorted_(suffixes: DataFrame, splitter: Splitters) -> DataFrame:
        return in_tasks(suffixes.repartitionById(buckets, F.col("bucket")), _compare(splitter), FOUND)

    def by_text(found: DataFrame) -> DataFrame:
        item = F.struct("at", "n", "rel").alias("item")
        return found.groupBy("k0", "k1").agg(F.collect_set(item).alias("found"))

    keys = ["k0", "k1"]
    open_ = F.col("state").isin(UNDECIDED, PARTNER)
    first = stored(sorted_(in_tasks(docs.select("k0", "k1", "body"), runs, SUFFIX), splitters[0]), "runs")
    # From here on one plan: the rounds and the removal read the same shuffle of the texts.
    lists = docs.join(by_text(first.filter(open_)), keys)
    second = sorted_(in_tasks(lists, finer(blocks_of, splitters[1]), SUFFIX), splitters[1])
    lists = docs.join(by_text(second.filter(open_)), keys)
    third = sorted_(in_tasks(lists, finer(windows_of, splitters[2]), SUFFIX), splitters[2])
    repeated = first.union(second).union(third).filter(F.col("state") >= REPEATED)
    marked = docs.join(by_text(repeated), keys, "left")
    kind = marked.schema["carried"].dataType

    def remove(batches: Batches) -> Batches:
        for batch in batches:
            at_ = {c: i for i, c in enumerate(batch.schema.names)}
            lists = batch.column(at_["found"])
            items, offsets = lists.values, lists.offsets.to_numpy()
            at, n = items.field("at").to_numpy().astype(np.int64), items.field("n").to_numpy()
            rows = []
            for i, text in enumerate(batch.column(at_["body"]).to_pylist()):
                part = slice(int(offsets[i]), int(offsets[i + 1]))
                low, high = _merged(at[part], at[part] + n[part] + length - 1) if part.stop > part.start else ((), ())
                edges = [0, *(int(x) for pair in zip(low, high, strict=True) for x in pair), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(text), len(text) - len(kept), len(low), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array([r[j] for r in rows], t) for j, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(at_["doc_id"]), *columns, batch.column(at_["carried"])], names=[*RESULT, "carried"])

    schema = StructType([*(StructField(c, t) for c, t in zip(RESULT, RESULT_TYPES, strict=True)), StructField("carried", kind)])
    done = in_tasks(marked, remove, schema)
    return done.select(*RESULT, *(F.col("carried")[c].alias(c) for c in carry))
