"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint is cut into blocks, two at least more than the bits that may differ: six blocks of 10
or 11 bits for four bits. Two fingerprints that near agree on two blocks or more, so every such pair
meets under one of the 15 pairs of blocks; those that meet are verified by Hamming distance. With
six blocks a bucket has one of some two million fingerprints; larger tables are cut into seven,
eight or nine blocks, of which three, four or five agree, so that unlike fingerprints in a bucket
stay few. Any number of blocks gives the same links. Equal fingerprints are one node.
Buckets are sorted runs of a shuffle, not groups: most have one row. A bucket beyond
``BLOCK_ROWS`` is split into blocks, and each pair of blocks is its own run, so no task holds a
whole large bucket. A run gives at most the links of a spanning forest for large runs.

Nulls are empty texts; texts without words have fingerprint zero and link like any other;
repeated rows share a fingerprint and each give a row; a null doc_id is never a component's id
unless no other is there; extra columns are ignored; an empty table gives an empty result. Texts
are read whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemill.llm.common import Batches, components, in_tasks, stored

SEED, MAX_DISTANCE = 42, 4
#: Blocks beyond the bits that may differ, and fingerprints in a bucket by chance, about.
MORE_BLOCKS, BY_CHANCE = (2, 3, 4, 5), 8
#: Rows of a block of a large bucket; runs up to SMALL_RUN rows are compared at once.
BLOCK_ROWS, SMALL_RUN = 4096, 64


def shingle_hashes(text: bytes | None, words_per_shingle: int) -> list[int]:
    """Hashes of the word shingles of a UTF-8 text, A-Z in lower case; of all its words if they are fewer."""
    words = text.lower().split() if text else []
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= words_per_shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = len(words) - words_per_shingle + 1
    spans = zip(starts[:last].tolist(), ends[words_per_shingle - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in spans]


def fingerprint(text: bytes | None, words_per_shingle: int) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit number."""
    return fingerprint_of(shingle_hashes(text, words_per_shingle))


def fingerprint_of(hashes: list[int]) -> int:
    """SimHash of hashes, repeats included."""
    if not hashes:
        return 0
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[low : low + (1 << 16)], np.uint64)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def row_key() -> Column:
    """The same for rows of equal doc_id and text."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))).alias("key")


def fingerprints(documents: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """doc_id, key and fp (bigint) of every row, in the order and partitions of ``documents``."""

    def read(batches: Batches) -> Batches:
        for batch in batches:
            found = [fingerprint(t, words_per_shingle) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.int64())], names=["doc_id", "key", "fp"])

    rows = documents.select(F.col("doc_id").cast("bigint"), row_key(), F.col("text").cast("binary"))
    return in_tasks(rows, read, "doc_id bigint, key bigint, fp bigint")


def cut_blocks(nodes: int, max_distance: int) -> tuple[list[tuple[int, int]], int]:
    """(lowest bit, width) of each block, and how many agree: enough for ``nodes`` different fingerprints."""
    for agree in MORE_BLOCKS:
        count = max_distance + agree
        if nodes <= BY_CHANCE << (64 // count * agree) or agree == MORE_BLOCKS[-1]:
            edges = [64 * i // count for i in range(count + 1)]
            return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)], agree
    raise AssertionError


def _block(fp: Column, block: tuple[int, int]) -> Column:
    low, width = block
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def block_keys(fps: DataFrame, blocks: list[tuple[int, int]], agree: int) -> DataFrame:
    """(key, fp) for each choice of ``agree`` blocks of each different fingerprint."""
    keys = []
    for i, chosen in enumerate(combinations(blocks, agree)):
        bits = F.lit(i).cast("bigint")
        for block in chosen:
            bits = F.shiftleft(bits, block[1]).bitwiseOR(_block(F.col("fp"), block))
        keys.append(bits)
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def run_links(fp: np.ndarray, run: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal ``run`` (sorted); a spanning forest only in large runs.

    ``fp`` is unsigned: bits are counted in the absolute value.
    """
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    sizes = np.diff(np.append(starts, len(run)))
    left, right = [], []
    small = np.repeat(sizes <= SMALL_RUN, sizes)
    index, end = np.flatnonzero(small), np.repeat(starts + sizes, sizes)
    for step in range(1, SMALL_RUN):
        index = index[index + step < end[index]]
        if not len(index):
            break
        near = index[np.bitwise_count(fp[index] ^ fp[index + step]) <= max_distance]
        left.append(fp[near])
        right.append(fp[near + step])
    for low, size in zip(starts[sizes > SMALL_RUN], sizes[sizes > SMALL_RUN], strict=True):
        rest = fp[low : low + size]
        while len(rest) > 1:
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                at = front.pop()
                near = np.bitwise_count(rest ^ at) <= max_distance
                found, rest = rest[near], rest[~near]
                left.append(np.full(len(found), at))
                right.append(found)
                front += list(found)
    none = np.zeros(0, fp.dtype)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def near_links(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) that join all different fingerprints within ``max_distance``, transitively."""
    keys = block_keys(fps, *cut_blocks(fps.count(), max_distance))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    large = stored(sizes.filter(F.col("n") > BLOCK_ROWS), "large_buckets")
    # A row of a bucket of n blocks is in n pairs of blocks; any two rows of it share a pair.
    blocks = F.expr(f"cast(coalesce((n + {BLOCK_ROWS - 1}) div {BLOCK_ROWS}, 1) as bigint)")
    placed = keys.join(large, "key", "left").select("key", "fp", blocks.alias("blocks"))
    placed = placed.withColumn("block", F.expr("pmod(xxhash64(fp), blocks)"))
    pairs = F.expr("transform(sequence(0L, blocks - 1), j -> least(j, block) * blocks + greatest(j, block))")
    runs = placed.select("key", F.explode(pairs).alias("pair"), "fp")
    runs = runs.repartition("key", "pair").sortWithinPartitions("key", "pair")

    def verify(batches: Batches) -> Batches:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            columns = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True)]
            key, pair, fp = columns
            if not len(key):
                continue
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])])
            last = int(np.flatnonzero(new)[-1])
            held = [c[last:] for c in columns]
            yield _linked(fp[:last], np.cumsum(new)[:last], max_distance)
        yield _linked(held[2], np.zeros(len(held[2]), np.int64), max_distance)

    return in_tasks(runs, verify, "a bigint, b bigint")


def _linked(fp: np.ndarray, run: np.ndarray, max_distance: int) -> pa.RecordBatch:
    links = run_links(fp.view(np.uint64), run, max_distance) if len(fp) else (fp, fp)
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in links], names=["a", "b"])


def _rooted(fps: DataFrame, max_distance: int) -> DataFrame:
    """(fp, least, root) of the different fingerprints."""
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(near_links(nodes.select("fp"), max_distance))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left")
    return stored(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")


def simhash_components(documents: DataFrame, words_per_shingle: int = 4, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable."""
    fps = stored(fingerprints(documents, words_per_shingle), "fingerprints")
    rooted = _rooted(fps, max_distance)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(smallest, "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return fps.join(found, "fp").select("doc_id", digits, "component_id")
