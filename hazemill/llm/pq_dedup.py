"""Near-duplicate vectors by product quantisation.

Vectors are compared within a label only. Equal vectors are one node. A coarse quantiser assigns
each node to an inverted list; its residual is coded in subspaces of eight dimensions, one byte
each. A node is looked for in the lists nearest to it: tables of its inner products with the
codewords give its product with every stored code. How far a code misses its vector is stored
with it, so the table look-up dismisses no pair above the threshold that a probe meets; pairs
it lets through are checked by exact cosine in double precision.

The quantisers are fitted on at most ``MOST_TRAIN_ROWS`` nodes (16 a list, 20,000 at least); every node is indexed. Lists are cut
into blocks of ``BLOCK_ROWS`` stored nodes, each met by all queries of the list in a run of its
own, so no list lands in one task. A run gives link counts and a spanning forest, not pairs.

Vectors that are null, empty or zero, or that hold null or non-finite components, and vectors
without a label link with nothing; vectors of different length never link. Repeated rows
are copies that link with each other. A component's id is its smallest vec_id, null ids aside.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.llm.common import Batches, components, in_tasks, stored

THRESHOLD = 0.93
#: Vectors that the quantisers are fitted on, at least and at most, and for each list.
TRAIN_ROWS, MOST_TRAIN_ROWS, ROWS_PER_LIST, ROUNDS = 20_000, 500_000, 16, 8
SUBSPACE, CODES = 8, 256
#: Lists grow with the root of the nodes, so that a list and the work per node do.
PROBES, LISTS = 16, (8, 32_768)
BLOCK_ROWS, QUERY_ROWS = 2048, 256
LINK = "a bigint, b bigint, n bigint"


@dataclass(frozen=True)
class Quantiser:
    """``centres`` of the lists; ``words[s]`` are the codewords of subspace s. ``width`` is padded."""

    width: int
    centres: np.ndarray
    words: np.ndarray

    def padded(self, vectors: np.ndarray) -> np.ndarray:
        """Unit vectors, padded by zeros."""
        out = np.zeros((len(vectors), self.width))
        out[:, : vectors.shape[1]] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return out


def _means(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's k-means from a random start; a centre that loses its rows stays."""
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(ROUNDS):
        of = _nearest(rows, centres)
        counts = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, rows)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    parts = [np.argmax(rows[i : i + 4096] @ centres.T - half, axis=1) for i in range(0, len(rows), 4096)]
    return np.concatenate([np.zeros(0, np.int64), *parts])


def lists_for(nodes: int) -> int:
    return int(np.clip(nodes**0.5 / 2, *LISTS))


def fit(sample: np.ndarray, nodes: int) -> Quantiser:
    rng = np.random.default_rng(3)
    width = -(-sample.shape[1] // SUBSPACE) * SUBSPACE
    empty = Quantiser(width, np.zeros((1, width)), np.zeros((width // SUBSPACE, 1, SUBSPACE)))
    rows = empty.padded(sample)
    centres = _means(rows, lists_for(nodes), rng)
    rest = rows - centres[_nearest(rows, centres)]
    words = [_means(rest[:, i : i + SUBSPACE], CODES, rng) for i in range(0, width, SUBSPACE)]
    return Quantiser(width, centres, np.stack(words))


def fit_by_length(sample: list[list[float]], nodes: int) -> dict[int, Quantiser]:
    """A quantiser for each length of vectors in the sample; ``nodes`` are all vectors, of any length."""
    by_length: dict[int, list[list[float]]] = {}
    for vector in sample:
        by_length.setdefault(len(vector), []).append(vector)
    return {n: fit(np.array(rows, np.float64), nodes * len(rows) // len(sample)) for n, rows in by_length.items()}


def of_length(quantisers: dict[int, Quantiser], length: int) -> Quantiser:
    """The quantiser of a length; lengths too rare for the sample have one list, which is searched whole."""
    width = -(-length // SUBSPACE) * SUBSPACE
    return quantisers.get(length) or Quantiser(width, np.zeros((1, width)), np.zeros((width // SUBSPACE, 1, SUBSPACE)))


def _arrays(column: pa.Array, dtype=np.float32) -> np.ndarray:
    """Rows of equal length."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _entries(quantisers: dict[int, Quantiser]):
    """Code nodes: the list each belongs to, those it probes, its code and how far that misses."""

    def encode(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = _arrays(batch.column(2)).astype(np.float64)  # of one length, see below
            quantiser = of_length(quantisers, raw.shape[1])
            rows = quantiser.padded(raw)
            distance = (quantiser.centres**2).sum(axis=1) - 2 * rows @ quantiser.centres.T
            some = min(PROBES, distance.shape[1])
            probes = np.argpartition(distance, some - 1, axis=1)[:, :some]
            probes = np.take_along_axis(probes, np.argsort(np.take_along_axis(distance, probes, 1), axis=1), 1)
            home = probes[:, 0]
            rest = rows - quantiser.centres[home]
            cut = range(0, quantiser.width, SUBSPACE)
            code = np.stack([_nearest(rest[:, i : i + SUBSPACE], w) for i, w in zip(cut, quantiser.words, strict=True)], axis=1)
            coded = quantiser.centres[home] + np.concatenate([w[code[:, s]] for s, w in enumerate(quantiser.words)], axis=1)
            along = (coded * rows).sum(axis=1)
            across = np.sqrt(np.maximum((coded**2).sum(axis=1) - along**2, 0))
            # Least product of the code with any unit vector at the threshold or nearer.
            angle = np.minimum(np.arctan2(across, along) + np.arccos(THRESHOLD), np.pi)
            bound = np.hypot(along, across) * np.cos(angle) - 1e-9
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(home.astype(np.int32)),
                    pa.array(list(probes.astype(np.int32)), pa.list_(pa.int32())),
                    *batch.columns[2:4],
                    pa.array([c.tobytes() for c in code.astype(np.uint8)], pa.binary()),
                    pa.array(bound),
                ],
                names=["node", "label", "home", "probes", "vector", "copies", "code", "bound"],
            )

    return encode


CODED = "node bigint, label string, home int, probes array<int>, vector binary, copies bigint, code binary, bound double"


def _compare(quantisers: dict[int, Quantiser]):
    """Link the queries of a list with one block of its stored nodes, run by run."""

    def compare(batches: Batches) -> Batches:
        key, held = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                if keys[low] != key:
                    key, held = keys[low], None
                is_stored = np.array(part.column(3).to_pylist(), bool)
                first = int(is_stored.sum())  # stored nodes come first
                if first:
                    held = part.slice(0, first) if held is None else pa.concat_batches([held, part.slice(0, first)])
                for at in range(first, part.num_rows, QUERY_ROWS):
                    if held is not None:
                        yield from _links(quantisers, key[1], held, part.slice(at, min(QUERY_ROWS, part.num_rows - at)))

    return compare


def _links(quantisers: dict[int, Quantiser], list_: int, held: pa.RecordBatch, asked: pa.RecordBatch) -> Batches:
    queries, rows = _arrays(asked.column(8)).astype(np.float64), _arrays(held.column(8)).astype(np.float64)
    codes, bound = _arrays(held.column(9), np.uint8), held.column(10).to_numpy()
    quantiser = of_length(quantisers, queries.shape[1])
    unit = quantiser.padded(queries)
    near = np.repeat((unit @ quantiser.centres[list_])[:, None], len(codes), axis=1)
    for s, words in enumerate(quantiser.words):
        near += (unit[:, s * SUBSPACE : (s + 1) * SUBSPACE] @ words.T)[:, codes[:, s]]
    q, r = np.nonzero(near >= bound)
    q_node, r_node = asked.column(4).to_numpy(), held.column(4).to_numpy()
    home = asked.column(5).to_numpy()
    # A pair is met in the lists of both nodes: it counts in the lower, if the other node probes it.
    probes = held.column(6).flatten().to_numpy().reshape(len(r_node), -1)  # as many for each node
    both = np.concatenate([np.zeros(0, bool), *((probes[r[i : i + 65536]] == home[q[i : i + 65536], None]).any(axis=1) for i in range(0, len(q), 65536))])
    mine = np.where(home[q] == list_, q_node[q] < r_node[r], ~both | (list_ < home[q]))
    q, r = q[mine], r[mine]
    cosine = np.einsum("ij,ij->i", queries[q], rows[r]) / (np.linalg.norm(queries, axis=1)[q] * np.linalg.norm(rows, axis=1)[r])
    q, r = q[cosine >= THRESHOLD], r[cosine >= THRESHOLD]
    if not len(q):
        return
    q_copies, r_copies = asked.column(7).to_numpy(), held.column(7).to_numpy()
    counts = np.concatenate([np.bincount(q, r_copies[r], len(q_node)), np.bincount(r, q_copies[q], len(r_node))]).astype(np.int64)
    nodes = np.concatenate([q_node, r_node])
    root = _least(q, len(q_node) + r, nodes)
    linked = np.flatnonzero(counts)
    columns = [pa.array(x[linked]) for x in (nodes, nodes[root], counts)]
    yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])


def _least(left: np.ndarray, right: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For each place, the place of the smallest node that links (left, right) join it with."""
    order = np.argsort(nodes, kind="stable")
    rank = np.empty(len(nodes), np.int64)
    rank[order] = np.arange(len(nodes))
    while True:
        before = rank.copy()
        np.minimum.at(rank, left, rank[right])
        np.minimum.at(rank, right, rank[left])
        if np.array_equal(rank, before):
            return order[rank]


def link_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``embeddings`` (vec_id, embedding, label)."""
    vector, bad = F.col("embedding").cast("array<float>"), F.lit(float("inf"))
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x) < bad, F.lit(False))) & F.exists(vector, lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & sound, F.lit(False))
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.when(usable, F.col("label").cast("bigint")).alias("label"),
        F.when(usable, vector).alias("vector"),
    )
    classes = rows.filter("vector is not null").groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    total = classes.count()
    if not total:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    train = int(np.clip(ROWS_PER_LIST * lists_for(total), TRAIN_ROWS, MOST_TRAIN_ROWS))
    sample = classes.sample(min(1.0, train / total), 7).limit(train).select("vector").toArrow().column(0)
    if not len(sample):
        sample = classes.limit(train).select("vector").toArrow().column(0)
    quantisers = fit_by_length(sample.to_pylist(), total)

    def pack(batches: Batches) -> Batches:
        for batch in batches:
            packed = [np.array(v, np.float32).tobytes() for v in batch.column(2).to_pylist()]
            # Vectors of one batch that are shorter go in a batch of their own.
            sizes = np.array([len(p) for p in packed])
            for size in np.unique(sizes):
                at = pa.array(np.flatnonzero(sizes == size))
                columns = [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), batch.column(3)]
                yield pa.RecordBatch.from_arrays([c.take(at) for c in columns], names=["node", "label", "vector", "copies"])

    # Vectors of one label and length are compared.
    kind = F.concat_ws(":", F.col("label").cast("string"), F.size("vector").cast("string")).alias("label")
    nodes = classes.select("node", kind, "vector", "copies")
    both = lambda batches: _entries(quantisers)(pack(batches))
    coded = stored(in_tasks(nodes, both, CODED), "codes")
    # One row per label and list; Spark broadcasts it only below its threshold.
    sizes = stored(coded.groupBy("label", F.col("home").alias("list")).agg(F.count(F.lit(1)).alias("size")), "lists")
    blocks = sizes.select("label", "list", F.expr(f"cast((size + {BLOCK_ROWS - 1}) div {BLOCK_ROWS} as int)").alias("blocks"))
    rest = ["node", "home", "probes", "copies", "vector", "code", "bound"]
    kept = coded.withColumn("list", F.col("home")).join(blocks, ["label", "list"])
    kept = kept.select("label", "list", F.expr("cast(pmod(xxhash64(node), blocks) as int)").alias("block"), F.lit(True).alias("stored"), *rest)
    asked = coded.withColumn("list", F.explode("probes")).join(blocks, ["label", "list"])
    asked = asked.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    asked = asked.select("label", "list", "block", F.lit(False).alias("stored"), *rest)
    order = ["label", "list", "block", F.desc("stored")]
    runs = kept.union(asked).repartition("label", "list", "block").sortWithinPartitions(*order)
    links = stored(in_tasks(runs, _compare(quantisers), LINK), "vector_links")

    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    roots = components(links.select("a", "b"))
    found = classes.select("node", "least", "copies", "label", "vector").join(counts, "node", "left").join(roots, "node", "left")
    found = found.withColumn("root", F.coalesce("root", "node"))
    smallest = found.groupBy("root").agg(F.min("least").alias("component_id"))
    found = found.join(smallest, "root").select("label", "vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = rows.join(found, ["label", "vector"], "left")
    component = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
