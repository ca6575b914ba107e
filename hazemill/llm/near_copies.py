"""Near copies: texts whose sets of word shingles have a Jaccard similarity of at least 0.8, all of them.

SimHash blocks come first, as in ``simhash``: sets whose fingerprints differ in few bits meet under a
pair of blocks, and the links that the exact similarity confirms join most near copies. Similar sets
may differ in more bits than blocks can bring together, so an exact way adds what is left, between
sets that are not joined yet.

Equal sets are one node. A set's shingles are put in one order for all, by hash, those that a
sample finds often last. Two sets that are similar enough share a shingle among the first
``n - ceil(0.8 n) + 1`` of each, so every such pair meets in the run of a shingle (prefix
filter). Most shingles of prefixes occur once: one shuffle of 16 bytes a shingle brings equal ones
together, and only runs of two or more leave it. Sizes, places in the order and sketches are looked
up for those alone and rule out most pairs. A pair counts in the run of its first common shingle:
what comes before in either set is not common, which bounds what can be. A sketch counts the
shingles that fall on each of 256 places, modulo 16, so two sketches differ by no more than the sets
do. What is left is compared by longer sketches, of four to eight parities a shingle, in the same way, and
the pairs that pass are verified on the whole sets, which are made again from the texts of their
documents; sets are never stored. No similar pair is left out, whatever the order; the sample only keeps runs small.

These pairs are verified in two passes: first each run's rows with one hub of it and the closest of the
next ``NEXT_ROWS``, which joins large groups of near copies by few pairs, then all pairs whose nodes
are not joined yet. Shingles that the
sample finds often are dealt over many tasks; runs beyond
``BLOCK_ROWS`` are split into blocks, and each pair of blocks is its own run. Many sets that share
a shingle of their prefixes and are of like size, but not similar, are still compared in pairs.

Nulls are empty texts; texts without words have one set, and a text of fewer words than a shingle
has one shingle; texts are read whole, and one's set is held while it is worked on, however long; repeated
rows share a set, and of rows with one doc_id and text the one whose other columns are first as JSON text stays; extra
columns are carried; an empty table gives an empty result. Shingles are named by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.llm import simhash
from hazemill.llm.common import Batches, components, in_tasks, key_filter, stored
from hazemill.llm.simhash import SEED, row_key, shingle_hashes

WORDS_PER_SHINGLE = 5
#: Least similarity as a fraction.
PART, WHOLE = 4, 5
#: Sets whose shingles are counted for the order (at least, and one of so many), how many of them make a shingle
#: frequent, and how many shingles are.
SAMPLE_SETS, ONE_OF, FREQUENT, MOST_FREQUENT = 20_000, 4, 3, 1_000_000
BLOCK_ROWS, SALTS = 4096, 64
#: Rows of a run among which the first pass looks for a row's closest one.
NEXT_ROWS = 64
#: Places of a sketch; two counts are a byte.
PLACES = 256
SKETCH = ["sketch"]
SIGNED = "none boolean, doc_id bigint, key bigint, node bigint, n int, fp bigint, long binary, sketch binary"
#: Low bits of a prefix row's name: whether the shingle is frequent, and its place; higher bits are the shingle's.
PLACE_BITS = 15
MOST_PLACE = (1 << PLACE_BITS) - 1


def shingles(text: bytes | None) -> np.ndarray:
    """Different shingles of a text, sorted."""
    return _different(shingle_hashes(text, WORDS_PER_SHINGLE))


def _different(hashes: list[int]) -> np.ndarray:
    return np.unique(np.array(hashes, np.uint64))


def similar(common: np.ndarray | int, sizes: np.ndarray | int) -> np.ndarray | bool:
    """Whether sets of ``sizes`` shingles together, ``common`` shared ones counted twice, are similar enough."""
    return (PART + WHOLE) * common >= PART * sizes


def sketch(held: np.ndarray) -> bytes:
    """How many shingles fall on each place, modulo 16."""
    counts = np.bincount((held % np.uint64(PLACES)).astype(np.int64), minlength=PLACES).astype(np.uint8)
    return (counts[::2] << 4 | counts[1::2] & 15).tobytes()


def sketches_apart(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Least number of shingles in which a set with a sketch can differ from sets with others (rows of bytes)."""
    high, low = ((others >> 4) - (one >> 4)) & 15, (others - one) & 15
    return sum(np.minimum(x, 16 - x).sum(axis=1, dtype=np.int64) for x in (high, low))


def long_sketch(held: np.ndarray) -> bytes:
    """Parities of four to eight bits a shingle, a power of two of them."""
    bits = max(256, 1 << (4 * len(held)).bit_length())
    odd = np.bincount((held & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def bits_apart(one: bytes, two: bytes) -> int:
    """Bits in which two long sketches differ, the longer one folded to the other's length."""
    a, b = sorted((np.frombuffer(x, np.uint8) for x in (one, two)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _node(body: bytes) -> int:
    return xxhash.xxh64_intdigest(body, SEED)


def _signatures(documents: DataFrame) -> DataFrame:
    """node, first (the row of least doc_id, null last), n, fingerprint and sketches of each different set."""

    def read(batches: Batches) -> Batches:
        for batch in batches:
            held, fps = [], []
            for text in batch.column(2).to_pylist():
                hashes = shingle_hashes(text, WORDS_PER_SHINGLE)
                held.append(_different(hashes))
                fps.append(simhash.fingerprint_of(hashes))
            node = np.array([_node(h.tobytes()) for h in held], np.uint64).view(np.int64)
            columns = [batch.column(0).is_null(), *batch.columns[:2], pa.array(node), pa.array([len(h) for h in held], pa.int32()), pa.array(fps, pa.int64())]
            columns += [pa.array([f(h) for h in held], pa.binary()) for f in (long_sketch, sketch)]
            yield pa.RecordBatch.from_arrays(columns, names=["none", "doc_id", "key", "node", "n", "fp", "long", *SKETCH])

    rows = in_tasks(_texts(documents), read, SIGNED)
    first = F.min(F.struct("none", "doc_id", "key")).alias("first")
    return stored(rows.groupBy("node").agg(first, F.min("fp").alias("fp"), *(F.any_value(c).alias(c) for c in ("n", "long", *SKETCH))), "signatures")


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint"), row_key(), F.col("text").cast("binary"))


def _frequent(documents: DataFrame, total: int) -> np.ndarray:
    """Shingles that a sample of texts finds often, sorted.

    The sample grows with the table, so that how many documents a frequent shingle has does not.
    """
    share = min(1.0, max(SAMPLE_SETS, total / ONE_OF) / max(total, 1))
    sample = documents.select(F.col("text").cast("binary")).sample(share, 11)

    def read(batches: Batches) -> Batches:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text).view(np.int64))], names=["shingle"])

    counts = in_tasks(sample, read, "shingle bigint").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    often = counts.filter(F.col("n") >= FREQUENT).orderBy(F.col("n").desc(), "shingle").limit(MOST_FREQUENT)
    found = often.select("shingle").toArrow().column(0).to_numpy()
    return np.sort(found.view(np.uint64))


def _prefixes(documents: DataFrame, often: np.ndarray) -> DataFrame:
    """(name, node) for each shingle of the prefix of each set; a task gives a set once."""
    shared = documents.sparkSession.sparkContext.broadcast(often)

    def read(batches: Batches) -> Batches:
        often, seen = shared.value, set()
        for batch in batches:
            names, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for text in batch.column(0).to_pylist():
                held = shingles(text)
                if not len(held) or (node := _node(held.tobytes())) in seen:
                    continue
                seen.add(node)
                last = np.zeros(len(held), bool)
                if len(often):
                    last = often[np.minimum(np.searchsorted(often, held), len(often) - 1)] == held
                size = len(held) + 1 - -(-PART * len(held) // WHOLE)
                prefix = np.concatenate([held[~last], held[last]])[:size]
                place = np.minimum(np.arange(size, dtype=np.uint64), np.uint64(MOST_PLACE))
                flag = np.arange(size) >= len(held) - int(last.sum())
                low = np.uint64(PLACE_BITS + 1)
                names.append(prefix >> low << low | flag.astype(np.uint64) << np.uint64(PLACE_BITS) | place)
                nodes.append(np.full(size, node, np.uint64))
            columns = [pa.array(np.concatenate(c).view(np.int64)) for c in (names, nodes)]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "node"])

    return in_tasks(documents.select(F.col("text").cast("binary")), read, "name bigint, node bigint")


def _shared(prefixes: DataFrame) -> DataFrame:
    """(shingle, node, place) of the shingles that two prefixes have or that are frequent."""

    def read(batches: Batches) -> Batches:
        held = [np.zeros(0, np.int64)] * 2
        for batch in _and_end(batches):
            if batch is not None:
                held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True)]
            name, node = held
            if not len(name):
                continue
            shingle = name >> (PLACE_BITS + 1)
            edge = len(name) if batch is None else int(np.searchsorted(shingle, shingle[-1]))
            held = [c[edge:] for c in held]
            name, node, shingle = name[:edge], node[:edge], shingle[:edge]
            if not edge:
                continue
            other = np.concatenate([[True], (name[1:] != name[:-1]) | (node[1:] != node[:-1])])  # copies from several tasks
            name, node, shingle = name[other], node[other], shingle[other]
            same = shingle[1:] == shingle[:-1]
            keep = np.concatenate([[False], same]) | np.concatenate([same, [False]]) | (name >> PLACE_BITS & 1).astype(bool)
            columns = [pa.array(shingle[keep]), pa.array(node[keep]), pa.array((name[keep] & MOST_PLACE).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["shingle", "node", "place"])

    shingle = F.shiftright("name", PLACE_BITS + 1)
    salt = F.when(F.shiftright("name", PLACE_BITS).bitwiseAND(F.lit(1)) == 1, F.pmod("node", F.lit(SALTS))).otherwise(F.lit(-1))
    dealt = prefixes.repartition(F.xxhash64(shingle, salt)).sortWithinPartitions("name", "node")
    return stored(in_tasks(dealt, read, "shingle bigint, node bigint, place int"), "shared_shingles")


def _runs(shared: DataFrame, signatures: DataFrame) -> DataFrame:
    """(shingle, pair, node, n, place, sketch): runs of two rows or more, the large ones by pairs of blocks."""
    sizes = shared.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    large = stored(sizes.filter(F.col("rows") > BLOCK_ROWS), "large_runs")
    blocks = F.expr(f"cast(coalesce((rows + {BLOCK_ROWS - 1}) div {BLOCK_ROWS}, 1) as bigint)")
    placed = shared.join(large, "shingle", "left").withColumn("blocks", blocks).withColumn("block", F.expr("pmod(xxhash64(node), blocks)"))
    pairs = F.expr("transform(sequence(0L, blocks - 1), j -> least(j, block) * blocks + greatest(j, block))")
    placed = placed.select("shingle", F.explode(pairs).alias("pair"), "node", "place")
    return stored(placed.join(signatures.select("node", "n", *SKETCH), "node"), "prefix_runs")


def _candidates(run: list[np.ndarray], few: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a run, of different roots, that sizes, places and sketches allow: all, or a few for each row."""
    node, n, place, root, bits = run
    left, right = [], []
    rest = n - np.where(place < MOST_PLACE, place, 0)  # the run's shingle and those after it
    for at in range(len(node) - 1):
        end = at + 1 + NEXT_ROWS if few and at else len(node)
        other = at + 1 + np.flatnonzero(similar(np.minimum(rest[at], rest[at + 1 : end]), n[at] + n[at + 1 : end]) & (root[at + 1 : end] != root[at]))
        apart = sketches_apart(bits[at], bits[other])
        near = (PART + WHOLE) * apart <= (WHOLE - PART) * (n[at] + n[other])
        if few and at and near.any():
            near = [np.argmin(np.where(near, apart, np.iinfo(np.int64).max))]
        right.append(node[other[near]])
        left.append(np.full(len(right[-1]), node[at]))
    return np.concatenate(left), np.concatenate(right)


def _pairs(runs: DataFrame, links: DataFrame, few: bool) -> DataFrame:
    """Different candidate pairs (a, b), a < b, of the runs, between nodes that ``links`` do not join."""
    runs = runs.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))

    def read(batches: Batches) -> Batches:
        held = [*[np.zeros(0, np.int64)] * 6, np.zeros((0, PLACES // 2), np.uint8)]
        for batch in _and_end(batches):
            if batch is not None:
                columns = [c.to_numpy().astype(np.int64) for c in batch.columns[:6]]
                columns.append(np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint8).reshape(batch.num_rows, -1))
                held = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
            if not len(held[0]):
                continue
            new = np.flatnonzero(np.concatenate([[True], (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])]))
            edges = np.append(new, len(held[0])) if batch is None else new
            found = [(np.zeros(0, np.int64),) * 2]
            waiting = 0
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if high - low > 1:
                    found.append(_candidates([c[low:high] for c in held[2:]], few))
                    waiting += len(found[-1][0])
                if waiting > 1 << 18:
                    yield _unique(found)
                    found, waiting = [(np.zeros(0, np.int64),) * 2], 0
            yield _unique(found)
            held = [c[edges[-1] :] for c in held]

    order = ["shingle", "pair", "node"]
    sorted_ = runs.select(*order, "n", "place", "root", *SKETCH).repartition("shingle", "pair").sortWithinPartitions(*order)
    return in_tasks(sorted_, read, "a bigint, b bigint").distinct()


def _and_end(batches: Batches):
    yield from batches
    yield None


def _unique(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
    return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new])], names=["a", "b"])


def _of_ends(pairs: DataFrame, table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``pairs`` with ``columns`` of ``table`` for both nodes, as a_… and b_…."""
    for end in ("a", "b"):
        own = table.select(F.col("node").alias(end), *(F.col(c).alias(f"{end}_{c}") for c in columns))
        pairs = pairs.join(own, end)
    return pairs


def _not_apart(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs whose long sketches allow them to be similar."""

    def read(batches: Batches) -> Batches:
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            apart = [bits_apart(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5), strict=True)]
            near = (PART + WHOLE) * np.array(apart, np.int64) <= (WHOLE - PART) * sizes.astype(np.int64)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(near))

    joined = _of_ends(pairs, signatures, ("n", "long")).select("a", "b", "a_n", "b_n", "a_long", "b_long")
    return stored(in_tasks(joined, read, "a bigint, b bigint"), "pairs")


def _bodies(documents: DataFrame, keys: DataFrame) -> DataFrame:
    """key and body (its shingles) of the rows of ``keys``, and of a few others: a filter of bits picks them."""
    passes = key_filter(keys)

    def read(batches: Batches) -> Batches:
        seen: set[int] = set()
        for batch in batches:
            some = batch.filter(pa.array(passes(batch.column(1).to_numpy()))) if passes else batch.slice(0, 0)
            new = []
            for key in some.column(1).to_pylist():  # rows repeated as a whole have one key
                new.append(key not in seen)
                seen.add(key)
            some = some.filter(pa.array(new, pa.bool_()))
            for low in range(0, some.num_rows, 100):
                bodies = [shingles(t).tobytes() for t in some.column(2).slice(low, 100).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(1).slice(low, 100), pa.array(bodies, pa.binary())], names=["key", "body"])

    return in_tasks(_texts(documents), read, "key bigint, body binary")


def _verified(pairs: DataFrame, documents: DataFrame, signatures: DataFrame, name: str) -> DataFrame:
    """The pairs whose whole sets are similar enough."""

    def read(batches: Batches) -> Batches:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                both = np.sort(np.frombuffer(x.as_py() + y.as_py(), np.uint64))
                keep.append(bool(similar(int((both[1:] == both[:-1]).sum()), len(both))))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    firsts = signatures.select("node", "first.key")
    keyed = stored(_of_ends(_not_apart(pairs, signatures), firsts, ("key",)), "keyed_pairs")
    keys = keyed.select(F.col("a_key").alias("key")).union(keyed.select("b_key")).distinct()
    bodies = _bodies(documents, keys)
    of_a = bodies.select(F.col("key").alias("a_key"), F.col("body").alias("x"))
    of_b = bodies.select(F.col("key").alias("b_key"), F.col("body").alias("y"))
    joined = keyed.join(of_a, "a_key").join(of_b, "b_key").select("a", "b", "x", "y")
    return stored(in_tasks(joined, read, "a bigint, b bigint").distinct(), name)


def _by_fingerprint(signatures: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of nodes that SimHash blocks link: of one fingerprint, or of two that differ in few bits."""
    firsts = stored(signatures.groupBy("fp").agg(F.min("node").alias("node")), "fingerprints")
    equal = signatures.select("fp", F.col("node").alias("b")).join(firsts, "fp").select(F.col("node").alias("a"), "b")
    near = simhash.near_links(firsts.select("fp")).distinct()
    for end in ("a", "b"):
        near = near.join(firsts.select(F.col("fp").alias(end), F.col("node").alias(f"{end}_node")), end)
    near = near.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))
    return equal.union(near).filter("a <> b").distinct()


def near_links(documents: DataFrame, signatures: DataFrame) -> DataFrame:
    """Links (a, b) that join all different sets that are similar enough, transitively."""
    links = _verified(_by_fingerprint(signatures), documents, signatures, "hash_links")
    often = _frequent(documents, signatures.count())
    runs = _runs(_shared(_prefixes(documents, often)), signatures)
    for few, name in ((True, "few_links"), (False, "other_links")):
        links = links.union(_verified(_pairs(runs, links, few), documents, signatures, name))
    return links


def keep_one(documents: DataFrame) -> DataFrame:
    """The row of the smallest doc_id of each group of near copies (null last), with all its columns."""
    signatures = _signatures(documents)
    roots = components(near_links(documents, signatures))
    rooted = signatures.select("node", "first").join(roots, "node", "left")
    chosen = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first")).select("first.key").distinct()
    others = [c for c in documents.columns if c not in ("doc_id", "text")]
    rest = F.to_json(F.struct(F.lit(0).alias("_"), *others)).alias("rest")
    rows = documents.select(F.struct("*").alias("row"), row_key(), rest).join(chosen, "key", "left_semi")
    # Rows of one doc_id and text have one key.
    return rows.groupBy("key").agg(F.min_by("row", "rest").alias("row")).select("row.*")
