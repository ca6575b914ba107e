"""Probabilistic suffix tree over words, and the unigram score beside it.

Symbols are a text's tokens: its words with A-Z in lower case, then one end. A context is the last
one to ``DEPTH`` tokens, a mark for the text's start among them; its suffix, one token shorter, is its
parent, and the root is the unigram distribution of the base score. With n the count of a context and n(x) that
of a symbol after it, both over all training texts, a distribution is smoothed by its parent's:

    P(x | s) = [n(x) >= MIN_SYMBOL] (n(x) - DISCOUNT) / n + rest(s) P(x | parent(s))

where rest is the mass that is left. A context with n >= ``MIN_CONTEXT`` is tested: how much better, in nats over
all its occurrences, it predicts each when that one is left out of its counts than the parent does (the divergence from the parent, without the
bias of few counts). It is retained from ``MIN_GAIN`` on, and then its suffixes are too. All limits are absolute
counts: what is learnt grows with the corpus. A text is scored from the longest retained context before each token.

The logarithm of P is a sum over the path from the root: the unigram's, then for each context that is a suffix
of the text so far log rest, and where the symbol is kept there the logarithm of its gain over that.
So the tree is stored as a table from names of contexts and of (context, symbol) pairs to numbers
that are added up. Its ``TOP`` most frequent names are broadcast, a filter of bits (``key_filter``)
says which others may exist, and these are looked up in buckets of names. Nothing else of the corpus
reaches the driver. Names are 64-bit hashes.

Grams and look-ups are shuffled as arrays, one per task and bucket, and added up there: a gram costs its
symbol and a share of its context. Buckets follow from the number of tokens; grams of a context with more than
``HOT`` occurrences are dealt over all of them. Intermediate tables and shuffles go as soon as they are read.

Null texts are empty (one end); a null doc_id counts as the empty text for the fold, so it
trains; repeated rows train and score each; extra columns are ignored; an empty table gives an
empty result. Long texts are read whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.llm.common import Batches, in_tasks, key_filter, shuffle_partitions, stored
from hazemill.llm.words import split_words
from hazemill.session import scratch, scratch_path

#: Counted grams a task holds before it passes them on.
HELD = 1 << 21
GRAMS = "context bigint, symbol bigint, n bigint"
#: Tokens per bucket of grams, and of look-ups; occurrences from which a context's grams are dealt over all buckets.
GRAM_TOKENS, LOOKUP_TOKENS, HOT = 1 << 21, 6 << 20, 1 << 18
#: Bytes of a batch of packed arrays; shuffle files of a finished query are removed at once, not when the driver next collects garbage.
SENT_BYTES = 4 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
START = np.uint64(0x5851F42D4C957F2D)
END = np.uint64(xxhash.xxh64_intdigest(b"", 0))
SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
#: What texts and buckets send each other: ``kind`` says whether data are names of the tree, look-ups or scores of texts.
SENT = "bucket int, source bigint, kind int, data binary"
NAMES, LOOKUPS, TEXTS = 0, 1, 2


@dataclass(frozen=True)
class Params:
    depth: int = 2
    min_context: int = 20
    min_symbol: int = 3
    discount: float = 0.75
    min_gain: float = 3.0
    #: Names that are broadcast, at most.
    top: int = 1_500_000
    folds: int = 7
    held_out_fold: int = 2


def mix(left: np.ndarray, right: np.ndarray | np.uint64) -> np.ndarray:
    """Name of a sequence from the name of its front and its last symbol."""
    with np.errstate(over="ignore"):
        x = (left ^ (left >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: Names of the empty context, of words and of (context, symbol) pairs come from different beginnings.
ROOT, WORD, PAIR = np.uint64(1), np.uint64(2), np.uint64(3)


def hashed(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w.encode(), 0) for w in words], np.uint64)


@dataclass(frozen=True)
class Tokens:
    """The symbols of a batch of texts side by side, each text after a start mark.

    ``kinds`` are the different symbols, ``code`` says which one stands at a place: what depends on
    one symbol alone is looked up once for each kind.
    """

    kinds: np.ndarray
    code: np.ndarray
    symbol: np.ndarray
    text: np.ndarray
    place: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> Tokens:
        lists = split_words(texts)
        encoded = lists.values.dictionary_encode()
        kinds = np.append(hashed(encoded.dictionary.to_pylist()), np.array([START, END], np.uint64))
        codes = encoded.indices.to_numpy()
        sizes = np.diff(lists.offsets.to_numpy())
        real = kinds[codes] != END  # a text without words has one empty word
        sizes = np.add.reduceat(np.append(real, False), lists.offsets.to_numpy()[:-1]) * (sizes > 0) if len(sizes) else sizes
        first = np.cumsum(sizes + 2) - (sizes + 2)
        code = np.full(int((sizes + 2).sum()), len(kinds), np.int64)
        code[first], code[first + sizes + 1] = len(kinds) - 2, len(kinds) - 1
        code[code == len(kinds)] = codes[real]
        text = np.repeat(np.arange(len(sizes)), sizes + 2)
        return Tokens(kinds, code, kinds[code], text, np.arange(len(code)) - first[text])

    def contexts(self, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each depth from 1 on: the places that have a context of it, and its name there."""
        name, result = np.full(len(self.symbol), ROOT), []
        for d in range(1, depth + 1):
            longer = np.zeros(len(name), np.uint64)
            longer[1:] = mix(name[:-1], self.symbol[:-1])
            name = longer
            at = np.flatnonzero(self.place >= d)
            result.append((at, name[at]))
        return result


def count_words(texts: DataFrame) -> DataFrame:
    """word ('' for the end), symbol (its hash) and n over all texts."""

    def count(batches: Batches) -> Batches:
        ends = 0
        for batch in batches:
            found = split_words(batch.column(0)).values.value_counts()
            found = found.filter(pc.not_equal(found.field("values"), ""))
            words = found.field("values").cast(pa.string())
            yield pa.RecordBatch.from_arrays([words, pa.array(hashed(words.to_pylist()).view(np.int64)), found.field("counts").cast(pa.int64())], names=["word", "symbol", "n"])
            ends += batch.num_rows
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([END]).view(pa.int64()), pa.array([ends])], names=["word", "symbol", "n"])

    counts = in_tasks(texts, count, "word string, symbol bigint, n bigint")
    return stored(counts.groupBy("word", "symbol").agg(F.sum("n").alias("n")), "words")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def bucket_of(name: np.ndarray, buckets: int) -> np.ndarray:
    bucket = ((name >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32)


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order that puts buckets side by side, and (bucket, from, to) of each that is there."""
    order = np.argsort(bucket, kind="stable")
    there, size = np.unique(bucket, return_counts=True)
    ends = np.cumsum(size)
    return order, list(zip(there.tolist(), (ends - size).tolist(), ends.tolist(), strict=True))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _summed(context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams by the first bits of their contexts, then mixed; a gram may rarely stay in two rows, which its bucket adds up."""
    low = np.uint64((1 << 28) - 1)
    key = mix(context, symbol)
    key &= low
    key |= context & ~low
    order = np.argsort(key)
    del key
    context, symbol, n = context[order], symbol[order], n[order]
    first = _runs(context, symbol)
    return context[first], symbol[first], np.add.reduceat(n, first, dtype=np.uint32) if len(first) else n


def _merged(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sum of what is held, which is let go."""
    columns = [np.concatenate(x) for x in zip(*held, strict=True)]
    held.clear()
    return _summed(*columns)


def _packed_grams(grams: tuple[np.ndarray, np.ndarray, np.ndarray], buckets: int, hot: np.ndarray) -> Batches:
    """Per bucket: numbers of rows and contexts, the contexts, their rows, symbols and counts."""
    context, symbol, n = grams
    frequent = np.isin(context, hot) if len(hot) else np.zeros(len(context), bool)
    if frequent.any():
        own = [x[frequent] for x in (context, symbol, n)]
        context, symbol, n = (x[~frequent] for x in (context, symbol, n))
        order, parts = by_bucket(bucket_of(mix(own[0], own[1]), buckets))
        yield from _gram_parts(parts, *(x[order] for x in own))
    # Contexts are sorted by their first bits, and so by bucket.
    order, parts = by_bucket(bucket_of(context, buckets))
    yield from _gram_parts(parts, context, symbol, n)


def _gram_parts(parts: list[tuple[int, int, int]], context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> Batches:
    def packed() -> Iterator[tuple[int, bytes]]:
        for bucket, low, high in parts:
            first = _runs(context[low:high])
            rows = np.diff(np.append(first, high - low)).astype(np.uint32)
            head = np.array([high - low, len(first)], np.uint32)
            yield bucket, b"".join(x.tobytes() for x in (head, context[low + first], rows, symbol[low:high], n[low:high]))

    yield from _in_batches(packed(), pa.schema([("bucket", pa.int32()), ("data", pa.binary())]))


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Batches:
    """Rows that end in bytes, in batches of about ``SENT_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size > SENT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _unpacked_grams(data: pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, contexts = (int(x) for x in np.frombuffer(data, np.uint32, 2))
    context = np.frombuffer(data, np.uint64, contexts, 8)
    each = np.frombuffer(data, np.uint32, contexts, 8 + 8 * contexts)
    symbol = np.frombuffer(data, np.uint64, rows, 8 + 12 * contexts)
    n = np.frombuffer(data, np.uint32, rows, 8 + 12 * contexts + 8 * rows)
    return np.repeat(context, each), symbol, n.astype(np.int64)


def pair_names(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mix(mix(context, symbol), PAIR)


def count_grams(texts: DataFrame, contexts: DataFrame, depth: int, min_symbol: int, possible: DataFrame, buckets: int) -> DataFrame:
    """context, symbol and n (``min_symbol`` or more) after each of ``contexts``, all of one depth.

    A symbol comes after a context no more often than after its suffix, and than at all: only what
    ``possible`` (key: names of symbols, deeper down of pairs of the suffix and a symbol) has is counted.
    """
    passes, may = key_filter(contexts.select(F.col("context").alias("key"))), key_filter(possible)
    often = contexts.filter(F.col("total") > HOT).select("context").toArrow().column(0).to_numpy().view(np.uint64)

    def count(batches: Batches) -> Batches:
        held = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint32))]
        for batch in batches:
            tokens = Tokens.of(batch.column(0))
            if depth == 1:
                of_kinds = mix(np.full(len(tokens.kinds), ROOT), tokens.kinds)
                at = np.flatnonzero(tokens.place > 0)
                at = at[passes(of_kinds.view(np.int64))[tokens.code[at - 1]] & may(tokens.kinds.view(np.int64))[tokens.code[at]]]
                name, symbol = of_kinds[tokens.code[at - 1]], tokens.symbol[at]
            else:
                (places, suffix), (at, name) = tokens.contexts(depth)[-2:]
                some = passes(name.view(np.int64))
                at, name = at[some], name[some]
                symbol = tokens.symbol[at]
                some = may(pair_names(suffix[np.searchsorted(places, at)], symbol).view(np.int64))
                name, symbol = name[some], symbol[some]
            held.append(_summed(name, symbol, np.ones(len(name), np.uint32)))
            if sum(len(h[0]) for h in held) > HELD:
                held.append(_merged(held))
                if len(held[0][0]) > HELD // 2:
                    yield from _packed_grams(held.pop(), buckets, often)
        if held:
            yield from _packed_grams(_merged(held), buckets, often)

    def add(batches: Batches) -> Batches:
        held = [_unpacked_grams(data.as_buffer()) for batch in batches for data in batch.column(1)]
        if held:
            context, symbol, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            name = mix(context, symbol)
            order = np.argsort(name)
            first = _runs(name[order])
            n = np.add.reduceat(n[order], first)
            own = order[first[n >= min_symbol]]
            yield from _gram_batches((context[own], symbol[own], n[n >= min_symbol]))

    if passes is None or may is None:
        return texts.sparkSession.createDataFrame([], GRAMS)
    packed = in_tasks(texts, count, "bucket int, data binary").repartitionById(buckets, "bucket")
    return stored(in_tasks(packed, add, GRAMS), "grams")


def _gram_batches(grams: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Batches:
    order = np.lexsort((grams[1], grams[0]))  # neighbours of one context take less room
    grams = [g[order] for g in grams]
    for low in range(0, len(grams[0]), 100_000):
        columns = [pa.array(g[low : low + 100_000].view(np.int64)) for g in grams]
        yield pa.RecordBatch.from_arrays(columns, names=["context", "symbol", "n"])


def _named(rows: DataFrame, function, schema: str) -> DataFrame:
    """``function`` of the columns of ``rows`` (all bigint), as numpy arrays of 64 bits."""
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches: Batches) -> Batches:
        for batch in batches:
            found = function(*(c.to_numpy().view(np.uint64) for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(f).view(np.int64)) for f in found], names=names)

    return in_tasks(rows, read, schema)


CONTEXTS = "context bigint, parent bigint, total bigint"


def build_tree(texts: DataFrame, words: DataFrame, below: float, buckets: int, params: Params) -> DataFrame:
    """The tree as a table: name, extra (what it adds to log10 P) and n.

    ``contexts`` and ``symbols`` of a depth are stored; a deeper context is a symbol of one a token
    shorter that was counted often enough, so its count is known before its symbols are counted.
    """
    end = int(END.view(np.int64))
    often = words.filter((F.col("n") >= params.min_context) & (F.col("symbol") != end)).select("symbol", "n")
    starts = words.filter((F.col("symbol") == end) & (F.col("n") >= params.min_context)).select(F.lit(int(START.view(np.int64))).alias("symbol"), "n")
    first = lambda symbol, n: (mix(np.full(len(symbol), ROOT), symbol), np.full(len(symbol), ROOT), n)
    contexts = stored(_named(often.union(starts), first, CONTEXTS), "contexts")
    # Of the parent: the probability of each symbol, which the root has for all.
    above = words.select(F.lit(int(ROOT.view(np.int64))).alias("parent"), "symbol", ((F.col("n") + 1) / F.lit(below)).alias("q"))
    possible = words.filter(F.col("n") >= params.min_symbol).select(F.col("symbol").alias("key"))
    levels = []
    for depth in range(1, params.depth + 1):
        grams = count_grams(texts, contexts, depth, params.min_symbol, possible, buckets)
        kept = grams.groupBy("context").agg(F.sum(F.col("n") - params.discount).alias("kept"), F.sum("n").alias("seen"))
        # A symbol kept after a context is kept after its suffix, so the second join drops nothing.
        symbols = grams.join(contexts.join(kept, "context"), "context").join(above, ["parent", "symbol"])
        rest = 1 - F.col("kept") / F.col("total")
        symbols = symbols.withColumn("rest", rest).withColumn("p", (F.col("n") - params.discount) / F.col("total") + F.col("rest") * F.col("q"))
        symbols = stored(symbols, "smoothed")
        levels.append((contexts, symbols, _significant(contexts, symbols, params)))
        if depth < params.depth:
            longer = symbols.filter((F.col("n") >= params.min_context) & (F.col("symbol") != end)).select("context", "parent", "symbol", "n")
            extend = lambda c, p, s, n: (mix(c, s), mix(p, s), n)
            contexts = stored(_named(longer, extend, CONTEXTS), "contexts")
            above = symbols.select(F.col("context").alias("parent"), "symbol", F.col("p").alias("q"))
            possible = _named(symbols.select("context", "symbol"), lambda c, s: (pair_names(c, s),), "key bigint")
    retained, tree = None, None
    for contexts, symbols, chosen in reversed(levels):
        if retained is not None:  # suffixes of retained contexts
            chosen = chosen.union(retained.select(F.col("parent").alias("context"))).distinct()
        retained = stored(contexts.join(chosen, "context", "left_semi"), "retained")
        own = symbols.join(retained.select("context"), "context", "left_semi")
        of_contexts = own.select("context", "rest", "total").distinct()
        rows = of_contexts.select(F.col("context").alias("name"), F.log10("rest").alias("extra"), F.col("total").alias("n"))
        pairs = _pair_names(own.select("context", "symbol", "n", F.log10(F.col("p") / (F.col("rest") * F.col("q"))).alias("extra")))
        rows = rows.union(pairs.select("name", "extra", "n"))
        tree = rows if tree is None else tree.union(rows)
    return tree


def _pair_names(rows: DataFrame) -> DataFrame:
    def read(batches: Batches) -> Batches:
        for batch in batches:
            context, symbol = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            name = pair_names(context, symbol)
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), *batch.columns[2:]], names=["name", "n", "extra"])

    return in_tasks(rows, read, "name bigint, n bigint, extra double")


def _significant(contexts: DataFrame, symbols: DataFrame, params: Params) -> DataFrame:
    """Contexts that predict their own occurrences, each left out, better than the parent by ``min_gain`` nats."""
    one = "(total - 1)"
    # Of a symbol that stays kept without one occurrence, and of one that falls below ``min_symbol``.
    stays = f"(n - 1 - {params.discount}D) / {one} / q + 1 - (kept - 1) / {one}"
    falls = f"1 - (kept - (n - {params.discount}D)) / {one}"
    gain = F.expr(f"n * ln(CASE WHEN n > {params.min_symbol} THEN {stays} ELSE {falls} END)")
    by_context = symbols.groupBy("context").agg(
        F.sum(gain).alias("gain"), *(F.any_value(c).alias(c) for c in ("total", "kept", "seen"))
    )
    others = F.expr(f"CASE WHEN total > seen THEN (total - seen) * ln(1 - kept / {one}) ELSE 0D END")
    return by_context.filter(F.col("gain") + others >= params.min_gain).select("context")


def _lookup(words: DataFrame, tree: DataFrame) -> DataFrame:
    """All names: known (1 for words), value (what they add to a score: to the base of words, to the rest of the tree), and n."""

    def named(symbol: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        return mix(np.full(len(symbol), WORD), symbol), n

    of_words = _named(words.select("symbol", "n"), named, "name bigint, n bigint")
    of_words = of_words.select("name", F.lit(1).alias("known"), F.log10(F.col("n") + 1).alias("value"), "n")
    return of_words.union(tree.select("name", F.lit(0).alias("known"), F.col("extra").alias("value"), "n"))


def _most_frequent(names: DataFrame, top: int) -> int:
    """A count that at most ``top`` names reach."""
    steps = names.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(F.count(F.lit(1)).alias("names"), F.min("n").alias("least"))
    least, held = 1 << 62, 0
    for r in sorted(steps.collect(), key=lambda r: -r["step"]):  # a few hundred steps
        held += r["names"]
        if held > top:
            break
        least = r["least"]
    return least


class Places:
    """Places of names in a sorted array of them, by a table of where their first bits begin."""

    def __init__(self, name: np.ndarray):
        self.name, self.shift = name, np.uint64(64 - max(8, len(name).bit_length()))
        steps = np.bincount(self._step(name), minlength=1 << (64 - int(self.shift)))
        self.begin = np.concatenate([[0], np.cumsum(steps)]).astype(np.int32)

    def _step(self, name: np.ndarray) -> np.ndarray:
        return ((name.view(np.uint64) ^ np.uint64(1 << 63)) >> self.shift).astype(np.int64)

    def of(self, name: np.ndarray) -> np.ndarray:
        """The place of each name, or -1."""
        step = self._step(name)
        at, end = self.begin[step], self.begin[step + 1]
        place, left = np.full(len(name), -1), np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            same = self.name[here] == name[left]
            place[left[same]] = here[same]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < end[left]]
        return place


def _sent(rows: Iterator[tuple[int, int, int, bytes]]) -> Batches:
    yield from _in_batches(rows, pa.schema([("bucket", pa.int32()), ("source", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())]))


def _packed(*arrays: np.ndarray) -> bytes:
    """Lengths of the arrays, then their bytes; arrays of 64 bits first, so that all begin where they may."""
    return b"".join([np.array([len(arrays), *map(len, arrays)], np.int64).tobytes(), *(a.tobytes() for a in arrays)])


def _unpacked(data: pa.Buffer, *types: type) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, len(types) + 1)[1:].tolist()
    result, at = [], 8 * (len(types) + 1)
    for size, kind in zip(sizes, types, strict=True):
        result.append(np.frombuffer(data, kind, size, at))
        at += result[-1].nbytes
    return result


def _packed_names(names: DataFrame, buckets: int) -> DataFrame:
    """Names (name, known, value) as arrays per bucket."""

    def pack(batches: Batches) -> Batches:
        def sent(held: list[pa.RecordBatch]) -> Batches:
            table = pa.Table.from_batches(held)
            name, known, value = (table.column(i).to_numpy() for i in range(3))
            order, parts = by_bucket(bucket_of(name.view(np.uint64), buckets))
            name, known, value = name[order], known[order].astype(np.uint8), value[order]
            yield from _sent((b, 0, NAMES, _packed(name[i:j], value[i:j], known[i:j])) for b, i, j in parts)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) > HELD:
                yield from sent(held)
                held = []
        if held:
            yield from sent(held)

    return in_tasks(names, pack, SENT)


def _look_up(batches: Batches) -> Batches:
    """One bucket's names looked up: of each text of a source what they add to its scores."""
    names, lookups = [], []
    for batch in batches:
        for bucket, source, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
            if kind == NAMES:
                names.append(_unpacked(data.as_buffer(), np.int64, np.float64, np.uint8))
            elif kind == LOOKUPS:
                lookups.append((source, data.as_buffer()))
            else:
                yield from _sent(iter([(bucket, source, kind, data.as_py())]))
    if not names:
        return
    name, value, known = (np.concatenate(x) for x in zip(*names, strict=True))
    names.clear()
    order = np.argsort(name)
    places, value, known = Places(name[order]), value[order], known[order].astype(bool)
    for source, data in lookups:
        key, stamp, each = _unpacked(data, np.int64, np.int64, np.uint32)
        row, place = np.repeat(np.arange(len(each)), each), places.of(key)
        row, place = row[place >= 0], place[place >= 0]
        word = known[place]
        count = np.bincount(row[word], minlength=len(each))
        base = np.bincount(row[word], value[place[word]], len(each))
        extra = np.bincount(row[~word], value[place[~word]], len(each))
        own = np.flatnonzero(np.bincount(row, minlength=len(each)))
        yield from _sent(iter([(0, source, LOOKUPS, _packed(base[own], extra[own], stamp, own.astype(np.uint32), count[own].astype(np.uint32)))]))


def _put_together(tokens: int) -> Callable[[Batches], Batches]:
    def add(batches: Batches) -> Batches:
        """Scores of the texts of some sources: what their own task knew and what the buckets add."""
        texts: dict[int, pa.RecordBatch] = {}
        more: dict[int, list[np.ndarray]] = {}
        stamps: set[tuple[int, int]] = set()
        for batch in batches:
            for source, kind, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                if kind == TEXTS:
                    texts[source] = pa.ipc.open_stream(data.as_buffer()).read_next_batch()
                    continue
                base, extra, stamp, own, count = _unpacked(data.as_buffer(), np.float64, np.float64, np.int64, np.uint32, np.uint32)
                stamps.add((source, int(stamp[0])))
                size = int(stamp[1])
                sums = more.setdefault(source, [np.zeros(size, np.int64), np.zeros(size), np.zeros(size)])
                for total, part in zip(sums, (count, base, extra), strict=True):
                    total[own] += part
        for source, text in texts.items():
            n_tokens, known, base, extra = (c.to_numpy() for c in text.columns[2:])
            if source in more:
                known, base, extra = (a + b for a, b in zip((known, base, extra), more.pop(source), strict=True))
            columns = [*text.columns[:3], pa.array(known), pa.array(np.full(len(known), tokens)), pa.array(base), pa.array(base + extra)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCORES.split(", ")])
        if more or any(stamp != _stamp(texts[source]) for source, stamp in stamps):
            raise RuntimeError("a task of texts was run again and read its rows in another order")

    return add


def _stamp(text: pa.RecordBatch) -> int:
    """Tells apart runs of a task that read its rows in different orders."""
    ids = text.column(0).fill_null(-1).to_numpy()
    return zlib.crc32(ids.tobytes() + text.column(2).to_numpy().tobytes())


def score_documents(documents: DataFrame, params: Params = Params()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = documents.sparkSession
    path = scratch_path(spark, "scores")
    with scratch(spark), shuffles_removed(spark):
        _scores(documents, params).write.parquet(path)
    return spark.read.schema(SCORES).parquet(path)


def _scores(documents: DataFrame, params: Params) -> DataFrame:
    spark = documents.sparkSession
    id_ = F.col("doc_id").cast("bigint")
    fold = F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % params.folds
    docs = documents.select(id_.alias("doc_id"), (fold == params.held_out_fold).alias("held_out"), "text")
    training = docs.filter("not held_out").select("text")
    path = scratch_path(spark, "names")
    with scratch(spark):  # of what the tree is made from, only its names stay
        words = count_words(training)
        tokens, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        below = float(tokens + 1 * (kinds + 1))
        buckets = max(shuffle_partitions(spark), -(-tokens // GRAM_TOKENS))
        tree = build_tree(training, words, below, buckets, params)
        found = _lookup(words, tree)
        found.write.parquet(path)
    names = spark.read.schema(found.schema).parquet(path)
    buckets = max(spark.sparkContext.defaultParallelism, -(-tokens // LOOKUP_TOKENS))
    least = _most_frequent(names, params.top)
    top = names.filter(F.col("n") >= least).select("name", "value").toArrow().sort_by("name")
    shared = spark.sparkContext.broadcast([top.column(i).to_numpy() for i in range(2)])
    passes = key_filter(names.select(F.col("name").alias("key")))

    def score(batches: Batches) -> Batches:
        name, value = shared.value
        places = Places(name)
        source = TaskContext.get().partitionId() << 31
        texts, rows, others, held = [], [], [], 0

        def resolve(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The place of each name among the broadcast ones, or -1; whether it may be one of the others."""
            key, place, left = key.view(np.int64), np.full(len(key), -1), np.zeros(len(key), bool)
            if passes is not None:
                some = np.flatnonzero(passes(key))
                place[some] = at = places.of(key[some])
                left[some[at < 0]] = True
            return place, left

        def sent() -> Iterator[tuple[int, int, int, bytes]]:
            """What was gathered: the texts to any bucket, names to look up to theirs."""
            text = pa.Table.from_batches(texts).combine_chunks().to_batches()[0]
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, text.schema) as stream:
                stream.write_batch(text)
            yield source % buckets, source, TEXTS, out.getvalue().to_pybytes()
            row, other = np.concatenate(rows), np.concatenate(others)
            for x in (texts, rows, others):
                x.clear()
            order = np.argsort(row, kind="stable")
            row, other = row[order], other[order]
            order, parts = by_bucket(bucket_of(other.view(np.uint64), buckets))
            row, other = row[order], other[order]
            stamp = np.array([_stamp(text), text.num_rows])
            for bucket, low, high in parts:
                each = np.bincount(row[low:high], minlength=text.num_rows).astype(np.uint32)
                yield bucket, source, LOOKUPS, _packed(other[low:high], stamp, each)

        for batch in batches:
            if not batch.num_rows:
                continue
            found = Tokens.of(batch.column(2))
            size, code = batch.num_rows, found.code
            at = np.flatnonzero(found.place > 0)
            before = sum(t.num_rows for t in texts)
            known, base, more = np.zeros(size), np.zeros(size), np.zeros(size)

            def met(key: np.ndarray, at: np.ndarray, place: np.ndarray, left: np.ndarray) -> np.ndarray:
                """Gather what names of words or of the tree give to their texts; which of them are there or may be."""
                rows.append((before + found.text[at[left]]).astype(np.uint32))
                others.append(key[left].view(np.int64))
                return place >= 0

            word = mix(np.full(len(found.kinds), WORD), found.kinds)
            place, left = (x[code[at]] for x in resolve(word))
            there = met(word[code[at]], at, place, left)
            known += np.bincount(found.text[at[there]], minlength=size)
            base += np.bincount(found.text[at[there]], value[place[there]], size)
            for depth, (positions, context) in enumerate(found.contexts(params.depth), 1):
                if depth == 1:  # the last token alone
                    place, left = (x[code[positions - 1]] for x in resolve(mix(np.full(len(found.kinds), ROOT), found.kinds)))
                else:
                    place, left = resolve(context)
                there = met(context, positions, place, left)
                more += np.bincount(found.text[positions[there]], value[place[there]], size)
                # Symbols are kept only after contexts that are retained.
                after = np.flatnonzero(there | left)
                pair = pair_names(context[after], found.symbol[positions[after]])
                place, left = resolve(pair)
                there = met(pair, positions[after], place, left)
                more += np.bincount(found.text[positions[after[there]]], value[place[there]], size)
            n_tokens = np.bincount(found.text[at], minlength=size)
            columns = [*batch.columns[:2], *map(pa.array, (n_tokens.astype(np.int64), known.astype(np.int64), base - n_tokens * math.log10(below), more))]
            texts.append(pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "known", "base", "extra"]))
            held += sum(map(len, others[-1 - 2 * params.depth :]))
            if held > HELD // 2:
                yield from _sent(sent())
                source, held = source + 1, 0
        if texts:
            yield from _sent(sent())

    rare = names.filter(F.col("n") < least).select("name", "known", "value")
    asked = in_tasks(docs, score, SENT).union(_packed_names(rare, buckets)).repartitionById(buckets, "bucket")
    answered = in_tasks(asked, _look_up, SENT)
    by_source = answered.repartitionById(buckets, F.shiftright("source", 31).cast("int"))
    return in_tasks(by_source, _put_together(tokens), SCORES)
