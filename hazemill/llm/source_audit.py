"""Source divergence audit: how far each source's use of terms is from the others' and its language's.

Terms are runs of ASCII letters and characters beyond ASCII, A-Z in lower case. A language keeps
the terms in at least ``MIN_DOCUMENTS`` of its documents. The kept terms, each behind its
language, are sorted over the cluster and every range of them becomes a minimal acyclic transducer
from term to lexicographic ordinal (``transducer.py``), a file in the shared folder. All texts are
then streamed through the transducers a second time for the counts; from there on terms are
ordinals, which also break ties, and only the reported ones are turned back into strings.

Shares of terms are whole numbers, 1 + floor(10^9 (count + 2) / (N + 2 V)), and so are
divergences, floor((p - q)^2 / (p + q)), summed over the kept terms. Two sources' sum takes no
row per pair and term: absent terms of a source all have one share, so a sum follows from V, from
how often each share occurs in either source, and from the terms that both have. Those corrections
are summed inside the task that holds a range of terms, and leave it as one row per pair.

Memory is bounded: a task holds ``HELD`` counted terms and ``CACHE_BYTES`` of transducers, whatever the vocabulary
is; beyond that a transducer is read again. The driver holds one entry per transducer.

Null texts, languages and sources are ''; repeated rows are documents of their own; whole texts
are read in pieces cut between terms; a group without terms has divergences like any other, all
0 in a language without kept terms; ids are not needed; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
import uuid
from collections import Counter, OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazemill.llm.common import Batches, file_system, in_tasks, stored
from hazemill.llm.transducer import Transducer
from hazemill.session import scratch_path

MIN_DOCUMENTS, TOP = 10, 10
SCALE, PRIOR = 1_000_000_000, 2
#: Terms of one transducer, on average.
PART_TERMS = 200_000
#: Counted terms a task holds, bytes of a text that are cut at once, rows of shares that are paired at once.
HELD, PIECE, PAIRED = 200_000, 1 << 20, 1 << 16
CACHE_BYTES = 64 << 20
#: Bytes beyond terms become spaces, A-Z lower case.
_FOLD = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))
_CACHE: OrderedDict[str, tuple[Transducer, int]] = OrderedDict()


def pieces(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in its order, a list for each piece of it."""
    folded = (text or b"").translate(_FOLD)
    low = 0
    while low < len(folded):
        high = len(folded) if len(folded) - low <= PIECE else folded.rfind(b" ", low, low + PIECE)
        if high <= low:  # a term longer than a piece
            high = folded.find(b" ", low + PIECE)
            high = len(folded) if high < 0 else high
        yield folded[low:high].split()
        low = high + 1


def _texts(documents: DataFrame) -> DataFrame:
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return documents.select(plain("lang"), plain("source"), F.col("text").cast("string").cast("binary").alias("text"))


def vocabulary(texts: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The kept terms: key (language, a zero byte, term)."""

    def read(batches: Batches) -> Batches:
        held: dict[str, Counter] = {}

        def rows() -> Batches:
            for lang, counts in held.items():
                before = lang.encode() + b"\0"
                key = pa.array([before + t for t in counts], pa.binary())
                yield pa.RecordBatch.from_arrays([key, pa.array(list(counts.values()), pa.int64())], names=["key", "n"])
            held.clear()

        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found: set[bytes] = set()
                for terms in pieces(text):
                    found.update(terms)
                counts = held.setdefault(lang, Counter())
                before = len(counts)
                counts.update(found)
                size += len(counts) - before
                if size > HELD:
                    yield from rows()
                    size = 0
        yield from rows()

    counts = in_tasks(texts.select("lang", "text"), read, "key binary, n bigint")
    return stored(counts.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_documents).select("key"), "vocabulary")


class Vocabulary:
    """Transducers over consecutive ranges of the sorted keys; ``first`` keys and ``base`` ordinals of the ranges."""

    def __init__(self, folder: str, part: list[int], first: list[bytes], base: list[int]):
        self.folder, self.part, self.first, self.base = folder, part, first, base

    @staticmethod
    def build(keys: DataFrame, part_terms: int = PART_TERMS) -> Vocabulary:
        spark = keys.sparkSession
        folder = scratch_path(spark, "transducers")
        parts = max(1, -(-keys.count() // part_terms))

        def write(batches: Batches) -> Batches:
            first: list[bytes] = []
            total = 0

            def strings() -> Iterator[bytes]:
                nonlocal total
                for batch in batches:
                    for key in batch.column(0).to_pylist():
                        if not total:
                            first.append(key)
                        total += 1
                        yield key

            built = Transducer.build(strings())
            if total:
                part = TaskContext.get().partitionId()
                _put(folder, _name(part), built.to_bytes())
                columns = [pa.array([part], pa.int32()), pa.array(first, pa.binary()), pa.array([total], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "first", "n"])

        ordered = keys.repartitionByRange(parts, "key").sortWithinPartitions("key")
        rows = sorted(in_tasks(ordered, write, "part int, first binary, n bigint").collect())  # one row a transducer
        base = [0, *np.cumsum([r["n"] for r in rows]).tolist()]
        return Vocabulary(folder, [r["part"] for r in rows], [bytes(r["first"]) for r in rows], base[: len(rows)])

    def transducer(self, at: int) -> Transducer:
        """The ``at``-th range's, kept by this worker until ``CACHE_BYTES`` of later ones have been read."""
        name = f"{self.folder}/{_name(self.part[at])}"
        if name in _CACHE:
            _CACHE.move_to_end(name)
            return _CACHE[name][0]
        system, path = file_system(name)
        with system.open_input_file(path) as file:
            data = file.read()
        _CACHE[name] = Transducer.from_bytes(data), len(data)
        while len(_CACHE) > 1 and sum(n for _, n in _CACHE.values()) > CACHE_BYTES:
            _CACHE.popitem(last=False)
        return _CACHE[name][0]

    def ordinals(self, keys: list[bytes]) -> np.ndarray:
        """Ordinals among all keys of the vocabulary, -1 for others; ``keys`` is sorted."""
        found = np.full(len(keys), -1, np.int64)
        edges = [bisect.bisect_left(keys, first) for first in self.first] + [len(keys)]
        for at, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
            if high > low:
                local = self.transducer(at).ordinals(keys[low:high])
                found[low:high] = np.where(local < 0, -1, local + self.base[at])
        return found

    def term(self, ordinal: int) -> str:
        at = bisect.bisect_right(self.base, ordinal) - 1
        return self.transducer(at).string(ordinal - self.base[at]).rpartition(b"\0")[2].decode()


def _name(part: int) -> str:
    return f"part-{part:06d}.npz"


def _put(folder: str, name: str, data: bytes) -> None:
    """Write under a name of its own, then rename: a task that runs again replaces its equal."""
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, f"{path}/{name}")


def recount(texts: DataFrame, terms: Vocabulary) -> DataFrame:
    """lang, source, ordinal and n: how often each kept term occurs in each group."""

    def read(batches: Batches) -> Batches:
        held: dict[tuple[str, str], Counter] = {}

        def rows() -> Batches:
            for (lang, source), counts in held.items():
                before = lang.encode() + b"\0"
                found = sorted(counts)
                ordinal = terms.ordinals([before + t for t in found])
                n = np.array([counts[t] for t in found], np.int64)
                kept = ordinal >= 0
                size = int(kept.sum())
                columns = [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), pa.array(ordinal[kept]), pa.array(n[kept])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "ordinal", "n"])
            held.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = held.setdefault((lang, source), Counter())
                for found in pieces(text):
                    before = len(counts)
                    counts.update(found)
                    size += len(counts) - before
                    if size > HELD:
                        yield from rows()
                        counts, size = held.setdefault((lang, source), Counter()), 0
        yield from rows()

    counts = in_tasks(texts, read, "lang string, source string, ordinal bigint, n bigint")
    return stored(counts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "term_counts")


def share(count: str, total: str, kinds: str) -> F.Column:
    """1 + floor(10^9 (count + 2) / (N + 2 V)), exact; null where a language keeps no term."""
    above = f"cast({SCALE} as decimal(10,0)) * cast({count} + {PRIOR} as decimal(19,0))"
    return F.expr(f"if({kinds} > 0, 1 + ({above}) div cast({total} + {PRIOR} * {kinds} as decimal(20,0)), null)").cast("bigint")


def divergence(p: str, q: str) -> str:
    """floor((p - q)^2 / (p + q)); shares are below 2^31, so that squares fit."""
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def _divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _corrections(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, value) of each pair of groups a < b over the terms that both have; rows ascend by term and group."""
    ordinal, group, p, none = rows
    keys: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    values: list[np.ndarray] = [np.zeros(0, np.int64)]
    for step in range(1, len(ordinal)):
        both = np.flatnonzero(ordinal[step:] == ordinal[:-step])
        if not len(both):
            break
        a, b = both, both + step
        value = _divergences(p[a], p[b]) - _divergences(p[a], none[b]) - _divergences(none[a], p[b]) + _divergences(none[a], none[b])
        keys.append(np.stack([group[a], group[b]], axis=1))
        values.append(value)
        if sum(map(len, values)) > 1 << 21:
            keys, values = ([x] for x in _summed(keys, values))
    key, value = _summed(keys, values)
    return key[:, 0], key[:, 1], value


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.lexsort((key[:, 1], key[:, 0]))
    key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(value, first) if len(key) else value


def _shared_terms(shares: DataFrame) -> DataFrame:
    """a, b, extra: what the terms that both groups have change in the pair's sum."""

    def read(batches: Batches) -> Batches:
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 4
        waiting: list[list[np.ndarray]] = []

        def found(rows: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _corrections(rows)], names=["a", "b", "extra"])

        for batch in batches:
            waiting.append([c.to_numpy() for c in batch.columns])
            if sum(len(w[0]) for w in waiting) >= PAIRED:
                held = [np.concatenate([h, *(w[i] for w in waiting)]) for i, h in enumerate(held)]
                waiting = []
                edge = int(np.searchsorted(held[0], held[0][-1]))  # the last term may go on
                yield found([h[:edge] for h in held])
                held = [h[edge:] for h in held]
        yield found([np.concatenate([h, *(w[i] for w in waiting)]) for i, h in enumerate(held)])

    ordered = shares.select("ordinal", "gid", "p", "none").repartition("ordinal").sortWithinPartitions("ordinal", "gid")
    return in_tasks(ordered, read, "a bigint, b bigint, extra bigint").groupBy("a", "b").agg(F.sum("extra").alias("extra"))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """lang, source, item and value of each ordered pair of sources of a language."""
    of = lambda side: groups.select("lang", *(F.col(c).alias(f"{c}_{side}") for c in ("gid", "source", "none")))
    kinds = groups.select("gid", "kinds")
    pairs = stored(of("a").join(of("b"), "lang").filter("gid_a <> gid_b"), "pairs")
    # What the terms of a group change against a group that has none of them.
    spread = stored(shares.groupBy("gid", "p").agg(F.count(F.lit(1)).alias("terms")), "spread")
    alone = F.expr(f"terms * ({divergence('p', 'none_b')} - {divergence('none_a', 'none_b')})")
    alone = spread.join(pairs, F.col("gid") == F.col("gid_a")).groupBy("gid_a", "gid_b").agg(F.sum(alone).alias("alone"))
    alone = stored(alone, "alone")
    both = stored(_shared_terms(shares), "both")
    both = both.union(both.select("b", "a", "extra")).select(F.col("a").alias("gid_a"), F.col("b").alias("gid_b"), "extra")
    turned = alone.select(F.col("gid_a").alias("gid_b"), F.col("gid_b").alias("gid_a"), F.col("alone").alias("other"))
    keys = ["gid_a", "gid_b"]
    whole = pairs.join(kinds, F.col("gid") == F.col("gid_a")).join(alone, keys, "left").join(turned, keys, "left").join(both, keys, "left")
    none = lambda c: f"coalesce({c}, 0L)"
    value = f"kinds * {none(divergence('none_a', 'none_b'))} + {none('alone')} + {none('other')} + {none('extra')}"
    return whole.select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), F.expr(value).alias("value"))


def _top_terms(groups: DataFrame, shares: DataFrame, langs: DataFrame, terms: Vocabulary, top: int) -> DataFrame:
    """The terms of each group that it uses more than its language, by divergence, ranked to ``top``."""
    rows = shares.join(langs, "ordinal").filter("p > q").select("gid", "ordinal", F.expr(divergence("p", "q")).alias("value"))
    order = Window.partitionBy("gid").orderBy(F.col("value").desc(), "ordinal")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    def read(batches: Batches) -> Batches:
        for batch in batches:
            item = pa.array([terms.term(o) for o in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), item, *batch.columns[2:]], names=["gid", "item", "value", "rank"])

    named = in_tasks(ranked, read, "gid bigint, item string, value bigint, rank int")
    return named.join(groups, "gid").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def audit_sources(documents: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP, part_terms: int = PART_TERMS) -> DataFrame:
    """lang, source, part ('pair', 'term'), item, value and rank."""
    texts = _texts(documents)
    terms = Vocabulary.build(vocabulary(texts, min_documents), part_terms)
    counts = recount(texts, terms)
    # Ordinals belong to one language each.
    by_term = stored(counts.groupBy("ordinal").agg(F.any_value("lang").alias("lang"), F.sum("n").alias("n")), "language_counts")
    sizes = stored(by_term.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")), "languages")
    langs = stored(by_term.join(sizes, "lang").select("ordinal", share("n", "total", "kinds").alias("q")), "language_shares")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("held"))
    every = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    kinds, held = F.coalesce("kinds", F.lit(0)).alias("kinds"), F.coalesce("held", F.lit(0)).alias("held")
    groups = every.select(F.monotonically_increasing_id().alias("gid"), "lang", "source", kinds, held)
    groups = stored(groups.withColumn("none", share("0", "held", "kinds")), "groups")
    shares = counts.join(groups, ["lang", "source"]).select("gid", "ordinal", share("n", "held", "kinds").alias("p"), "none")
    shares = stored(shares, "shares")
    found = _pairs(groups, shares)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = found.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return pairs.union(_top_terms(groups, shares, langs, terms, top))


#: Terms as in the contract; whole numbers of 128 bits.
ORACLE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), words AS (
  SELECT id, lang, source, unnest(terms) AS term FROM texts
), kept AS (
  SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), kinds AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM texts
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT d.lang, source, term, n,
    1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (sum(n) OVER (PARTITION BY d.lang, source) + 2 * v) AS p
  FROM dense d JOIN kinds USING (lang)
), langs AS (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term
), language AS (
  SELECT l.lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (sum(n) OVER (PARTITION BY l.lang) + 2 * v) AS q
  FROM langs l JOIN kinds USING (lang)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), found AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT s.lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value,
      row_number() OVER (PARTITION BY s.lang, source ORDER BY (p - q) * (p - q) // (p + q) DESC, term) AS rank
    FROM shares s JOIN language USING (lang, term) WHERE n > 0 AND p > q
  ) WHERE rank <= 10
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM found
"""
