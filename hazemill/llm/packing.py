"""Best-fit packing of documents into sequences of bounded length, large items matched first.

Only longer documents are cut, into full pieces and a rest. What decides a piece's place is its
length alone, so the plan is made for counts of lengths: at most one entry per length, whatever
the size of the corpus. Pieces above a third of the capacity are matched greedily, at most two
to a sequence, each with the longest that still fits; full pieces stand alone; smaller pieces,
longest first, go to the fullest sequence with room. The plan says for each length which ranks
go to which sequences; pieces get their rank within their length from their task's own count
and the counts of the tasks before. No text is shuffled, and no length meets in one task.

Nulls are empty texts (one piece, the end id); repeated rows are packed each; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazemill.llm.common import Batches, in_tasks, stored
from hazemill.llm.wordbpe import word_ids

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint"
RESULT = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@dataclass
class Plan:
    """Where the pieces of each length go.

    An entry (rank, sequence, each, offset) of a length says: from this rank on, ``each``
    pieces per sequence, from this sequence and this offset on. ``sequences`` counts them.
    """

    places: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    sequences: int = 0


def plan_packing(counts: dict[int, int], capacity: int) -> Plan:
    """Pack ``counts`` pieces per length. Work and size depend on the capacity only.

    A group is a run of sequences alike: (first, how many). Placing pieces splits at most one
    group, and each time it takes pieces a group's room at least halves, so there are at most
    a few groups per length and few entries per group.
    """
    plan = Plan()
    taken = dict.fromkeys(counts, 0)
    room: dict[int, list[tuple[int, int]]] = {}

    def place(length: int, first: int, n: int, each: int, offset: int) -> None:
        plan.places.setdefault(length, []).append((taken[length], first, each, offset))
        taken[length] += n * each

    def opened(n: int) -> int:
        plan.sequences += n
        return plan.sequences - n

    left = {k: n for k, n in counts.items() if 0 < k <= capacity and n > 0}
    large = sorted((k for k in left if 3 * k > capacity), reverse=True)
    for k in large:
        # The longest partner that fits; alone if there is none.
        for other in large:
            if not left[k]:
                break
            if other > k or k + other > capacity or not left[other]:
                continue
            n = left[k] // 2 if other == k else min(left[k], left[other])
            if not n:
                continue
            first = opened(n)
            if other == k:
                place(k, first, n, 2, 0)
            else:
                place(k, first, n, 1, 0)
                place(other, first, n, 1, k)
                left[other] -= n
            left[k] -= n * (2 if other == k else 1)
            room.setdefault(capacity - k - other, []).append((first, n))
        if left[k]:
            first = opened(left[k])
            place(k, first, left[k], 1, 0)
            room.setdefault(capacity - k, []).append((first, left[k]))
            left[k] = 0
    for k in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        for gap in sorted(r for r in room if r >= k):
            if not left[k]:
                break
            each, groups = gap // k, room.pop(gap)
            while groups and left[k]:
                first, n = groups.pop()
                full = min(n, left[k] // each)
                if full:
                    place(k, first, full, each, capacity - gap)
                    room.setdefault(gap - each * k, []).append((first, full))
                    left[k] -= full * each
                if full < n and left[k]:
                    place(k, first + full, 1, left[k], capacity - gap)
                    room.setdefault(gap - left[k] * k, []).append((first + full, 1))
                    left[k], full = 0, full + 1
                if full < n:
                    groups.append((first + full, n - full))
            if groups:
                room.setdefault(gap, []).extend(groups)
        if left[k]:
            each = capacity // k
            full, rest = divmod(left[k], each)
            for n, take in ((full, each), (min(rest, 1), rest)):
                if n:
                    first = opened(n)
                    place(k, first, n, take, 0)
                    room.setdefault(capacity - take * k, []).append((first, n))
            left[k] = 0
    return plan


def cut_pieces(documents: DataFrame, tokenizer_file: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of ``documents`` (doc_id, text); ``place`` counts pieces of a length within a task."""

    def cut(batches: Batches) -> Batches:
        encoder, task, seen = word_ids(tokenizer_file), TaskContext.get().partitionId(), {}
        for batch in batches:
            rows = []
            for doc, found in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                ids = np.append(found.astype("<u4"), np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    place = seen.get(len(part), 0)
                    seen[len(part)] = place + 1
                    rows.append((doc, piece, start, len(part), zlib.crc32(part.tobytes()), task, place))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PIECE.split(", ")])

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return in_tasks(rows, cut, PIECE)


def pack_documents(documents: DataFrame, tokenizer_file: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """One row per piece with its sequence and its offset there.

    The pieces (not their ids) are written to the shared folder first, so that a task that
    runs again finds the same ranks.
    """
    pieces = stored(cut_pieces(documents, tokenizer_file, end_id, capacity), "pieces")
    tasks = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = stored(tasks.select("task", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "ranks")
    # At most one row per length: capacity bounds what comes to the driver.
    counts = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = plan_packing(counts, capacity).places
    arrays = {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in places.items()}

    def assign(batches: Batches) -> Batches:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for of in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                k = int(length[of[0]])
                ranks, first, each, base = arrays[k]
                at = np.searchsorted(ranks, rank[of], "right") - 1
                beyond = rank[of] - ranks[at]
                sequence[of] = first[at] + beyond // each[at]
                offset[of] = base[at] + beyond % each[at] * k
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=RESULT)

    ranked = pieces.join(tasks, ["task", "length"]).select(*RESULT[:5], (F.col("before") + F.col("place")).alias("rank"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return in_tasks(ranked, assign, schema)
