"""Secret scan with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. A blob is scanned once
for each rule version: the ledger, a table in shared storage, has a row for every (blob, rule
version) ever scanned, findings or not, and a run scans only the pairs that it lacks. Findings
are joined back to all versions. Copies of a blob are merged before the shuffle, so a blob that
is a third of all versions moves once per task.

Nulls are empty texts; repeated rows are versions of their own and share a blob; extra columns
are ignored; an empty table gives an empty result. Spans are code points, end exclusive. Long
texts are scanned whole, and redacted in time linear in their length and findings.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.llm.common import Batches, in_tasks, key_filter, stored

LEDGER = "blob binary, rule string, spans array<struct<start: bigint, end: bigint>>"

# The patterns, and the lengths that a match must reach.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_VALUE, ACCESS_LENGTH = 8, 16
NAMES = ("passw", "secret", "token", "api")

Span = tuple[int, int]


def find_assign(text: str) -> list[Span]:
    lower = text.lower()
    if not any(name in lower for name in NAMES):
        return []
    return [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]


def find_access(text: str) -> list[Span]:
    return [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH] if "AKIA" in text else []


def find_hex(text: str) -> list[Span]:
    """Runs of 32 and more: the same as all runs without the shorter ones."""
    return [m.span() for m in HEX.finditer(text)]


@dataclass(frozen=True)
class Rule:
    """A kind of secret; a change to ``find`` needs a new ``version``."""

    kind: str
    version: int
    find: Callable[[str], list[Span]]

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


RULES = (Rule("assign", 1, find_assign), Rule("access", 1, find_access), Rule("hex", 1, find_hex))


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _addressed(versions: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return versions.select(F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"), text.alias("content"))


def scan_unseen(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the (blob, rule version) pairs of ``versions`` (text) that the ledger at ``ledger`` lacks, and add them.

    The append is atomic: a run that fails adds nothing and can be run again. One run at a time.
    """
    spark = versions.sparkSession
    keys = [rule.key for rule in rules]
    known = _ledger(spark, ledger)
    every = F.array(*map(F.lit, keys))
    if known is None:
        blobs = _addressed(versions).groupBy("blob").agg(F.any_value("content").alias("content")).withColumn("todo", every)
    else:
        # Names first: only the texts of blobs with something left to scan are moved.
        seen = known.filter(F.col("rule").isin(keys)).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        left = F.when(F.col("seen").isNull(), every).otherwise(F.array_except(every, "seen"))
        todo = _addressed(versions).select("blob").distinct().join(seen, "blob", "left").select("blob", left.alias("todo"))
        todo = stored(todo.filter(F.size("todo") > 0), "unseen_blobs")
        name = F.xxhash64("blob")
        passes = key_filter(todo.select(name.alias("key")))
        if passes is None:
            return

        def pick(batches: Batches) -> Batches:
            for batch in batches:
                yield batch.filter(pa.array(passes(batch.column(2).to_numpy())))

        some = in_tasks(_addressed(versions).select("blob", "content", name.alias("key")), pick, "blob binary, content string, key bigint")
        blobs = some.join(todo, "blob").groupBy("blob").agg(F.any_value("content").alias("content"), F.any_value("todo").alias("todo"))

    def scan(batches: Batches) -> Batches:
        for batch in batches:
            found = []
            for blob, content, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for rule in rules:
                    if rule.key in wanted:
                        found.append((blob, rule.key, [{"start": a, "end": b} for a, b in rule.find(content)]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [pa.array([x[i] for x in found], t) for i, t in enumerate((pa.binary(), pa.string(), span))]
            yield pa.RecordBatch.from_arrays(columns, names=["blob", "rule", "spans"])

    in_tasks(blobs.select("blob", "content", "todo"), scan, LEDGER).write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every version with the findings of its blob: the ``carry`` columns and ``found``.

    ``found`` lists (start, kind, end) by start and then by the rules' order. Only blobs with
    findings take part in the join.
    """
    spark = versions.sparkSession
    order = F.create_map(*(F.lit(x) for i, rule in enumerate(rules) for x in (rule.key, i)))
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    rows = spark.read.schema(LEDGER).parquet(ledger).filter(F.col("rule").isin([r.key for r in rules]))
    spans = rows.select("blob", F.element_at(order, F.col("rule")).alias("of"), F.explode("spans").alias("s"))
    # A pair scanned twice, by a run repeated after a failure elsewhere, counts once.
    listed = spans.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("s.start", "of", "s.end"))).alias("found"))
    listed = listed.select("blob", F.transform("found", lambda x: F.struct(x["start"].alias("start"), F.get(kinds, x["of"]).alias("kind"), x["end"].alias("end"))).alias("found"))
    blob = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("blob")
    nothing = F.from_json(F.lit("[]"), listed.schema["found"].dataType)
    joined = versions.select(*carry, blob).join(listed, "blob", "left")
    return joined.select(*carry, F.coalesce("found", nothing).alias("found"))


def _count(kind: str) -> Column:
    return F.size(F.filter("found", lambda x: x["kind"] == kind))


def scan_digests(documents: DataFrame, ledger: str) -> DataFrame:
    """Scan ``documents`` through the ledger; per document counts by kind and its spans."""
    scan_unseen(documents, ledger)
    found = findings(documents, ledger, carry=("doc_id",))
    text = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    counts = [_count(rule.kind).cast("bigint").alias(f"n_{rule.kind}") for rule in RULES]
    return found.select(F.col("doc_id").cast("bigint"), *counts, F.sha2(text.cast("binary"), 256).alias("base_sha256"), text.alias("spans"))


def _cut(text: str, found: list[dict]) -> str:
    """``text`` with its spans replaced; one that begins within the last only extends it."""
    parts, at = [], 0
    for x in found:
        if x["start"] >= at:
            parts += [text[at : x["start"]], f"[{x['kind']}]"]
        at = max(at, x["end"])
    return "".join([*parts, text[at:]])


def redacted(documents: DataFrame, ledger: str) -> DataFrame:
    """``documents`` with all their columns and each secret in ``text`` replaced by its kind in brackets."""
    scan_unseen(documents, ledger)
    found = findings(documents.select(F.struct("*").alias("row"), "text"), ledger, carry=("row",))
    columns = documents.columns

    def replace(batches: Batches) -> Batches:
        for batch in batches:
            fields = dict(zip(columns, batch.column(0).flatten(), strict=True))
            spoilt = [i for i, x in enumerate(pc.list_value_length(batch.column(1)).to_pylist()) if x]
            if spoilt:
                texts = fields["text"].to_pylist()
                for i in spoilt:
                    texts[i] = _cut(texts[i], batch.column(1)[i].as_py())
                fields["text"] = pa.array(texts, fields["text"].type)
            yield pa.RecordBatch.from_arrays(list(fields.values()), names=columns)

    return in_tasks(found.select("row", "found"), replace, documents.schema)
