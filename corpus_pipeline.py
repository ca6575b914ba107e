"""From raw documents to packed sequences, stage by stage; each stage's rows are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.llm import near_copies, packing, quality, secrets, suffix_dedup
from hazemill.llm.common import read_table, stored
from hazemill.llm.queries import CAPACITY, END_ID, word_bpe
from hazemill.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.quality(docs).filter("kept").select("row.*")


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: SimHash blocks, then exactly by five-word Jaccard of 0.8 or more."""
    return near_copies.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without byte strings that repeat; n_chars follows the text."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    done = suffix_dedup.remove_repeats(docs, carry=others)
    text = F.when(F.col("n_removed") > 0, F.length("kept"))
    values = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.coalesce(text, F.col("n_chars")).cast("bigint")}
    return done.select(*(values.get(c, F.col(c)).alias(c) for c in docs.columns))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts replaced."""
    return secrets.redacted(docs, scratch_path(spark, "ledger"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs, word_bpe(), END_ID, CAPACITY)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_distinct),
    ("repeats", cut_repeats),
    ("secrets", redact_secrets),
    ("packing", pack),
]
#: Hashes, suffixes and tokens are beyond SQL; tests compare near_duplicates with brute force, the others as operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
