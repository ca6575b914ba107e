"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill.llm import (
    bpe,
    chat,
    packing,
    pq_dedup,
    quality,
    secrets,
    simhash,
    source_audit,
    suffix_dedup,
    suffix_tree,
    token_store,
    vector_codes,
    warc,
)
from hazemill.llm.common import read_table
from hazemill.session import scratch_path

END_ID, CAPACITY = 1, 4096


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(read_table(spark, sf_dir, "documents"))
    return found.drop("row", "class_distance", "word_distance")


def op2_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_digests(read_table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))


def op3_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.link_vectors(read_table(spark, sf_dir, "embeddings"))


def op4_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    control = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role").withColumn("text", F.lit(said))
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(conversations.unionByName(control)))


def op5_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    store = token_store.write_store(documents, scratch_path(spark, "store"), word_bpe(), END_ID)
    records = token_store.read_records(spark, store, token_store.lookup(spark, store, documents))
    return records.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_large_item_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), word_bpe(), END_ID, CAPACITY)


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(read_table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op10_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(read_table(spark, sf_dir, "documents"), word_bpe())


def op11_transducer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(read_table(spark, sf_dir, "documents"))


def op12_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.read_archive(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_walsh_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_distribution_divergence,
        op2_blob_ledger,
        op3_product_quantisation,
        op4_prefix_target_chat,
        op5_simhash_blocks,
        op6_token_store,
        op7_large_item_packing,
        op8_suffix_tree,
        op9_suffix_dedup,
        op10_prefix_bpe,
        op11_transducer_audit,
        op12_warc_shards,
        op13_walsh_codes,
    )
}
ORACLES: dict[str, str] = {
    "op4_prefix_target_chat": chat.ORACLE,
    "op11_transducer_audit": source_audit.ORACLE,
    "op12_warc_shards": warc.ORACLE,
    "op13_walsh_codes": vector_codes.ORACLE,
}
