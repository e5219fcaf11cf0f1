"""One query per operator over its whole table, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.llm import (
    chat_tokens,
    context_mixing,
    curriculum,
    decontaminate,
    gam_quality,
    html_wrappers,
    huffman_ids,
    merkle_manifest,
    order_minhash,
    simhash_dedup,
    strassen_negatives,
    two_fit_packing,
    warc_index,
)
from parcelmart.llm.common import shared_path, stage, table

Query = Callable[[SparkSession, str], DataFrame]


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item with a window like it."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a third of the labels is never learnt from."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    marked = gam_quality.scored(docs, gam_quality.train(docs, labels))
    return marked.select("doc_id", (~gam_quality.may_teach()).alias("held_out"), "score", "predicted")


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document; a seventh is never learnt from."""
    return context_mixing.scored(table(spark, sf_dir, "documents"))


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of all pages, read back from the archives, in index order."""
    folder = shared_path(spark, "warc")
    warc_index.write_archives(table(spark, sf_dir, "pages"), folder)
    index = warc_index.capture_index(spark, folder)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations and of one that is full of control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    path = huffman_ids.tokenizer_path()
    return chat_tokens.read_back(stage(chat_tokens.format_turns(turns, path), "chat"), path)


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_wrappers.extract(table(spark, sf_dir, "pages"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the mix, and when its first copy comes; rows in training order, what is not taken last."""
    mixed = curriculum.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    ordered = curriculum.training_order(mixed.withColumn("first_position", F.try_element_at("positions", F.lit(1))), idle=True)
    first = ordered.where(F.col("mix_position").eqNullSafe(F.col("first_position")))
    return first.select("doc_id", "size", "source_size", "target", "taken", "copies", "first_position")


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    return order_minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and checksum of every document's ids, read back from the files."""
    folder = shared_path(spark, "token-files")
    huffman_ids.write(table(spark, sf_dir, "documents"), folder, huffman_ids.tokenizer_path())
    return huffman_ids.read(spark, folder)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and the root its (for a fifth: tampered) leaf folds to."""
    return merkle_manifest.verified(table(spark, sf_dir, "documents"))


def op12_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    found = two_fit_packing.pieces(table(spark, sf_dir, "documents"), huffman_ids.tokenizer_path())
    return two_fit_packing.placed(found.drop("ids")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the labels of a seventh are poisoned."""
    vectors = strassen_negatives.quantised(table(spark, sf_dir, "embeddings"))
    poisoned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return strassen_negatives.mine(vectors.withColumn("label", poisoned), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_order_minhash": op1_order_minhash,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_token_ids": op3_token_ids,
    "op4_decontaminate": op4_decontaminate,
    "op5_quality_gam": op5_quality_gam,
    "op6_context_mixing": op6_context_mixing,
    "op7_warc_index": op7_warc_index,
    "op8_chat_format": op8_chat_format,
    "op9_html_main_text": op9_html_main_text,
    "op10_mix_sources": op10_mix_sources,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_two_fit_packing": op12_two_fit_packing,
    "op13_hard_negatives": op13_hard_negatives,
}
