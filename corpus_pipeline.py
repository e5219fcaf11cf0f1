"""A training corpus from `documents`: five stages, each one operator of parcelmart.llm.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of `documents`. Null texts, repeated
rows and empty tables follow the operators' own definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelmart.llm import curriculum, decontaminate, gam_quality, huffman_ids, simhash_dedup
from parcelmart.llm.common import packed, shared_path, stage, table, written_place


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    return gam_quality.good_documents(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_dedup.one_of_each(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage like a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, one row per copy the mix takes; part files and their rows, once written, keep the order."""
    rows = docs.select(packed(docs, "document"), "doc_id", "source", "text")
    return curriculum.training_order(curriculum.mix(rows)).select("document.*")


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents in the order they were written in; per document its place and checksum, read back."""
    folder = shared_path(spark, "token-files")
    path = huffman_ids.tokenizer_path()
    huffman_ids.write(docs, folder, path, order=written_place(docs))
    return huffman_ids.read(spark, folder)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", keep_uncontaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_ids),
]

# The classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{k}")
    return docs
