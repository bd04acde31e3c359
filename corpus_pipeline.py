"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, folder), works on all rows that its predecessor kept and, but
for the last, returns the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trowel.llm import bpe, decontaminate, secrets, simhash, toxicity
from trowel.llm.common import read, stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score as toxic go. Voters and classifier are fitted on this stage's
    documents and the labels of the folder. Null and empty texts are scored as empty ones,
    repeated rows share their fate, long texts count whole; without any label every score is low."""
    return toxicity.drop_toxic(docs, read(spark, folder, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id. Null
    and empty texts have one fingerprint and so form a group; of repeated rows one stays; null ids
    come last; long texts count whole."""
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a word window of a benchmark item go. Null and empty texts hold
    none and stay; repeated rows share their fate; long texts are scanned whole."""
    return decontaminate.remove_contaminated(docs, read(spark, folder, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents stay; secrets in them give way to marks, live credentials to another one
    than widely copied examples, and n_chars follows. Null and empty texts stay as they are,
    repeated rows are masked alike, long texts are scanned whole."""
    return secrets.mask_secrets(docs, **secrets.owner_columns(), length_col="n_chars")


def token_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, ids, and the digests of ids and decoded text. Null and empty texts have no ids;
    repeated rows are each encoded; long texts are encoded whole."""
    return bpe.digests(bpe.encode(docs, bpe.word_vocabulary(), decoded=True), keep_ids=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secret_stage),
    ("bpe_encoding_and_decoding", token_stage),
]

# The classifier, XXH64 fingerprints and the vocabulary have no SQL form; the tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
