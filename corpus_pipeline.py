"""Corpus pipeline: quality classifier, SimHash near-duplicate removal, secret masking, packing.

Each stage takes what the one before kept, written as Parquet and read again. The
first three return the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm import packing, quality, secret_scan, simhash
from shopmart.llm.common import documents, new_folder, ship
from shopmart.llm.queries import IDS_FILE, dictionary, secret_findings, secret_forest, table

# No SQL states a trained model, so the stages are tested against brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go."""
    ship(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints within two bits of each other, the document with the smallest id stays."""
    ship(spark)
    return simhash.deduplicate(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced; ``n_chars`` follows."""
    ship(spark)
    masked = secret_scan.mask(docs, secret_forest(secret_findings(docs)), dictionary())
    return masked.withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 ids."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path(IDS_FILE))


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    result = documents(spark, sf_dir)
    for _, stage in STAGES:
        path = new_folder(spark, "pipeline")
        stage(spark, result, sf_dir).write.parquet(path)
        result = spark.read.parquet(path)
    return result
