"""A corpus pipeline over ``documents``: each stage calls one operator of
``tessera.llm``, its result is written as Parquet and read again as the next
stage's documents.

All stages but the last return the columns of ``documents``.  Language ID drops
texts whose language is not recognised, quality rules drop what they reject,
SimHash near-dedup keeps one document of each group, the secret scan masks
secrets, and best-fit packing gives the pieces of the rest with their places.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import langid, packing, quality, secrets, simhash
from tessera.session import ensure_checkpoint_dir
from tessera.sources.tables import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, width=3, limit=2)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express fitted classifiers, exact binomial bounds, XXH64 or
#: tokenizers; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  Stage results go to the checkpoint folder that
    the cluster shares; a result is removed when the next one is written."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs, before = read_table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _remove(spark, before)
        before = path
    return docs


def _remove(spark: SparkSession, path: str) -> None:
    """Removes a folder wherever Spark's file systems reach it."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
