"""A corpus pipeline: quality filter, exact dedup, near dedup, secret redaction, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one
before kept. All but the last return the columns of documents; the last one
returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import common, exact_dedup, ngram_join, packing, quality_fm, secret_scan

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score under its threshold) go."""
    return quality_fm.keep_good(docs, common.read_table(spark, sf_dir, "labels")).select(*COLUMNS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.drop_copies(docs).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of the n-gram Jaccard join the smallest doc_id stays."""
    return ngram_join.keep_representatives(docs).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts that hold them; every document stays."""
    return secret_scan.redact(docs).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 1024."""
    return packing.pack_documents(docs)


STAGES = [("quality_classifier", quality), ("exact_dedup", exact_copies), ("ngram_jaccard_join", near_copies),
          ("secret_scan", secrets), ("best_fit_packing", packed)]

#: The classifier, the near-duplicate components and the tokens are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written to the shared folder and read by the next."""
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        done = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
        common.discard(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
