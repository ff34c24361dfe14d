"""A training corpus from ``documents`` in five stages, each one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet into the shared folder and reads it back for the next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchforge.llm.common import stage, table
from matchforge.llm.decontaminate import decontaminate
from matchforge.llm.quality import keep_quality
from matchforge.llm.secret_scan import redact_secrets
from matchforge.llm.simhash import near_dedup
from matchforge.llm.sp_dropout import encode_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_quality(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_dedup(docs, shingle=3, radius=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every document stays."""
    return redact_secrets(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, pieces, decoded, lossless) of every document."""
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: No SQL expresses expectation maximisation, fingerprints or the merge agenda.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
