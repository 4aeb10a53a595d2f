"""The training-text pipeline: quality rules, near-duplicates, decontamination, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from halfhourly.llm import decontamination, packing, quality, secrets, simhash
from halfhourly.llm.common import table
from halfhourly.llm.queries import tokenizer_path
from halfhourly.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; a document that fails the base rules or loses too much text goes."""
    return quality.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the document with the smallest id stays."""
    return simhash.simhash_distinct(docs, shingle=3, max_bits=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that contains a benchmark item goes."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secrets.without_secrets(docs, secrets.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of at most 2048 tokens."""
    return packing.packed(docs, tokenizer_path(), ["doc_id"])


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontaminate), ("secret_scans", mask_secrets), ("packing", pack)]

#: Fingerprints, the test battery and packing are beyond SQL; tests/llm/test_pipeline.py runs a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; each stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"stage-{name}")
    return docs
