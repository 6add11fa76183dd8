"""From raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next stage's documents. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidecast.llm import bpe, decontaminate, lines, quality, simhash
from tidecast.llm.common import table, written
from tidecast.session import prepare


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base rules or the risk-controlled cutoffs reject."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the lines that a source repeats on many of its documents."""
    prepare(spark)
    return lines.clean_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group, then of near copies out of its reach.

    Fingerprints at most 2 bits apart are linked. Of what is left, texts whose shingle sets
    are alike are near copies too, most of which differ in more bits.
    """
    prepare(spark)
    return simhash.drop_near_copies(simhash.drop_simhash_copies(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the passages that stand in the benchmark."""
    prepare(spark)
    return decontaminate.remove_passages(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and the digest of the text decoded from them."""
    prepare(spark)
    path, pattern = bpe.public_vocabulary()
    return bpe.encode_texts(docs, path, pattern, ("n_tokens", "packed_ids", "decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL has neither fingerprints nor merges; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
