"""A cleaning pipeline over documents: five stages, each written as Parquet and read again.

The quality classifier drops what it rejects; of each SimHash class the
document with the smallest id stays; contaminated documents go; personal
data is masked in the texts that are left; and the last stage encodes them.
Each stage works on all that the one before kept, and all but the last return
the columns of documents.

Defined results: a stage on an empty table gives an empty table; null texts
are handled as their operators say; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import bpe, decontaminate, pii, quality, simhash
from corpusmill.llm.common import read_table
from corpusmill.session import release, reliable_checkpoint


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.report(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", bpe_encoding),
]

#: SQL cannot express the learned and hashed stages; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is a Parquet table in the
    shared checkpoint folder, deleted once the next one is written."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        after = reliable_checkpoint(stage(spark, docs, sf_dir))
        release(docs)
        docs = after
    return docs
