"""A corpus pipeline over `documents`: quality rules, near-duplicates, personal data, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import bin_slack, multi_index_simhash, skip_chain_crf, source_mix, threshold_rules
from starloom.llm.texts import table
from starloom.session import prepare, work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that every quality rule keeps."""
    return threshold_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group whose fingerprints are linked."""
    return multi_index_simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data replaced by its kind."""
    return skip_chain_crf.mask(docs, skip_chain_crf.train(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix: whole copies, and the words of blocks drawn beyond them."""
    return source_mix.mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1,024 tokens with their places in the training sequences."""
    return bin_slack.packed(docs, ["doc_id", "source"])


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing sources", mixing),
    ("packing", packing),
]

# Hashes, a trained model and a tokenizer decide about rows here, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`; each one's rows are written as Parquet and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = work_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
