"""Queries over the text tables, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    bin_slack,
    densified_minhash,
    grouping_genetic,
    licence_paragraphs,
    multi_index_simhash,
    nb_svm,
    ppm,
    role_repair,
    skip_chain_crf,
    source_mix,
    threshold_rules,
    warc_chunks,
    word_runs,
)
from starloom.llm.texts import table
from starloom.session import prepare


def op1_densified_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return densified_minhash.edits(table(spark, folder, "documents"))


def op2_skip_chain_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(prepare(spark), folder, "documents")
    found = skip_chain_crf.find(docs, ["doc_id"], skip_chain_crf.train(docs))
    return found.select(
        "doc_id", *[f"n_{k}" for k in skip_chain_crf.KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans"
    )


def op3_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return warc_chunks.round_trip(table(spark, folder, "pages")).select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        "refers_to", "intact",
    )


def op4_nb_svm(spark: SparkSession, folder: str) -> DataFrame:
    return nb_svm.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_ppm(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.corpus_scores(table(spark, folder, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op6_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    return bin_slack.packed(table(spark, folder, "documents"), ["doc_id"])


def op7_multi_index_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    groups = multi_index_simhash.near_duplicates(docs, ["doc_id"])
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.mixed(table(spark, folder, "documents"))


def op9_threshold_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(prepare(spark), folder, "documents")
    return threshold_rules.judged(docs, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_licence_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return licence_paragraphs.notices(table(spark, folder, "documents"))


def op11_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = word_runs.repeated_tails(table(spark, folder, "documents").select("doc_id", "text"))
    return word_runs.digests(word_runs.word_runs(docs, ["doc_id"]))


def op12_grouping_genetic(spark: SparkSession, folder: str) -> DataFrame:
    return grouping_genetic.packed(table(spark, folder, "documents"), ["doc_id"])


def op13_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = role_repair.damaged(table(spark, folder, "conversations"))
    return role_repair.repair(turns, copies=F.col("copies"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_densified_minhash, op2_skip_chain_crf, op3_warc_chunks, op4_nb_svm, op5_ppm, op6_bin_slack, op7_multi_index_simhash, op8_source_mix, op9_threshold_rules,
        op10_licence_paragraphs, op11_word_runs, op12_grouping_genetic, op13_role_repair,
    )
}
SQL: dict[str, str] = {"op3_warc_chunks": warc_chunks.sql(), "op9_threshold_rules": threshold_rules.sql()}
