"""The named queries of this subpackage, each over its whole table."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import decontaminate, language, merkle, mixing, negatives, pages, pseudonyms, quality, repeats, simhash, tokens, vectors, warc
from sluiceway.llm.arrow import table
from sluiceway.llm.oracles import ORACLES
from sluiceway.llm.vocabularies import vocabulary

__all__ = ["ORACLES", "QUERIES"]


def op1_run_length_index(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf, "documents"))


def op2_rans_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_digests(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_host_suffix_text(spark: SparkSession, sf: str) -> DataFrame:
    return pages.main_text(table(spark, sf, "pages"))


def op4_neighbour_votes(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_va_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.top_k(table(spark, sf, "embeddings"))


def op6_feistel_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    if not spark.conf.get("spark.sluiceway.pseudonymKey", None):  # nobody can undo what a forgotten key made
        spark.conf.set("spark.sluiceway.pseudonymKey", secrets.token_hex(32))
    return pseudonyms.pseudonymise(table(spark, sf, "documents"), spark.conf.get("spark.sluiceway.pseudonymKey"))


def op7_source_schedule(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


def op8_warc_records(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages"))


def op9_winnowed_contamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op10_bk_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op11_l2ap_negatives(spark: SparkSession, sf: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf, "embeddings"), relabelled)


def op12_attention_scores(spark: SparkSession, sf: str) -> DataFrame:
    return language.score(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))


def op13_interval_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.manifest(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_run_length_index": op1_run_length_index,
    "op2_rans_tokens": op2_rans_tokens,
    "op3_host_suffix_text": op3_host_suffix_text,
    "op4_neighbour_votes": op4_neighbour_votes,
    "op5_va_top_k": op5_va_top_k,
    "op6_feistel_pseudonyms": op6_feistel_pseudonyms,
    "op7_source_schedule": op7_source_schedule,
    "op8_warc_records": op8_warc_records,
    "op9_winnowed_contamination": op9_winnowed_contamination,
    "op10_bk_simhash": op10_bk_simhash,
    "op11_l2ap_negatives": op11_l2ap_negatives,
    "op12_attention_scores": op12_attention_scores,
    "op13_interval_manifest": op13_interval_manifest,
}
