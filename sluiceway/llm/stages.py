"""The stages of the corpus pipeline: ``(spark, docs, sf_dir)`` to a table with the columns of ``docs`` (but the last)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm import decontaminate, mixing, quality, simhash, tokens
from sluiceway.llm.arrow import saved, table
from sluiceway.llm.vocabularies import vocabulary


_KEY = "_key"


def _said(text: str = "text") -> Column:
    """A text's hash; null is a text of its own."""
    return F.coalesce(F.sha2(text, 256), F.lit("-"))


def _row_key(docs: DataFrame) -> Column:
    """Id and text of a row as a string that sorts by the id, rows without one last. Equal rows share it."""
    doc_id = F.col("doc_id")
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        order = F.lpad(F.hex(doc_id.cast("long").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))), 16, "0")
    else:
        order = doc_id.cast("string")
    return F.concat(F.when(doc_id.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), order)), F.lit("|"), _said())


def _with(docs: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows whose key is one of ``keys``."""
    return docs.withColumn(_KEY, key).join(keys.select(_KEY).distinct(), _KEY, "left_semi")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.withColumn("_accepted_score", quality.score_column(docs, F.col("text"), model))
    return scored.where(F.col("_accepted_score") >= quality.ACCEPT).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three-word shingles, three bits): that with the smallest id, rows without an
    id coming last, and of rows that share it that with the least hash of its text.

    Rows are told apart by id and text, so one is never left out for its id alone; wholly equal ones stay once.
    """
    groups = simhash.near_duplicates(docs.select(_row_key(docs).alias(_KEY), "text"), _KEY)
    first = _with(docs, _row_key(docs), groups.where(F.col(_KEY) == F.col("component_id")))
    return first.dropDuplicates([_KEY]).select(docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which under a twentieth of the words is in windows of the benchmark; each text is judged by itself."""
    judged = decontaminate.contamination(docs.select(_said().alias(_KEY), "text"), table(spark, sf_dir, "benchmark"), _KEY)
    return _with(docs, _said(), judged.where("not contaminated")).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source schedule takes them, row by row: the rows are numbered in a written table."""
    rows = saved(docs.withColumn(_KEY, F.monotonically_increasing_id()), "numbered")
    return mixing.applied(rows, saved(mixing.mix(rows, row_col=_KEY), "mix"), _KEY).select(docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and what reading them back gives per document."""
    return tokens.token_digests(docs, vocabulary("byte_bpe_50k.json"))
