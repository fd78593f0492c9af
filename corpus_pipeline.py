"""From raw documents to token files: each stage calls one operator of ``sluiceway.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm import stages
from sluiceway.llm.arrow import saved, table

STAGES = [
    ("quality", stages.keep_quality),
    ("near_duplicates", stages.one_of_each_group),
    ("decontamination", stages.without_benchmarks),
    ("mixing", stages.mixed),
    ("tokens", stages.token_files),
]

#: A trained classifier, XXH64 and a tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs, name)
    return docs
