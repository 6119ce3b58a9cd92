"""From raw documents to token ids: quality filter, exact and near deduplication, benchmark
decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. A stage reads its input more than once, so between stages the
documents are written to the shared scratch folder, which also bounds what is redone when an
executor is lost. No stage is expressible in SQL as a whole (the first learns a model), so
there is no reference SQL; tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakelayer.llm.bounded import saved
from lakelayer.llm.decontaminate import without_leaks
from lakelayer.llm.exact_dedup import keep_first_copies
from lakelayer.llm.near_dup import keep_one_per_component
from lakelayer.llm.pieces import encoded
from lakelayer.llm.quality import keep_accepted
from lakelayer.llm.registry import table

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
