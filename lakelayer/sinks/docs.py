"""Index documents by id into one index per day.

The document store replaces a document with the same id. Here each write is
one batch folder under its day; a reader takes the latest batch per (day, id).
Rewriting the same batch id replaces that folder, so a replayed batch does not
add copies. Each row goes to its own day (the warehouse used the first row's).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_key
from .batches import replace_batch

DAY_COL = "day"
BATCH_COL = "batch_id"


def daily_docs(df: DataFrame, day: str, doc_id: str, order: Sequence[str]) -> DataFrame:
    """``df`` with its day and document id; the last row per (day, id) by ``order``."""
    staged = df.withColumn(DAY_COL, F.col(day).cast("string")).withColumn("_doc_id", F.col(doc_id).cast("string"))
    return latest_per_key(staged, [DAY_COL, "_doc_id"], order)


def write_daily_docs(df: DataFrame, day: str, doc_id: str, path: str, batch_id: int, order: Sequence[str]) -> None:
    """Write one batch of documents; within the batch the last row per (day, id) by ``order`` wins.

    A replayed batch replaces what it wrote before, also where it has no rows for a day now.
    """
    replace_batch(daily_docs(df, day, doc_id, order), path, BATCH_COL, batch_id, [DAY_COL])


def latest_docs(docs: DataFrame) -> DataFrame:
    """The current documents: latest batch per (day, id)."""
    latest = latest_per_key(docs, [DAY_COL, "_doc_id"], [BATCH_COL])
    return latest.drop("_doc_id", BATCH_COL)


def read_daily_docs(spark: SparkSession, path: str) -> DataFrame:
    """The current documents of an index folder."""
    return latest_docs(spark.read.parquet(path).withColumn(DAY_COL, F.col(DAY_COL).cast("string")))
