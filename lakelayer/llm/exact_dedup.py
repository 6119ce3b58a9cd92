r"""Exact deduplication of whole texts, DataFrame functions only.

Texts are equal when they are identical after every run of ``[\x20\x09-\x0D]``
becomes one space. Rows are grouped by a 128-bit content hash together with the
normalised text itself, so two texts whose hashes collide still form two groups:
the bytes are compared inside the hash group. The grouping is an aggregate with
map-side combine, so a text held by a third of all rows reaches its reducer as
one row per map task. Every document then looks its group up by hash and by the
SHA-256 that the result carries anyway; the text itself is shuffled once, as
distinct texts.

Defined cases: a null text counts as empty; a null or repeated ``doc_id`` is kept
as it is (the smallest non-null id stays; rows that share the kept id are all
marked kept); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bounded import filtered
from .registry import register, table

SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def exact_groups(docs: DataFrame, content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per distinct normalised text: ``h`` (content hash), ``text_sha256``,
    ``keep_id`` (smallest id), ``group_size``."""
    rows = docs.select(F.col("doc_id"), normalised(F.col("text")).alias("body"))
    return (
        rows.groupBy(content_hash(F.col("body")).alias("h"), "body")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("h", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size")
    )


def exact_dedup(docs: DataFrame, content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """Every row of ``docs`` with its group: doc_id, keep_id, group_size, kept, text_sha256."""
    body = normalised(F.col("text"))
    rows = docs.select(F.col("doc_id"), body.alias("body")).select(
        "doc_id", content_hash(F.col("body")).alias("h"), F.sha2("body", 256).alias("text_sha256"))
    groups = exact_groups(docs, content_hash)
    return rows.join(groups, ["h", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the later copies of equal texts; all columns stay."""
    kept = exact_groups(docs).select("keep_id", "text_sha256")
    return filtered(docs, kept, [F.col("doc_id"), F.sha2(normalised(F.col("text")), 256)], "left_semi")


@register("op9_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))
