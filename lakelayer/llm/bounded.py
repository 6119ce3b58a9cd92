"""Broadcast only what is known to be small."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

BROADCAST_ROWS = 1_000_000  # of one or two integers


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back; cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(keys: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``keys`` (one or two integer columns), for a join: broadcast if its counted rows are within the limit,
    else left to a shuffle join."""
    keys = saved(keys, "keys")
    return F.broadcast(keys) if keys.count() <= limit else keys


def filtered(docs: DataFrame, keys: DataFrame, on: list[Column], how: str) -> DataFrame:
    """``docs`` joined (left_semi or left_anti) to ``keys``, whose columns answer to ``on``; nulls
    equal nulls. Whatever columns ``docs`` has, they stay as they are."""
    names = [f"k{i}" for i in range(len(on))]
    wrapped = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
                          *(c.alias(n) for c, n in zip(on, names)))
    keys = keys.toDF(*(f"of_{n}" for n in names))
    same = reduce(and_, (F.col(n).eqNullSafe(F.col(f"of_{n}")) for n in names))
    return wrapped.join(keys, same, how).select("doc.*")
