"""Keep one row per key.

``row_number() = 1`` plans a group limit before the shuffle (each task keeps its best row per
key, so a key holding a third of all rows sends one row per task) and no aggregate over whole
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the one with the smallest ``order`` (ties need a unique last column)."""
    return _one(df, keys, [F.col(c).asc() for c in order])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the one with the largest ``order`` (last write wins)."""
    return _one(df, keys, [F.col(c).desc() for c in order] or [F.lit(0)])
