"""Lookup joins of facts to dimensions.

A lookup never multiplies rows: the dimension is cut to one row per key first. The join
carries no broadcast hint and no size is counted beforehand. AQE broadcasts a side whose
shuffle output it has measured to be small (in bytes) and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import latest_per_key


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key, dim_key: str, order: Sequence[str] = ()) -> DataFrame:
    """Left join of ``fact`` to one row per ``dim_key`` of ``dim``.

    Of several rows with a key, the last by ``order`` counts, ties (or no order) by the
    remaining columns, so the choice does not depend on arrival. A null key matches nothing.
    The columns of ``order`` and ``dim_key`` do not come along. ``dropDuplicates`` finds nothing to drop (and no
    shuffle to make): it tells the planner that keys are unique, so that a lookup whose columns nobody reads is
    left out.
    """
    rest = [c for c in dim.columns if c != dim_key and c not in order]
    last = latest_per_key(dim.where(F.col(dim_key).isNotNull()), [dim_key], [*order, *rest]).dropDuplicates([dim_key])
    return fact.join(last.drop(*order), fact_key == F.col(dim_key), "left").drop(dim_key)


def key_set(df: DataFrame, col: str, alias: str, cast: str | None = None) -> DataFrame:
    """Distinct non-null keys of one column (for existence joins)."""
    c = F.col(col)
    if cast:
        c = c.try_cast(cast)
    return df.select(c.alias(alias)).where(F.col(alias).isNotNull()).distinct()
