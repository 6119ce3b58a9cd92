"""Amount per trademark.

The warehouse keys the sum by the text ``tm_id + "_" + tm_name`` and splits it
again, which cuts names containing ``_``; here the two are separate group
columns. An unmatched trademark id counts as 0 and its name stays null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import time_text, utc_wallclock
from ..functions.money import exact_sum


def _keys():
    return [
        F.coalesce(F.col("tm_id").cast("bigint"), F.lit(0).cast("bigint")).alias("trademark_id"),
        F.col("tm_name").alias("trademark_name"),
    ]


def trademark_total(wide: DataFrame) -> DataFrame:
    """All-up sum per trademark (E3); partial + final aggregate, one shuffle of partial sums."""
    return wide.groupBy(*_keys()).agg(
        exact_sum("final_detail_amount").alias("amount")
    )


def trademark_stat(wide: DataFrame, every: str = "5 seconds", ts_col: str = "create_time",
                   stat_time: str | None = None) -> DataFrame:
    """Sum per trademark per time bucket.

    The bucket is a tumbling event-time window, so a stream and a batch table
    give the same rows. ``stat_time`` is the bucket start as text unless a fixed
    stamp is given.
    """
    # the start says all of a bucket, so its end is not shuffled
    g = wide.groupBy(F.window(F.col(ts_col), every)["start"].alias("_start"), *_keys()).agg(
        exact_sum("final_detail_amount").alias("amount")
    )
    start = F.col("_start")
    if isinstance(wide.schema[ts_col].dataType, T.TimestampType):
        start = utc_wallclock(start)  # event-time instants are shown as UTC wall clock
    at = F.lit(stat_time) if stat_time else time_text(start)
    return g.select(at.alias("stat_time"), "trademark_id", "trademark_name", "amount")
