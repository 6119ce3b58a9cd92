"""Daily active devices (B3, B8, F1): the first start of each device each day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_text, wallclock_of_epoch_ms
from .dedup import first_seen


def start_log_calendar(logs: DataFrame, zone: str = "UTC") -> DataFrame:
    """dt (date) and hr (hour) of the epoch-ms ``ts`` in ``zone``."""
    wall = wallclock_of_epoch_ms(F.col("ts"), zone)
    return logs.withColumn("dt", F.to_date(wall)).withColumn("hr", F.hour(wall))


def dau_first(logs: DataFrame) -> DataFrame:
    """First start per (day, device), by time then event id (F1, batch form)."""
    keyed = logs.withColumn("_mid", F.col("common.mid"))
    order = ["ts", "event_id"] if "event_id" in logs.columns else ["ts"]
    return first_seen(keyed, ["dt", "_mid"], order).drop("_mid")


def dau_document(logs: DataFrame, *more: str | Column) -> DataFrame:
    """Start log -> DAU document keyed by device (B8); minute is the constant '00'. ``more`` columns come along."""
    return logs.select(
        F.col("common.mid").alias("mid"),
        F.col("common.uid").alias("uid"),
        F.col("common.ar").alias("ar"),
        F.col("common.ch").alias("ch"),
        F.col("common.vc").alias("vc"),
        date_text("dt").alias("dt"),
        F.col("hr").cast("string").alias("hr"),
        F.lit("00").alias("mi"),
        F.col("ts"),
        *more,
    )
