"""The warehouse layers composed from the operators, over the mapped driver tables.

ODS -> DWD (dimensions, enriched orders and lines) -> DWS (wide rows, payment
split) -> ADS (trademark sums), as DataFrame functions of (spark, sf_dir).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_seen
from ..operators.dau import dau_document, dau_first, start_log_calendar
from ..operators.dims import derive_user, enrich_sku
from ..operators.orders import (
    enrich_details,
    enrich_province,
    enrich_user,
    flag_first_order,
    order_calendar,
)
from ..operators.split import split_payment
from ..operators.wide import join_wide, lines_in_window
from ..sources import fixtures as fx


def user_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_user(fx.users(spark, sf_dir), fx.USER_ASOF)


def sku_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_sku(
        fx.sku_infos(spark, sf_dir), fx.trademarks(spark, sf_dir), fx.category3s(spark, sf_dir), fx.spus(spark, sf_dir)
    )


def flagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the first-order flag; the first orders come from the narrow order keys."""
    return flag_first_order(fx.order_infos(spark, sf_dir), fx.user_statuses(spark, sf_dir),
                            base=fx.order_keys(spark, sf_dir))


def dwd_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with calendar, first-order flag, province and user columns."""
    o = order_calendar(flagged_orders(spark, sf_dir))
    o = enrich_province(o, fx.provinces(spark, sf_dir))
    return enrich_user(o, user_dim(spark, sf_dir))


def dwd_details(spark: SparkSession, sf_dir: str, details: DataFrame | None = None) -> DataFrame:
    def by_sku(d: DataFrame) -> DataFrame:
        return enrich_details(d, sku_dim(spark, sf_dir))

    return by_sku(details) if details is not None else fx.order_details(spark, sf_dir, by_sku)


def wide_rows(spark: SparkSession, sf_dir: str, within_s: int | None = None,
              extra_details: DataFrame | None = None) -> DataFrame:
    """Order x line wide rows; ``within_s`` applies the sliding-window join."""
    lines = None if within_s is None and extra_details is None else fx.order_details(spark, sf_dir)
    if extra_details is not None:
        # repeated lines go before the join, on the lines' own narrow keys
        lines = first_seen(lines.unionByName(extra_details), ["order_id", "id"], ["create_time"])
    if within_s is not None:
        lines = lines_in_window(lines, fx.order_keys(spark, sf_dir), within_s)
    return join_wide(dwd_orders(spark, sf_dir), dwd_details(spark, sf_dir, lines), within_s=within_s)


def paid_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every order with its share of the paid amount."""
    return split_payment(wide_rows(spark, sf_dir, within_s=None))


def dau_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First start per device per day, as DAU documents."""
    return dau_document(dau_first(start_log_calendar(fx.start_logs(spark, sf_dir))))


def dim_versions(dim: DataFrame, changed: str, versions=(1, 2, 3)) -> DataFrame:
    """Several versions per key (test input for upserts): ``changed`` gets a ' v<N>' suffix.

    Version N of key K exists unless (K + N) is divisible by 4.
    """
    out = dim.withColumn("version", F.explode(F.array(*[F.lit(v) for v in versions])))
    out = out.where((F.col("id").cast("bigint") + F.col("version")) % 4 != 0)
    return out.withColumn(changed, F.concat(F.col(changed), F.lit(" v"), F.col("version").cast("string")))
