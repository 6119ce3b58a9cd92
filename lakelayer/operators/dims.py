"""Dimension tables: derived user columns, SKU enrichment, specs, upsert by change log.

Dimensions are kept as an append-only change log (one folder per batch) plus a
latest-per-key view; that replaces the keyed store with upsert of the warehouse.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import seconds_between
from ..sinks.batches import replace_batch
from .dedup import latest_per_key
from .joins import lookup_join

# Age band and gender labels of the warehouse.
AGE_LABELS = ("20岁及以下", "21岁到30岁", "30岁以上")
GENDER_LABELS = ("男", "女")
SECONDS_PER_YEAR = 86400 * 365


def derive_user(users: DataFrame, asof: str, labels=AGE_LABELS, genders=GENDER_LABELS) -> DataFrame:
    """Age band and gender name.

    Age counts whole 365-day years between birthday and ``asof``. Under 20 is
    the first band, over 30 the last, so 20 itself falls in the middle band.
    Gender ``M`` is the first name; anything else, null included, the second.
    """
    secs = seconds_between("birthday", F.lit(asof))
    years = secs / F.lit(SECONDS_PER_YEAR)
    age = F.when(secs >= 0, F.floor(years)).otherwise(F.ceil(years))  # truncate toward zero
    band = (
        F.when(age.isNull(), F.lit(None).cast("string"))
        .when(age < 20, F.lit(labels[0]))
        .when(age > 30, F.lit(labels[2]))
        .otherwise(F.lit(labels[1]))
    )
    gname = F.when(F.col("gender") == "M", F.lit(genders[0])).otherwise(F.lit(genders[1]))
    return users.withColumn("age_group", band).withColumn("gender_name", gname)


def enrich_sku(sku: DataFrame, trademark: DataFrame, category3: DataFrame, spu: DataFrame,
               order: Sequence[str] = ()) -> DataFrame:
    """SKU with trademark, category and SPU names; unmatched names stay null (D1). Of several rows
    of a dimension key the last by ``order`` counts (D7)."""
    tm = trademark.select(F.col("id").alias("_tm_id"), F.col("tm_name"), *order)
    c3 = category3.select(F.col("id").alias("_c3_id"), F.col("name").alias("category3_name"), *order)
    sp = spu.select(F.col("id").alias("_spu_id"), F.col("spu_name"), *order)
    out = lookup_join(sku, tm, F.col("tm_id"), "_tm_id", order)
    out = lookup_join(out, c3, F.col("category3_id"), "_c3_id", order)
    out = lookup_join(out, sp, F.col("spu_id"), "_spu_id", order)
    return out.select(*sku.columns, "category3_name", "spu_name", "tm_name")


@dataclass(frozen=True)
class DimSpec:
    """Name, key, column list and source topic of one dimension."""

    name: str
    key: str
    columns: tuple[str, ...]
    topic: str


# Dimension tables, their columns in sink order, and source topics.
DIM_SPECS = {
    "base_category3": DimSpec("gmall_base_category3", "id", ("id", "name", "category2_id"), "ods_base_category3"),
    "base_trademark": DimSpec("gmall_base_trademark", "id", ("id", "tm_name"), "ods_base_trademark"),
    "base_province": DimSpec("gmall_province_info", "id", ("id", "name", "area_code", "iso_code"), "ods_base_province"),
    "spu_info": DimSpec("gmall_spu_info", "id", ("id", "spu_name"), "ods_spu_info"),
    "sku_info": DimSpec(
        "gmall_sku_info",
        "id",
        ("id", "spu_id", "price", "sku_name", "tm_id", "category3_id", "create_time",
         "category3_name", "spu_name", "tm_name"),
        "ods_sku_info",
    ),
    "user_info": DimSpec(
        "gmall_user_info", "id", ("id", "user_level", "birthday", "gender", "age_group", "gender_name"), "ods_user_info"
    ),
    "user_status": DimSpec("user_status", "user_id", ("user_id", "if_consumed"), "dwd_order_info"),
}

BATCH_COL = "_batch"
ORDER_COL = "_ord"


def spec_columns(df: DataFrame, spec: DimSpec):
    return [F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in spec.columns]


def append_changes(df: DataFrame, spec: DimSpec, path: str, batch_id: int, order_col: str) -> None:
    """Write one batch of dimension rows to the change log.

    ``order_col`` (an offset, position or version) orders the changes of a key inside the batch;
    the last one counts and is the only one written. The batch's folder is replaced as a whole,
    so a replayed batch rewrites the same rows instead of adding copies.
    """
    ordered = df.withColumn(ORDER_COL, F.col(order_col).cast("bigint"))
    out = latest_per_key(ordered.select(*spec_columns(ordered, spec), ORDER_COL), [spec.key], [ORDER_COL, *spec.columns])
    replace_batch(out, path, BATCH_COL, batch_id)


def read_dim(spark: SparkSession, spec: DimSpec, path: str, before: int | None = None) -> DataFrame:
    """Latest row per key of a change log (A5 over our own store); ``before``: as it was before that batch."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in spec.columns] + [
        T.StructField(ORDER_COL, T.LongType()), T.StructField(BATCH_COL, T.LongType())])
    log = spark.read.schema(schema).parquet(path)
    if before is not None:
        log = log.where(F.col(BATCH_COL) < before)
    latest = latest_per_key(log, [spec.key], [BATCH_COL, ORDER_COL])
    return latest.select(*spec.columns)


def compact(spark: SparkSession, spec: DimSpec, path: str, out_path: str, batch_id: int = 0) -> None:
    """Rewrite the latest view as a single batch (to bound the log)."""
    latest = read_dim(spark, spec, path).withColumn(ORDER_COL, F.lit(0))
    append_changes(latest, spec, out_path, batch_id, ORDER_COL)
