"""Decode JSON text into typed rows (A2).

The warehouse's JSON library ignores unknown keys, leaves missing ones null,
accepts quoted numbers and matches names regardless of case. ``from_json`` with
a typed schema does none of the last two, so the text is read as a
``map<string,string>`` (any JSON value becomes its text) and each field is looked up by its
lower-cased name, the last one counting where a name comes twice, and ``try_cast`` to its type.
Numbers keep their digits (``json_numbers``). Unreadable text goes to a separate
quarantine frame instead of failing the batch or vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_time
from ..functions.json_numbers import at_risk, freed, shielded

_MAP = "map<string,string>"


def field_value(fields: Column, name: str, dtype: T.DataType) -> Column:
    same = F.filter(fields, lambda f: f["key"] == name.lower())
    raw = F.get(same, F.size(same) - 1)["value"]
    if isinstance(dtype, T.TimestampNTZType):
        return parse_time(raw)
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.BooleanType):
        low = F.lower(raw)
        return F.when(low.isin("true", "1"), F.lit(True)).when(low.isin("false", "0"), F.lit(False))
    return raw.try_cast(dtype)


def parsed_fields(value: Column) -> Column:
    """The fields of a JSON object as (lower-cased key, value text), in order; names may repeat."""
    def entries(text: Column, own) -> Column:
        return F.transform(F.map_entries(F.from_json(text, _MAP)),
                           lambda e: F.struct(F.lower(own(e["key"])).alias("key"), own(e["value"]).alias("value")))

    return F.when(at_risk(value), entries(shielded(value), freed)).otherwise(entries(value, lambda t: t))


def decode(df: DataFrame, schema: T.StructType, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows typed by ``schema``, quarantined input rows whose text is not a JSON object)."""
    keep = [c for c in df.columns if c != value]
    staged = df.withColumn("_m", parsed_fields(F.col(value)))
    good = staged.where(F.col("_m").isNotNull()).select(
        *keep, *[field_value(F.col("_m"), f.name, f.dataType).alias(f.name) for f in schema.fields]
    )
    bad = staged.where(F.col("_m").isNull()).drop("_m")
    return good, bad


# The order message as published by the fact job.
ORDER_INFO_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("province_id", T.LongType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("final_total_amount", T.DecimalType(18, 2)),
    T.StructField("benefit_reduce_amount", T.DecimalType(18, 2)),
    T.StructField("original_total_amount", T.DecimalType(18, 2)),
    T.StructField("feight_fee", T.DecimalType(18, 2)),
    T.StructField("expire_time", T.TimestampNTZType()),
    T.StructField("create_time", T.TimestampNTZType()),
    T.StructField("operate_time", T.TimestampNTZType()),
])

ORDER_DETAIL_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("order_price", T.DecimalType(18, 2)),
    T.StructField("sku_num", T.LongType()),
    T.StructField("sku_name", T.StringType()),
    T.StructField("create_time", T.TimestampNTZType()),
])

START_LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("common", T.StringType()),
    T.StructField("start", T.StringType()),
])

COMMON_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                              ("ar", "uid", "os", "ch", "md", "mid", "vc", "ba")])
START_SCHEMA = T.StructType([
    T.StructField("entry", T.StringType()),
    T.StructField("open_ad_skip_ms", T.IntegerType()),
    T.StructField("open_ad_ms", T.IntegerType()),
    T.StructField("loading_time", T.IntegerType()),
    T.StructField("open_ad_id", T.IntegerType()),
])


def decode_struct(text: Column, schema: T.StructType) -> Column:
    """A nested JSON object (kept as text by ``decode``) to a struct, same rules."""
    m = parsed_fields(text)
    return F.struct(*[field_value(m, f.name, f.dataType).alias(f.name) for f in schema.fields])


def decode_start_log(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    good, bad = decode(df, START_LOG_SCHEMA, value)
    good = good.withColumn("common", decode_struct(F.col("common"), COMMON_SCHEMA)).withColumn(
        "start", decode_struct(F.col("start"), START_SCHEMA))
    return good, bad
