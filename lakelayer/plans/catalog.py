"""Registered queries: key -> (spark, sf_dir) -> DataFrame, and their reference SQL.

Outputs use plain types on both sides (bigint, double, text), times as
``yyyy-MM-dd HH:mm:ss`` text, so the two engines compare value for value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.money import as_double
from ..operators.orders import (
    enrich_province,
    enrich_user,
    flag_against_status,
    new_user_status,
    order_calendar,
)
from ..operators.cdc import route_array_feed, route_row_feed
from ..operators.dau import start_log_calendar
from ..operators.dedup import latest_per_key
from ..operators.dims import DIM_SPECS, append_changes, read_dim
from ..operators.stats import trademark_stat, trademark_total
from ..session import scratch_path
from ..sinks.docs import read_daily_docs, write_daily_docs
from ..sinks.topics import to_topic, write_topics
from ..sources import feeds
from ..sources import fixtures as fx
from ..sources.decode import ORDER_INFO_SCHEMA, decode
from . import warehouse as W
from .oracle import money_out, round_cents_sql, sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = sql(oracle)
        return fn

    return deco


def _t(col: str):
    return D.time_text(F.col(col)).alias(col)


# ------------------------------------------------------------------ DWS / ADS

@register("order_pay_split", """
SELECT order_detail_id, order_id, CAST(sku_price AS DOUBLE) AS sku_price, sku_num,
       CAST(original_total_amount AS DOUBLE) AS original_total_amount,
       CAST(final_total_amount AS DOUBLE) AS final_total_amount,
       CAST(final_detail_amount AS DOUBLE) AS final_detail_amount
FROM wide_paid""")
def order_pay_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.paid_wide(spark, sf_dir)
    return w.select(
        "order_detail_id", "order_id", as_double("sku_price").alias("sku_price"), "sku_num",
        as_double("original_total_amount").alias("original_total_amount"),
        as_double("final_total_amount").alias("final_total_amount"),
        as_double("final_detail_amount").alias("final_detail_amount"),
    )


@register("trademark_amount_total", f"""
SELECT COALESCE(tm_id, 0) AS trademark_id, tm_name AS trademark_name,
       {money_out(round_cents_sql('SUM(final_detail_amount)'), 'amount')}
FROM wide_paid GROUP BY COALESCE(tm_id, 0), tm_name""")
def trademark_amount_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trademark_total(W.paid_wide(spark, sf_dir))
    return t.select("trademark_id", "trademark_name", as_double("amount").alias("amount"))


@register("trademark_amount_stat", f"""
SELECT strftime(make_timestamp((epoch_ms(create_time) // 5000) * 5000 * 1000), '%Y-%m-%d %H:%M:%S') AS stat_time,
       COALESCE(tm_id, 0) AS trademark_id, tm_name AS trademark_name,
       {money_out(round_cents_sql('SUM(final_detail_amount)'), 'amount')}
FROM wide_paid GROUP BY 1, 2, 3""")
def trademark_amount_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = trademark_stat(W.paid_wide(spark, sf_dir), every="5 seconds")
    return s.select("stat_time", "trademark_id", "trademark_name", as_double("amount").alias("amount"))


_WIDE_OUT = """order_detail_id, order_id, order_status, strftime(create_time, '%Y-%m-%d %H:%M:%S') AS create_time,
       user_id, sku_id, CAST(sku_price AS DOUBLE) AS sku_price, sku_num, sku_name,
       CAST(benefit_reduce_amount AS DOUBLE) AS benefit_reduce_amount, CAST(feight_fee AS DOUBLE) AS feight_fee,
       CAST(original_total_amount AS DOUBLE) AS original_total_amount,
       CAST(final_total_amount AS DOUBLE) AS final_total_amount, if_first_order, province_name,
       province_area_code, user_age_group, user_gender, dt, spu_id, tm_id, category3_id, spu_name, tm_name,
       category3_name"""

_MONEY_WIDE = ("sku_price", "benefit_reduce_amount", "feight_fee", "original_total_amount", "final_total_amount")


def wide_out(w: DataFrame) -> DataFrame:
    cols = []
    for c in w.columns:
        if c == "final_detail_amount":
            continue
        if c in _MONEY_WIDE:
            cols.append(as_double(c).alias(c))
        elif c == "create_time":
            cols.append(_t(c))
        else:
            cols.append(F.col(c))
    return w.select(*cols)


@register("order_wide_join", f"SELECT {_WIDE_OUT} FROM wide_window")
def order_wide_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_out(W.wide_rows(spark, sf_dir, within_s=20))


# ------------------------------------------------------------------ DWD orders

@register("order_calendar", """
SELECT id, strftime(create_time, '%Y-%m-%d %H:%M:%S') AS create_time,
       strftime(create_time, '%Y-%m-%d') AS create_date, CAST(hour(create_time) AS VARCHAR) AS create_hour
FROM order_info""")
def order_calendar_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = order_calendar(fx.order_infos(spark, sf_dir))
    return o.select("id", _t("create_time"), "create_date", "create_hour")


@register("order_first_vs_status", """
SELECT id, user_id, if_first_order FROM order_status_flag""")
def order_first_vs_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = flag_against_status(fx.order_infos(spark, sf_dir), fx.user_statuses(spark, sf_dir))
    return o.select("id", "user_id", "if_first_order")


@register("order_first_flag", """
SELECT id, user_id, strftime(create_time, '%Y-%m-%d %H:%M:%S') AS create_time, if_first_order FROM order_first""")
def order_first_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = W.flagged_orders(spark, sf_dir)
    return o.select("id", "user_id", _t("create_time"), "if_first_order")


@register("user_status_new", """
SELECT CAST(user_id AS VARCHAR) AS user_id, '1' AS if_consumed FROM order_first WHERE if_first_order = '1'""")
def user_status_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_user_status(W.flagged_orders(spark, sf_dir))


@register("order_enrich_province", """
SELECT o.id, o.province_id, p.name AS province_name, p.area_code AS province_area_code,
       p.iso_code AS province_iso_code
FROM order_info o LEFT JOIN province_info p ON p.id = CAST(o.province_id AS VARCHAR)""")
def order_enrich_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = enrich_province(fx.order_infos(spark, sf_dir), fx.provinces(spark, sf_dir))
    return o.select("id", "province_id", "province_name", "province_area_code", "province_iso_code")


@register("order_enrich_user", """
SELECT o.id, o.user_id, u.age_group AS user_age_group, u.gender_name AS user_gender
FROM order_info o LEFT JOIN user_dim u ON u.id = CAST(o.user_id AS VARCHAR)""")
def order_enrich_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = enrich_user(fx.order_infos(spark, sf_dir), W.user_dim(spark, sf_dir))
    return o.select("id", "user_id", "user_age_group", "user_gender")


@register("order_detail_enrich", """
SELECT id, order_id, sku_id, spu_id, tm_id, category3_id, spu_name, tm_name, category3_name FROM detail_dwd""")
def order_detail_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = W.dwd_details(spark, sf_dir)
    return d.select("id", "order_id", "sku_id", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
                    "category3_name")


# ------------------------------------------------------------------ DWD dimensions

@register("user_dim_derive", "SELECT id, user_level, birthday, gender, age_group, gender_name FROM user_dim")
def user_dim_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.user_dim(spark, sf_dir).select("id", "user_level", "birthday", "gender", "age_group", "gender_name")


@register("sku_dim_enrich", """
SELECT id, spu_id, price, sku_name, tm_id, category3_id, create_time, category3_name, spu_name, tm_name
FROM sku_dim""")
def sku_dim_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.sku_dim(spark, sf_dir)


# ------------------------------------------------------------------ dates

@register("date_scalars", """
SELECT id, epoch_ms(create_time) - 8 * 3600 * 1000 AS create_epoch_ms,
       date_diff('second', create_time, expire_time) AS expire_seconds,
       (order_status IS NULL OR order_status = '') AS status_blank
FROM order_info""")
def date_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.order_infos(spark, sf_dir).select("id", _t("create_time"), _t("expire_time"), "order_status")
    return o.select(
        "id",
        D.epoch_ms(F.col("create_time"), "+08:00").alias("create_epoch_ms"),
        D.seconds_between(F.col("create_time"), F.col("expire_time")).alias("expire_seconds"),
        D.is_blank(F.col("order_status")).alias("status_blank"),
    )


# ------------------------------------------------------------------ ODS: change feeds

_ARRAY_ROUTED = """
SELECT 'ods_order_info' AS topic, CAST(o_orderkey AS VARCHAR) AS id, 7 AS n_fields FROM orders
 WHERE (o_orderkey // 3) % 4 = 0
UNION ALL SELECT 'ods_order_detail', CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), 12
 FROM lineitem WHERE (l_orderkey + l_linenumber) % 4 = 0
UNION ALL SELECT 'ods_sku_info', CAST(p_partkey AS VARCHAR), 7 FROM part WHERE (p_partkey // 3) % 4 = 0
UNION ALL SELECT 'ods_base_province', CAST(n_nationkey AS VARCHAR), 4 FROM nation WHERE (n_nationkey // 3) % 4 = 0"""

_ROW_ROUTED = """
SELECT 'ods_order_info' AS topic, CAST(o_orderkey AS VARCHAR) AS id, 7 AS n_fields FROM orders
 WHERE o_orderkey % 4 = 0
UNION ALL SELECT 'ods_order_detail', CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), 12
 FROM lineitem WHERE (l_orderkey + l_linenumber) % 4 = 0
UNION ALL SELECT 'ods_sku_info', CAST(p_partkey AS VARCHAR), 7 FROM part WHERE p_partkey % 4 <> 3
UNION ALL SELECT 'ods_base_province', CAST(n_nationkey AS VARCHAR), 4 FROM nation WHERE n_nationkey % 4 <> 3"""


def _routed_out(routed: DataFrame) -> DataFrame:
    return routed.select(
        "topic",
        F.get_json_object(F.col("value"), "$.id").alias("id"),
        F.size(F.json_object_keys(F.col("value"))).cast("bigint").alias("n_fields"),
    )


@register("cdc_route_array", _ARRAY_ROUTED)
def cdc_route_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed_out(route_array_feed(feeds.array_feed(spark, sf_dir)))


@register("cdc_route_row", _ROW_ROUTED)
def cdc_route_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed_out(route_row_feed(feeds.row_feed(spark, sf_dir)))


@register("cdc_topic_counts", f"SELECT topic, COUNT(*) AS n FROM ({_ROW_ROUTED}) GROUP BY topic")
def cdc_topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed rows written one folder per topic, then counted back per topic."""
    path = scratch_path(spark, "topics")
    write_topics(route_row_feed(feeds.row_feed(spark, sf_dir)), path=path, fmt="parquet")
    back = spark.read.parquet(path)
    return back.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@register("to_topic_json", """
SELECT 'dwd_order_detail' AS topic, CAST(id AS VARCHAR) AS key,
       CAST(to_json(struct_pack(id := id, order_id := order_id, sku_id := sku_id, order_price := order_price,
                                sku_num := sku_num, sku_name := sku_name,
                                create_time := strftime(create_time, '%Y-%m-%d %H:%M:%S'))) AS VARCHAR) AS value
FROM order_detail""")
def to_topic_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fx.order_details(spark, sf_dir).select(
        "id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", _t("create_time"))
    return to_topic(d, "dwd_order_detail", key="id")


@register("json_decode", """
SELECT id, province_id, order_status, user_id, CAST(final_total_amount AS DOUBLE) AS final_total_amount,
       CAST(benefit_reduce_amount AS DOUBLE) AS benefit_reduce_amount,
       CAST(original_total_amount AS DOUBLE) AS original_total_amount, CAST(feight_fee AS DOUBLE) AS feight_fee,
       strftime(expire_time, '%Y-%m-%d %H:%M:%S') AS expire_time,
       strftime(create_time, '%Y-%m-%d %H:%M:%S') AS create_time,
       strftime(operate_time, '%Y-%m-%d %H:%M:%S') AS operate_time
FROM order_info""")
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published as text with every value quoted and upper-case keys, decoded back."""
    o = fx.order_infos(spark, sf_dir)
    text = o.select(F.to_json(F.struct(*[
        (D.time_text(F.col(c)) if dict(o.dtypes)[c] == "timestamp_ntz" else F.col(c).cast("string")).alias(c.upper())
        for c in o.columns])).alias("value"))
    good, _bad = decode(text, ORDER_INFO_SCHEMA)
    return good.select(
        "id", "province_id", "order_status", "user_id",
        *[as_double(c).alias(c) for c in ("final_total_amount", "benefit_reduce_amount",
                                          "original_total_amount", "feight_fee")],
        _t("expire_time"), _t("create_time"), _t("operate_time"),
    )


# ------------------------------------------------------------------ DAU

@register("start_log_calendar", """
SELECT mid, ts, event_id, strftime(dt, '%Y-%m-%d') AS dt, CAST(hr AS BIGINT) AS hr FROM start_log""")
def start_log_calendar_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = start_log_calendar(fx.start_logs(spark, sf_dir))
    return s.select(F.col("common.mid").alias("mid"), "ts", "event_id",
                    D.date_text("dt").alias("dt"), F.col("hr").cast("bigint").alias("hr"))


_DAU_OUT = "mid, uid, ar, ch, vc, dt, hr, mi, ts"


@register("dau_first_seen", f"SELECT {_DAU_OUT} FROM dau_docs")
def dau_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.dau_docs(spark, sf_dir)


@register("daily_doc_index", f"SELECT dt AS day, {_DAU_OUT} FROM dau_docs")
def daily_doc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAU documents indexed per day; batch 0 is delivered twice and batch 1 repeats it."""
    # Persisted (memory, then disk) across the three deliveries; a lost block is recomputed.
    docs = W.dau_docs(spark, sf_dir).persist()
    path = scratch_path(spark, "dau-index")
    try:
        for batch_id in (0, 0, 1):
            write_daily_docs(docs, "dt", "mid", path, batch_id, order=["ts"])
    finally:
        docs.unpersist()
    return read_daily_docs(spark, path).select("day", *_DAU_OUT.split(", "))


# ------------------------------------------------------------------ dimension store

_SKU_COLS = "id, spu_id, price, sku_name, tm_id, category3_id, create_time, category3_name, spu_name, tm_name"


@register("dim_upsert_latest", f"""
SELECT {_SKU_COLS}, version FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM (
    SELECT id, spu_id, price, sku_name || ' v' || CAST(version AS VARCHAR) AS sku_name, tm_id, category3_id,
           create_time, category3_name, spu_name, tm_name, version
    FROM (SELECT *, unnest([1, 2, 3]) AS version FROM sku_dim)
    WHERE (CAST(id AS BIGINT) + version) % 4 <> 0))
WHERE rn = 1""")
def dim_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = W.dim_versions(W.sku_dim(spark, sf_dir), "sku_name")
    spec = DIM_SPECS["sku_info"]
    return latest_per_key(versions.select(*spec.columns, "version"), [spec.key], ["version"])


@register("dim_scan", """
SELECT id, user_level, birthday, gender, age_group, gender_name FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM (
    SELECT id, user_level || ' v' || CAST(version AS VARCHAR) AS user_level, birthday, gender, age_group,
           gender_name, version
    FROM (SELECT *, unnest([1, 2, 3]) AS version FROM user_dim)
    WHERE (CAST(id AS BIGINT) + version) % 4 <> 0))
WHERE rn = 1""")
def dim_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension written to its change log in three batches, then scanned as the latest view."""
    spec = DIM_SPECS["user_info"]
    versions = W.dim_versions(W.user_dim(spark, sf_dir), "user_level")
    path = scratch_path(spark, "dim-user")
    for v in (1, 2, 3):
        append_changes(versions.where(F.col("version") == v), spec, path, batch_id=v, order_col="version")
    return read_dim(spark, spec, path)


# ------------------------------------------------------------------ DWS de-duplication

@register("order_wide_dedup", f"SELECT {_WIDE_OUT} FROM wide_window")
def order_wide_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines delivered twice (every id divisible by 7 once more) still give one wide row each."""
    details = fx.order_details(spark, sf_dir)
    again = details.where(F.col("id") % 7 == 0)
    return wide_out(W.wide_rows(spark, sf_dir, within_s=20, extra_details=again))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# The streaming twins register themselves on import.
from . import stream_catalog  # noqa: E402,F401
