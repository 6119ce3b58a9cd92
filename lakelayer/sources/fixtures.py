"""Driver tables mapped to the warehouse's row types.

The warehouse reads change records of a shop database; the test data is a
TPC-H-like star schema. These functions turn the latter into the former with
integer arithmetic on keys only, so that Spark and the SQL oracle agree. Every
function reads whole tables and returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import add_seconds, epoch_ms_of_wallclock
from ..functions.money import MONEY, money
from ..operators.prefix import grouped_prefix_sums

# Fixed values of the mapping (see FIXTURES.md).
ORDER_TIME_MULTIPLIER = 7919
SECONDS_PER_DAY = 86400
LINE_TIME_SPREAD = 40
FREIGHT = "10.00"
P_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]  # category3 ids 1..6
SKU_CREATE_TIME = "2024-01-01 00:00:00"
USER_ASOF = "2024-01-01 00:00:00"
BIRTHDAY_BASE = "1960-01-01"
CATEGORY2_ID = "1"
LINES_PER_SLICE = 4096


# The driver tables' columns. Reading with a schema runs no job while a query is built.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(oid, ctime): each order's create time, spread over its day by key."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("oid"), _order_ctime().alias("ctime"))


def _order_ctime():
    offset = (F.col("o_orderkey") * ORDER_TIME_MULTIPLIER) % SECONDS_PER_DAY
    return add_seconds("o_orderdate", offset)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with ``line_no``: position of the line in its order.

    ``(l_orderkey, l_linenumber)`` repeats in the data, so the position is taken
    over the unique (linenumber, partkey, suppkey, shipdate) order.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    li = grouped_prefix_sums(
        li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"], {"_one": F.lit(1)},
        [F.floor(F.col("l_linenumber") / LINES_PER_SLICE)],
    )
    return li.withColumn("line_no", F.col("_one_before") + 1).drop("_one_before")


def order_details(spark: SparkSession, sf_dir: str, enrich: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """OrderDetail rows: id, order_id, sku_id, order_price, sku_num, sku_name, create_time. ``enrich`` may add columns by
    SKU; lines are shuffled by the SKU's text once for the part and for it, then by the order."""
    lines = order_lines(spark, sf_dir)
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    times = order_times(spark, sf_dir)
    # part and order keys are unique in their tables
    d = lines.join(part, lines.l_partkey.cast("string") == part.p_partkey.cast("string"), "left")
    d = enrich(d.select(
        (F.col("l_orderkey") * 1000 + F.col("line_no")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        money("p_retailprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.col("p_name").alias("sku_name"),
        ((F.col("l_partkey") + F.col("line_no") * 5) % LINE_TIME_SPREAD).alias("create_time"),  # seconds after its order
    ))
    return d.join(times, d.order_id == times.oid, "left").select(
        *(add_seconds("ctime", F.col(c)).alias(c) if c == "create_time" else c for c in d.columns))


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(_tid, _orig): the sum over an order's lines, from three columns of the lines and two of the parts."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    amount = money("p_retailprice") * F.col("l_quantity").cast("bigint")
    return li.join(part, li.l_partkey == part.p_partkey, "left").groupBy(F.col("l_orderkey").alias("_tid")).agg(
        F.sum(amount).cast(MONEY).alias("_orig"))


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, user_id, create_time) of the orders, from the orders alone."""
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderkey").isNotNull())
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), _order_ctime().alias("create_time"))


def order_infos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OrderInfo rows; the original total is the sum over the order's lines."""
    # The create time comes from the order's own date, so no join back to orders is needed.
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderkey").isNotNull()).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", _order_ctime().alias("ctime"))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    totals = order_totals(spark, sf_dir)
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    j = j.join(totals, j.o_orderkey == totals._tid, "left")
    orig = F.coalesce(F.col("_orig"), F.lit(0).cast(MONEY)).cast(MONEY)
    final = money("o_totalprice")
    freight = F.lit(FREIGHT).cast(MONEY)
    return j.select(
        F.col("o_orderkey").alias("id"),
        _without_match(F.col("c_nationkey").cast("bigint"), F.col("c_nationkey") == 24, 100).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        final.alias("final_total_amount"),
        (orig + freight - final).cast(MONEY).alias("benefit_reduce_amount"),
        orig.alias("original_total_amount"),
        freight.alias("feight_fee"),
        add_seconds("ctime", 900).alias("expire_time"),
        F.col("ctime").alias("create_time"),
        add_seconds("ctime", 60).alias("operate_time"),
    )


# ---------------------------------------------------------------- dimensions

def _category3_id(col: str):
    expr = None
    for i, name in enumerate(P_TYPES, start=1):
        expr = (F.when(F.col(col) == name, F.lit(str(i))) if expr is None
                else expr.when(F.col(col) == name, F.lit(str(i))))
    return expr


def _without_match(key, hit, shift: int):
    """``key``, moved beyond the dimension's keys where ``hit``, so that some facts find no match."""
    return F.when(hit, key + shift).otherwise(key)


def sku_infos(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    tm = F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).cast("bigint")
    c3 = _category3_id("p_type").cast("bigint")
    return p.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_size").cast("string").alias("spu_id"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_name").alias("sku_name"),
        _without_match(tm, tm % 10 == 0, 900).cast("string").alias("tm_id"),
        _without_match(c3, c3 == 6, 900).cast("string").alias("category3_id"),
        F.lit(SKU_CREATE_TIME).alias("create_time"),
    )


def trademarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    tm = F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit(""))
    return p.select(tm.alias("id"), F.col("p_brand").alias("tm_name")).distinct()


def category3s(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return (
        p.select(_category3_id("p_type").alias("id"), F.col("p_type").alias("name"))
        .distinct()
        .withColumn("category2_id", F.lit(CATEGORY2_ID))
    )


def spus(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_size").cast("string").alias("id"),
        F.concat(F.lit("SPU_"), F.col("p_size").cast("string")).alias("spu_name"),
    ).distinct()


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("A"), F.col("n_regionkey").cast("string")).alias("area_code"),
        F.concat(F.lit("ISO-"), F.col("n_nationkey").cast("string")).alias("iso_code"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    bday = F.date_add(F.lit(BIRTHDAY_BASE).cast("date"), ((F.col("c_custkey") * 37) % 18000).cast("int"))
    gender = (
        F.when(F.col("c_custkey") % 3 == 0, F.lit("M"))
        .when(F.col("c_custkey") % 3 == 1, F.lit("F"))
        .otherwise(F.lit(None).cast("string"))
    )
    return c.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_mktsegment").alias("user_level"),
        F.concat(bday.cast("string"), F.lit(" 00:00:00")).alias("birthday"),
        gender.alias("gender"),
    )


def user_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.where(F.col("c_custkey") % 5 == 0).select(
        F.col("c_custkey").cast("string").alias("user_id"), F.lit("1").alias("if_consumed")
    )


# ---------------------------------------------------------------- start log

def start_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LogStart-like rows from events: ts (epoch ms), common{...}, start{...}, event_id."""
    e = read_table(spark, sf_dir, "events")
    uid = F.col("user_id")
    k = F.col("event_id") % 100
    common = F.struct(
        F.concat(F.lit("ar_"), (uid % 10).cast("string")).alias("ar"),
        uid.cast("string").alias("uid"),
        F.lit("android").alias("os"),
        F.col("event_type").alias("ch"),
        F.lit("model_x").alias("md"),
        F.concat(F.lit("mid_"), uid.cast("string")).alias("mid"),
        F.concat(F.lit("v1."), (uid % 3).cast("string")).alias("vc"),
        F.lit("brand_x").alias("ba"),
    )
    start = F.struct(
        F.lit("icon").alias("entry"),
        k.cast("int").alias("open_ad_skip_ms"),
        (k * 10).cast("int").alias("open_ad_ms"),
        (k * 20).cast("int").alias("loading_time"),
        k.cast("int").alias("open_ad_id"),
    )
    return e.select(
        epoch_ms_of_wallclock(F.col("ts")).alias("ts"),
        common.alias("common"),
        start.alias("start"),
        F.col("event_id"),
    )
