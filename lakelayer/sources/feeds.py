"""Database change feeds built from the driver tables (test inputs for the ODS layer).

Two envelope styles, as produced by two common change-capture tools:

* array style: ``{database, table, type, ts, isDdl, data: [{...}, ...], ...}``,
  several records per message, every value quoted;
* row style: ``{database, table, type, ts, xid, xoffset, data: {...}}``, one
  record per message; a bootstrap marker carries ``data = {}``.

Tables are renamed to the shop schema; each record carries a text ``id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import read_table

# Source table -> (feed table name, record id, cycling key).
FEED_TABLES = {
    "orders": ("order_info", "o_orderkey", "o_orderkey"),
    "lineitem": ("order_detail", "concat(l_orderkey, '-', l_linenumber)", "l_orderkey + l_linenumber"),
    "part": ("sku_info", "p_partkey", "p_partkey"),
    "nation": ("base_province", "n_nationkey", "n_nationkey"),
    "region": ("base_region", "r_regionkey", "r_regionkey"),
    "customer": ("user_info", "c_custkey", "c_custkey"),
}
ARRAY_FEED_SOURCES = ("orders", "lineitem", "part", "nation")
ROW_FEED_SOURCES = ("orders", "lineitem", "part", "nation", "region")
# Operation type by cycle position (key % 4).
ARRAY_TYPES = ("INSERT", "UPDATE", "DELETE", "insert")
ROW_TYPES = ("insert", "update", "delete", "bootstrap-start")
GROUPED_MESSAGES = ("orders", "part", "nation")  # several records per message: key div 3
DATABASE = "gmall"
FEED_TS = 1704067200000


def _record(df: DataFrame, id_expr: str) -> Column:
    """All columns as quoted text, plus a text ``id``."""
    return F.struct(
        F.expr(id_expr).cast("string").alias("id"),
        *[F.col(c).cast("string").alias(c) for c in df.columns],
    )


def _type_of(cycle: Column, names) -> Column:
    expr = None
    for i, n in enumerate(names):
        expr = F.when(cycle == i, F.lit(n)) if expr is None else expr.when(cycle == i, F.lit(n))
    return expr


def array_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array-style change feed as ``value`` text."""
    parts = []
    for src in ARRAY_FEED_SOURCES:
        table, id_expr, key_expr = FEED_TABLES[src]
        df = read_table(spark, sf_dir, src)
        rec = _record(df, id_expr)
        key = F.expr(key_expr).cast("bigint")
        if src in GROUPED_MESSAGES:
            msgs = df.select((key / 3).cast("bigint").alias("msg_no"), rec.alias("rec")).groupBy("msg_no").agg(
                F.array_sort(F.collect_list("rec")).alias("data"))
        else:
            msgs = df.select(key.alias("msg_no"), F.array(rec).alias("data"))
        env = F.struct(
            F.col("data"),
            F.lit(DATABASE).alias("database"),
            F.lit(FEED_TS).alias("es"),
            F.col("msg_no").alias("id"),
            F.lit(False).alias("isDdl"),
            F.array(F.lit("id")).alias("pkNames"),
            F.lit("").alias("sql"),
            F.lit(table).alias("table"),
            F.lit(FEED_TS).alias("ts"),
            _type_of(F.col("msg_no") % 4, ARRAY_TYPES).alias("type"),
        )
        parts.append(msgs.select(F.to_json(env).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_feed(spark: SparkSession, sf_dir: str, sources: Sequence[str] = ROW_FEED_SOURCES) -> DataFrame:
    """Row-style change feed as ``value`` text; bootstrap markers carry an empty object."""
    parts = []
    for src in sources:
        table, id_expr, key_expr = FEED_TABLES[src]
        df = read_table(spark, sf_dir, src)
        key = F.expr(key_expr).cast("bigint")
        typ = _type_of(key % 4, ROW_TYPES)
        head = F.to_json(F.struct(
            F.lit(DATABASE).alias("database"),
            F.lit(table).alias("table"),
            typ.alias("type"),
            F.lit(FEED_TS).alias("ts"),
            key.alias("xid"),
            F.lit(0).alias("xoffset"),
        ))
        data = F.when(typ == "bootstrap-start", F.lit("{}")).otherwise(F.to_json(_record(df, id_expr)))
        value = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"data":'), data, F.lit("}"))
        parts.append(df.select(value.alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _fields(rows: DataFrame, **names: str) -> DataFrame:
    """Record text -> columns, by field name; the batch comes along."""
    return rows.select("batch_id", *(F.get_json_object("value", f"$.{field}").alias(c) for c, field in names.items()))


def _users(rows: DataFrame) -> DataFrame:
    key = F.col("id").cast("bigint")
    gender = F.when(key % 3 == 0, F.lit("M")).when(key % 3 == 1, F.lit("F"))
    return _fields(rows, id="id", user_level="c_mktsegment").withColumn("gender", gender).withColumn(
        "birthday", F.lit("1990-01-01"))


# dimension, records of its topic as the dimension's columns, a column that shows the record
DIM_FROM_FEED = (
    ("sku_info", lambda r: _fields(r, id="id", sku_name="p_name", tm_name="p_brand"), "tm_name"),
    ("base_province", lambda r: _fields(r, id="id", name="n_name"), "name"),
    ("user_info", _users, "gender_name"),
)
