"""Route a database change feed to one topic per table (ODS layer: B1, B2, C1-C4).

Both routers are column expressions over the message text; the output
``(topic, value)`` goes to a sink that writes each row to its own topic (or to a
folder per topic in file form). Type and table are read first; the records are parsed only
for the messages that pass the filter. Numbers pass as they were sent (``json_numbers``), and
so does any character of a text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json_numbers import at_risk, freed, shielded

# The tables the row-style router forwards.
FACT_TABLES = ("order_info", "order_detail")
DIM_TABLES = ("base_province", "user_info", "sku_info", "base_trademark", "base_category3", "spu_info")
TOPIC_PREFIX = "ods_"

_EMPTY_OBJECT = r"^\s*\{\s*\}\s*$"


def _envelope(df: DataFrame, value: str, passes: F.Column) -> DataFrame:
    """type, table, data and ``risky`` (data is shielded) of the messages that pass a filter on type and table."""
    head = df.select(F.col(value).alias("value"), F.json_tuple(value, "type", "table").alias("type", "table")).where(passes)
    risky = head.withColumn("risky", at_risk(F.col("value")))
    text = F.when(F.col("risky"), shielded(F.col("value"))).otherwise(F.col("value"))
    return risky.select("type", "table", "risky", F.json_tuple(text, "data").alias("data"))


def _record(text: F.Column) -> F.Column:
    return F.when(F.col("risky"), freed(text)).otherwise(text).alias("value")


def unreadable(df: DataFrame, value: str = "value") -> DataFrame:
    """The messages that are not a JSON object."""
    head = df.select("*", F.json_tuple(value, "type").alias("_type")).where("_type IS NULL").drop("_type")
    return head.where(F.from_json(F.col(value), "map<string,string>").isNull())


def topic_of(table_col) -> F.Column:
    return F.concat(F.lit(TOPIC_PREFIX), table_col)


def route_array_feed(df: DataFrame, value: str = "value") -> DataFrame:
    """Array-style feed: only ``INSERT`` (exact case); one output row per record, raw JSON kept."""
    inserts = _envelope(df, value, F.col("type") == "INSERT")
    return inserts.select(
        topic_of(F.col("table")).alias("topic"), "risky",
        F.explode(F.from_json(F.col("data"), "array<string>")).alias("value"),
    ).select("topic", _record(F.col("value")))


def route_row_feed(
    df: DataFrame,
    value: str = "value",
    facts: Sequence[str] = FACT_TABLES,
    dims: Sequence[str] = DIM_TABLES,
    drop_deletes: bool = False,
) -> DataFrame:
    """Row-style feed: drop empty records; facts only on insert; listed dimensions on any operation.

    ``drop_deletes=True`` stops dimension deletes from being forwarded (they
    would otherwise re-upsert the deleted row downstream).
    """
    data = F.col("data")
    non_empty = data.isNotNull() & F.ltrim(data).startswith("{") & ~data.rlike(_EMPTY_OBJECT)
    is_fact = F.col("table").isin(list(facts)) & (F.col("type") == "insert")
    is_dim = F.col("table").isin(list(dims))
    if drop_deletes:
        is_dim = is_dim & (F.col("type") != "delete")
    return _envelope(df, value, is_fact | is_dim).where(non_empty).select(
        topic_of(F.col("table")).alias("topic"), _record(data))
