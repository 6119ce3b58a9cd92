"""Registered queries against their reference SQL (DuckDB) on the smallest driver tables,
plus invariants the warehouse states."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from lakelayer.plans import catalog
from lakelayer.streaming import staging
from oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLE) <= set(E.queries())


WRITES = ("cdc_topic_counts", "daily_doc_index", "dim_scan", "dim_lookup_keyed")  # what they write is read back


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith(("stream_", "src_topic")) and k not in (
    *WRITES, "resume", "exactly_once")))
def test_no_job_runs_while_a_batch_query_is_built(spark, key):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{key}", key)
    try:
        QUERIES[key](spark, SMALL)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert list(tracker.getJobIdsForGroup(f"build-{key}")) == []


@pytest.mark.parametrize("key", ["dau_first_seen", "dim_upsert_latest", "order_wide_dedup", "order_first_flag"])
def test_first_rows_are_limited_before_the_shuffle(spark, key):
    plan = QUERIES[key](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_reference(spark, con, key):
    r = compare(spark, con, key, QUERIES[key], ORACLE[key], SMALL)
    assert r["status"] == "OK", r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["trademark_id", "trademark_name", "amount"]


def test_split_invariants(spark):
    from lakelayer.plans.warehouse import paid_wide

    w = paid_wide(spark, SMALL)
    per_order = w.groupBy("order_id").agg(
        F.sum("final_detail_amount").alias("s"), F.first("final_total_amount").alias("paid"))
    assert per_order.where(F.col("s") != F.col("paid")).count() == 0


def test_left_joins_keep_row_count(spark):
    from lakelayer.plans.warehouse import dwd_details, dwd_orders
    from lakelayer.sources import fixtures as fx

    assert dwd_orders(spark, SMALL).count() == fx.read_table(spark, SMALL, "orders").count()
    assert dwd_details(spark, SMALL).count() == fx.read_table(spark, SMALL, "lineitem").count()


def test_at_most_one_first_order_per_user(spark):
    o = QUERIES["order_first_flag"](spark, SMALL)
    firsts = o.where(F.col("if_first_order") == "1").groupBy("user_id").count()
    assert firsts.where(F.col("count") > 1).count() == 0
    assert firsts.count() > 0


def test_one_dau_row_per_day_and_device(spark):
    for key in ("dau_first_seen", "daily_doc_index", "stream_dau_first_seen"):
        d = QUERIES[key](spark, SMALL)
        assert d.groupBy("dt", "mid").count().where(F.col("count") > 1).count() == 0, key


def test_routed_rows_equal_filtered_input(spark):
    from lakelayer.operators.cdc import FACT_TABLES
    from lakelayer.sources import feeds

    feed = feeds.row_feed(spark, SMALL)
    env = feed.select(F.json_tuple("value", "type", "table", "data").alias("type", "table", "data"))
    kept = env.where(
        ~F.col("data").rlike(r"^\s*\{\s*\}\s*$")
        & ((F.col("table").isin(list(FACT_TABLES)) & (F.col("type") == "insert"))
           | F.col("table").isin("base_province", "user_info", "sku_info", "base_trademark",
                                 "base_category3", "spu_info"))
    )
    assert QUERIES["cdc_route_row"](spark, SMALL).count() == kept.count()


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
@pytest.mark.parametrize("key", ["order_calendar", "start_log_calendar", "trademark_amount_stat", "date_scalars", "json_decode",
                                 "user_dim_derive"])
def test_results_do_not_depend_on_session_zone(spark, con, key, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        r = compare(spark, con, key, QUERIES[key], ORACLE[key], SMALL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["status"] == "OK", r


def test_rows_are_shuffled_without_what_is_computed_from_them(spark):
    found, left = [], [QUERIES["trademark_amount_stat"](spark, SMALL)._jdf.queryExecution().optimizedPlan()]
    while left:
        node = left.pop()
        if node.nodeName() == "RepartitionByExpression":
            found.append({node.output().apply(i).name() for i in range(node.output().size())})
        left += [node.children().apply(i) for i in range(node.children().size())]
    assert len(found) >= 2  # the lines' numbers and the split
    assert not any(name.startswith("_") for names in found for name in names)


@pytest.mark.parametrize("key", ["stream_pay_split", "stream_order_wide", "stream_late_rows"])
def test_more_slices_give_the_same_rows(spark, con, key, monkeypatch):
    monkeypatch.setattr(staging, "SLICE_BYTES", 80_000)
    r = compare(spark, con, key, QUERIES[key], ORACLE[key], SMALL)
    assert r["status"] == "OK", r
