"""Streams on hand-made rows: late rows, rows in any order, several files in a batch."""

from __future__ import annotations

import time
from decimal import Decimal

from pyspark.sql import functions as F

from lakelayer.operators.split import split_payment
from lakelayer.session import ROCKSDB_PROVIDER, ensure_state_provider, ship_package
from lakelayer.streaming import staging
from lakelayer.streaming.runs import finish, run_available
from lakelayer.streaming.staging import stage_by_time, stream_of
from lakelayer.streaming.twins import (
    USER_BUCKETS,
    flag_first_order_stream,
    join_wide_stream,
    read_dau,
    read_trademark_stat,
    run_dau,
    run_trademark_stat,
    split_payment_stream,
)

WIDE = ("order_detail_id long, order_id long, sku_price decimal(18,2), sku_num long, original_total_amount decimal(18,2), "
        "final_total_amount decimal(18,2), final_detail_amount decimal(18,2), tm_id long, tm_name string, create_time string")


def _batches(spark, path, batches, schema):
    """Each list of rows as one file; one file is one micro-batch."""
    for rows in batches:
        df = spark.createDataFrame(rows, schema)
        if "create_time" in df.columns:
            df = df.withColumn("create_time", F.to_timestamp_ntz("create_time"))
        df.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_lines_and_sums_are_not_lost(spark, tmp_path):
    line = lambda i, order, at: (i, order, Decimal(33 if i < 3 else 34), 1, Decimal(100), Decimal(90), Decimal(9), 1, "t", at)
    rows = [[line(1, 7, "2024-01-01 00:00:00")], [line(2, 8, "2024-03-01 00:00:00")], [line(2, 7, "2024-01-01 00:00:01")],
            [line(3, 7, "2023-01-01 00:00:00")]]
    stream = _batches(spark, str(tmp_path / "in"), rows, WIDE)
    run_available(split_payment_stream(stream, ttl_ms=None), str(tmp_path / "c1"), path=str(tmp_path / "split"))
    got = {(r["order_id"], r["order_detail_id"]): r["final_detail_amount"] for r in spark.read.parquet(str(tmp_path / "split")).collect()}
    assert got == {(7, 1): Decimal("29.70"), (7, 2): Decimal("29.70"), (7, 3): Decimal("30.60"), (8, 2): Decimal("29.70")}
    finish(run_trademark_stat(stream, str(tmp_path / "stat"), str(tmp_path / "c2"), available_now=True))
    stat = read_trademark_stat(spark, str(tmp_path / "stat"))
    assert stat.agg(F.sum("amount")).first()[0] == Decimal(36)
    assert {(r["stat_time"], r["amount"]) for r in stat.collect()} >= {("2024-01-01 00:00:00", Decimal(18))}


def test_first_start_does_not_depend_on_files(spark, tmp_path):
    common = "struct<ar:string,uid:string,os:string,ch:string,md:string,mid:string,vc:string,ba:string>"
    row = lambda ts, e, mid: (1704067200000 + ts, e, ("a", str(e), "o", "c", "m", mid, "v", "b"))
    path = str(tmp_path / "in")
    schema = f"ts long, event_id long, common {common}"
    rows = [row((97 * i) % 60_000, i, f"d{i % 20}") for i in range(400)]
    spark.createDataFrame(rows, schema).repartition(6).write.parquet(path)
    for name, files in (("one", 10), ("many", 1)):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
        finish(run_dau(spark, stream, str(tmp_path / name), str(tmp_path / f"c-{name}"), available_now=True))
        got = {(r["dt"], r["mid"]): r["ts"] for r in read_dau(spark, str(tmp_path / name)).collect()}
        assert len(got) == 20
        if name == "one":
            least = {}
            for ts, _, c in rows:
                least[c[5]] = min(ts, least.get(c[5], ts))
            assert {mid: ts for (_, mid), ts in got.items()} == least


def test_package_is_shipped_once(spark):
    ship_package(spark)
    ship_package(spark)
    assert spark.sparkContext._lakelayer_shipped


def test_orders_share_states_and_nulls_split_as_in_the_batch_form(spark, tmp_path):
    big = (1 << 53) + 1
    price = lambda i: None if i % 7 == 0 else Decimal(i % 5)
    rows = [(i, i % 40 if i % 11 else None, price(i), 1, Decimal(8) if i % 40 % 9 else None, Decimal(7) if i % 40 % 13 else None, None,
             big if i % 3 else None, None, "2024-01-01 00:00:00") for i in range(200)]
    stream = _batches(spark, str(tmp_path / "in"), [rows], WIDE)
    run_available(split_payment_stream(stream, ttl_ms=None), str(tmp_path / "c"), path=str(tmp_path / "out"))
    batch = split_payment(spark.read.parquet(str(tmp_path / "in")))
    key = lambda r: r["order_detail_id"]
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect(), key=key) == sorted(batch.collect(), key=key)


def test_users_share_states(spark, tmp_path):
    orders = [(i, i % 1500, f"2024-01-01 00:{i % 60:02d}:00") for i in range(3000)]
    stream = _batches(spark, str(tmp_path / "in"), [orders[:2000], orders[2000:]], "id long, user_id long, create_time string")
    status = spark.createDataFrame([(str(u), "1") for u in range(0, 1500, 5)], "user_id string, if_consumed string")
    run_available(flag_first_order_stream(stream, status), str(tmp_path / "c"), path=str(tmp_path / "out"))
    first = {}
    for part in (orders[:2000], orders[2000:]):
        here = {}
        for i, user, at in part:
            if user % 5 and user not in first:
                here[user] = min(here.get(user, (at, i)), (at, i))
        first |= here
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 3000
    assert {r["id"] for r in got.where("if_first_order = '1'").collect()} == {i for _, i in first.values()}
    assert spark.read.format("statestore").option("stateVarName", "consumed").load(str(tmp_path / "c")).count() <= USER_BUCKETS


def test_a_slice_has_files_for_its_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "FILE_BYTES", 2000)
    df = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), (F.col("id") * 1000).alias("ts"))
    schema = stage_by_time(df, "ts", str(tmp_path / "in"))
    batches = []
    run_available(stream_of(spark, schema, str(tmp_path / "in")), str(tmp_path / "c"),
                  foreach_batch=lambda b, n: batches.append(tuple(b.agg(F.min("id"), F.max("id"), F.count("id")).first())))
    assert batches == [(0, 1999, 2000), (2000, 3999, 2000)]
    assert len(spark.read.parquet(str(tmp_path / "in" / "files")).inputFiles()) > 4 * staging.FILES


def test_the_join_keeps_its_state_on_disk(spark, tmp_path):
    key, bound = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    spark.conf.set(bound, "false")
    source = spark.readStream.schema("id long, order_id long, create_time timestamp_ntz").parquet(str(tmp_path))
    join_wide_stream(source.drop("order_id"), source)
    assert spark.conf.get(key) == ROCKSDB_PROVIDER and spark.conf.get(bound) == "true"


def _shuffle_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return sum(blocks.apply(i).isShuffle() for i in range(blocks.size()))


def test_a_large_table_is_staged_in_slices_of_its_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "SLICE_BYTES", 40_000)
    at = F.when(F.col("id") < 2000, F.col("id")).when(F.col("id") < 2005, F.col("id") + 1500).otherwise(F.col("id") + 3000) * 1000
    df = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), at.alias("ts"))
    spark._jvm.System.gc()
    schema, before = stage_by_time(df, "ts", str(tmp_path / "in"), slices=None), _shuffle_blocks(spark)
    assert not (tmp_path / "in" / "_base").exists()
    batches = []
    run_available(stream_of(spark, schema, str(tmp_path / "in")), str(tmp_path / "c"),
                  foreach_batch=lambda b, n: batches.append(tuple(b.agg(F.min("id"), F.max("id"), F.count("id")).first())))
    assert len(batches) == len(list((tmp_path / "in" / "files").glob("_slice=*"))) > 3
    assert (2000, 2004, 5) in batches  # a slice with fewer rows than files is a batch of its own
    assert sum(n for _, _, n in batches) == 4000 and all(a[1] < b[0] for a, b in zip(batches, batches[1:]))
    assert _shuffle_blocks(spark) <= before


def test_shuffles_of_staging_are_deleted(spark, tmp_path):
    spark._jvm.System.gc()
    time.sleep(1)
    before = _shuffle_blocks(spark)
    df = spark.range(2000).select((F.col("id") % 1000).alias("id"), F.col("id").alias("ts")).repartition(4, "id")
    stage_by_time(df, "ts", str(tmp_path / "in"))
    until = time.monotonic() + 10
    while _shuffle_blocks(spark) > before and time.monotonic() < until:
        time.sleep(0.2)
    assert _shuffle_blocks(spark) <= before


def test_old_state_is_not_kept(spark):
    ensure_state_provider(spark)
    assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") == "2"
