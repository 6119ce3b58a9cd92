"""Registered streaming twins and delivery checks (section 2.11, A1, A3, A4, A13).

Each query lays its input out as files in time slices below the shared checkpoint
folder, runs the streaming query with ``availableNow`` (a slice of files per
micro-batch, rows in no order), and returns what the sink holds. Where the stream must give the
same rows as its batch twin, the batch twin's reference SQL is registered too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.money import as_double, exact_sum
from ..operators.dau import start_log_calendar
from ..operators.dim_store import DimStore
from ..operators.dims import DIM_SPECS, append_changes, derive_user, read_dim
from ..operators.orders import enrich_details
from ..operators.split import split_payment
from ..operators.stats import trademark_total
from ..operators.wide import join_wide
from ..session import scratch_path
from ..sinks.batches import delete_folder, replace_batch
from ..sinks.docs import latest_docs
from ..sinks.manifest import Manifest
from ..sources import feeds
from ..sources import fixtures as fx
from ..sources.decode import decode_start_log
from ..sources.topics import read_topic
from ..streaming.runs import LateRows, finish, run_available
from ..streaming.staging import base_copy, files_a_slice, micros, slices_by_size, stage_by_time, stream_of, time_bounds
from ..streaming.twins import (
    enrich_stream,
    flag_first_order_stream,
    join_wide_stream,
    once_a_sighting,
    read_dau,
    read_trademark_stat,
    run_dau,
    run_decoded,
    run_dim,
    run_dim_store,
    run_ods,
    run_orders,
    run_timed_totals,
    run_trademark_stat,
    run_wide,
    split_payment_stream,
    status_store,
)
from . import warehouse as W
from .catalog import ORACLE, register, wide_out

PROBE = -1


def _same_as(batch_key: str) -> str:
    """Reference SQL of a batch key (the stream must reproduce it)."""
    return ORACLE[batch_key]


def _register_same(key: str, batch_key: str):
    def deco(fn):
        register(key)(fn)
        ORACLE[key] = _same_as(batch_key)
        return fn

    return deco


@_register_same("stream_dau_first_seen", "dau_first_seen")
def stream_dau_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-dau")
    schema = stage_by_time(fx.start_logs(spark, sf_dir), "ts", root)
    finish(run_dau(spark, stream_of(spark, schema, root), f"{root}/out", f"{root}/ckpt", available_now=True))
    return read_dau(spark, f"{root}/out").select("mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts")


@_register_same("stream_trademark_stat", "trademark_amount_stat")
def stream_trademark_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-tm")
    schema = stage_by_time(_wide_copy(spark, sf_dir, root, paid=True), "create_time", root, slices=None, copied=True)
    finish(run_trademark_stat(stream_of(spark, schema, root), f"{root}/out", f"{root}/ckpt", available_now=True))
    out = read_trademark_stat(spark, f"{root}/out")
    return out.select("stat_time", "trademark_id", "trademark_name", as_double("amount").alias("amount"))


@_register_same("stream_order_first_flag", "order_first_flag")
def stream_order_first_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-first")
    schema = stage_by_time(fx.order_infos(spark, sf_dir), "create_time", root)
    flagged = flag_first_order_stream(stream_of(spark, schema, root), fx.user_statuses(spark, sf_dir))
    run_available(flagged, f"{root}/ckpt", path=f"{root}/out")
    return spark.read.parquet(f"{root}/out").select("id", "user_id", D.time_text("create_time").alias("create_time"), "if_first_order")


def _wide_copy(spark: SparkSession, sf_dir: str, root: str, paid: bool = False) -> DataFrame:
    """``W.wide_rows`` (``W.paid_wide``) as the base copy at ``root``. Its layers are written one after the other, and
    each goes when the next is there, so that the shuffles of all are not on disk together."""
    orders = base_copy(W.dwd_orders(spark, sf_dir), f"{root}/orders")
    lines = base_copy(W.dwd_details(spark, sf_dir), f"{root}/lines")
    wide = base_copy(join_wide(orders, lines, within_s=None), f"{root}/wide" if paid else root)
    delete_folder(spark, f"{root}/orders")
    delete_folder(spark, f"{root}/lines")
    if paid:
        wide = base_copy(split_payment(wide), root)
        delete_folder(spark, f"{root}/wide")
    return wide


def _split_out(w: DataFrame) -> DataFrame:
    return w.select(
        "order_detail_id", "order_id", as_double("sku_price").alias("sku_price"), "sku_num",
        as_double("original_total_amount").alias("original_total_amount"),
        as_double("final_total_amount").alias("final_total_amount"),
        as_double("final_detail_amount").alias("final_detail_amount"),
    )


@_register_same("stream_pay_split", "order_pay_split")
def stream_pay_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-split")
    schema = stage_by_time(_wide_copy(spark, sf_dir, root), "create_time", root, slices=None, copied=True)
    run_available(split_payment_stream(stream_of(spark, schema, root), ttl_ms=None), f"{root}/ckpt", path=f"{root}/out")
    return _split_out(spark.read.parquet(f"{root}/out"))


@_register_same("stream_order_wide", "order_wide_join")
def stream_order_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-wide")
    orders = base_copy(W.dwd_orders(spark, sf_dir), f"{root}/o")
    lines = base_copy(W.dwd_details(spark, sf_dir), f"{root}/d")
    (lo, _), (_, hi) = time_bounds(orders, "create_time"), time_bounds(lines, "create_time")
    # both sides in slices of the same times
    part = {"slices": max(2, slices_by_size(spark, f"{root}/o", f"{root}/d")), "bounds": (lo, hi), "copied": True}
    o_schema = stage_by_time(orders, "create_time", f"{root}/o", probe={"id": F.lit(PROBE), "user_id": F.lit(PROBE)}, **part)
    d_schema = stage_by_time(lines, "create_time", f"{root}/d", probe={"id": F.lit(PROBE), "order_id": F.lit(PROBE)}, **part)
    joined = join_wide_stream(stream_of(spark, o_schema, f"{root}/o"), stream_of(spark, d_schema, f"{root}/d"))
    run_available(joined, f"{root}/ckpt", path=f"{root}/out")
    return wide_out(spark.read.parquet(f"{root}/out").where(F.col("order_id") != PROBE))


@register("stream_dim_upsert", """
SELECT id, spu_id, price, sku_name, tm_id, category3_id, create_time, category3_name, spu_name, tm_name FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM (
    SELECT id, spu_id, price, sku_name || ' v' || CAST(version AS VARCHAR) AS sku_name, tm_id, category3_id,
           create_time, category3_name, spu_name, tm_name, version
    FROM (SELECT *, unnest([1, 2, 3]) AS version FROM sku_dim)
    WHERE (CAST(id AS BIGINT) + version) % 4 <> 0))
WHERE rn = 1""")
def stream_dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU versions arrive over two micro-batches, so a batch holds several changes of a key."""
    root = scratch_path(spark, "stream-dim")
    spec = DIM_SPECS["sku_info"]
    versions = W.dim_versions(W.sku_dim(spark, sf_dir), "sku_name")
    schema = stage_by_time(versions, "version", root, slices=2)
    finish(run_dim(spark, spec, stream_of(spark, schema, root), f"{root}/log", f"{root}/ckpt",
                   order_col="version", available_now=True))
    return read_dim(spark, spec, f"{root}/log")


@_register_same("stream_dim_enrich", "order_detail_enrich")
def stream_dim_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines enriched per micro-batch from the change log as it is at that batch. A stale version of
    every second SKU is in the log first; the current one is appended before the first batch reads it."""
    root = scratch_path(spark, "stream-enrich")
    spec = DIM_SPECS["sku_info"]
    schema = stage_by_time(fx.order_details(spark, sf_dir), "create_time", root)
    sku = W.sku_dim(spark, sf_dir).withColumn("position", F.lit(0))
    stale = sku.where(F.col("id").cast("bigint") % 2 == 0).withColumn("tm_name", F.lit("stale"))
    append_changes(stale, spec, f"{root}/log", 0, "position")
    append_changes(sku, spec, f"{root}/log", 1, "position")
    finish(enrich_stream(stream_of(spark, schema, root), lambda batch, number: read_dim(spark, spec, f"{root}/log"), f"{root}/out",
                         f"{root}/ckpt", enrich_details, available_now=True))
    d = spark.read.parquet(f"{root}/out")
    return d.select("id", "order_id", "sku_id", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
                    "category3_name")


# ------------------------------------------------------------------ keyed store

@register("dim_lookup_keyed", """
SELECT id, age_group, gender_name FROM user_dim WHERE id IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderkey % 100 = 7)""")
def dim_lookup_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users of some orders from the keyed store, whose other buckets are not read (C6). Every second user is
    in the store with an old row of an earlier batch as well."""
    store = DimStore(spark, DIM_SPECS["user_info"], scratch_path(spark, "keyed"))
    users = W.user_dim(spark, sf_dir).withColumn("position", F.lit(0))
    store.append(users.where(F.col("id").cast("bigint") % 2 == 0).withColumn("gender_name", F.lit("old")), 0, "position")
    store.append(users, 1, "position")
    keys = fx.order_keys(spark, sf_dir).where(F.col("id") % 100 == 7).select(F.col("user_id").cast("string").alias("k")).distinct()
    return store.read(keys).join(keys, F.col("id") == F.col("k")).select("id", "age_group", "gender_name")


@_register_same("stream_dim_compact", "stream_dim_upsert")
def stream_dim_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU versions over three micro-batches into the keyed store, which is compacted before each but the first."""
    root = scratch_path(spark, "stream-compact")
    versions = W.dim_versions(W.sku_dim(spark, sf_dir), "sku_name")
    schema = stage_by_time(versions, "version", root, slices=3)
    store = DimStore(spark, DIM_SPECS["sku_info"], f"{root}/store")
    finish(run_dim_store(store, stream_of(spark, schema, root), f"{root}/ckpt", "version", compact_every=1, keep=0, available_now=True))
    return store.read()


@register("stream_dim_changing", """
SELECT t.id, CASE WHEN s.id IS NULL THEN NULL ELSE 'v' || least((us - lo) // width, 2) END AS tm_name
FROM (SELECT id, sku_id, epoch_us(create_time) AS us FROM order_detail) t
CROSS JOIN (SELECT min(epoch_us(create_time)) AS lo, (max(epoch_us(create_time)) - min(epoch_us(create_time))) // 3 + 1 AS width
            FROM order_detail) b LEFT JOIN sku_dim s ON CAST(t.sku_id AS VARCHAR) = s.id""")
def stream_dim_changing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines over three micro-batches, enriched from a dimension that changes before each of them (H5).
    The second batch fails after its output; the dimension changes once more before it is repeated,
    and it still sees what it saw first."""
    root = scratch_path(spark, "stream-changing")
    schema = stage_by_time(fx.order_details(spark, sf_dir), "create_time", root, slices=3)
    store = DimStore(spark, DIM_SPECS["sku_info"], f"{root}/store")
    sku = W.sku_dim(spark, sf_dir).withColumn("position", F.lit(0))
    seen: set[int] = set()

    def snapshot(batch: DataFrame, number: int) -> DataFrame:
        if number not in seen:
            store.append(sku.withColumn("tm_name", F.lit(f"v{number}")), 10 * number, "position")
        seen.add(number)
        return store.pinned(f"{root}/pins", number, batch.select("sku_id"))

    fail = {1}

    def enrich(batch: DataFrame, dim: DataFrame) -> DataFrame:
        out = enrich_details(batch, dim).select("id", "tm_name")
        if seen == {0, 1} and fail:
            fail.clear()
            out.write.parquet(f"{root}/half")
            store.append(sku.withColumn("tm_name", F.lit("in between")), 15, "position")
            raise RuntimeError("stopped within the batch")
        return out

    for again in (True, False):
        try:
            finish(enrich_stream(stream_of(spark, schema, root), snapshot, f"{root}/out", f"{root}/ckpt", enrich, available_now=True))
        except Exception:  # the planned failure only
            if fail or not again:
                raise
    return spark.read.parquet(f"{root}/out").select("id", "tm_name")


# ------------------------------------------------------------------ several outputs of one batch

def _order_job(spark: SparkSession, sf_dir: str, fail_after: tuple[str, ...] = ()) -> str:
    """The order job over all orders in two runs, each with a checkpoint of its own; the second knows the
    first orders of the first only through the status store. After each output named in
    ``fail_after`` the job fails once and is started again."""
    root = scratch_path(spark, "orders")
    status = fx.user_statuses(spark, sf_dir).withColumn("position", F.lit(0))
    status_store(spark, root).append(status, 0, "position")
    # both runs stage their orders from one table; its times are those of the narrow keys
    infos = fx.order_infos(spark, sf_dir)
    infos.write.parquet(f"{root}/orders")
    orders = spark.read.schema(infos.schema).parquet(f"{root}/orders")
    bounds = time_bounds(fx.order_keys(spark, sf_dir), "create_time")
    left = list(fail_after)

    def written(name: str) -> None:
        if name in left:
            left.remove(name)
            raise RuntimeError("stopped between two outputs")

    for run in (0, 1):
        where = f"{root}/run{run}"
        # the second run's base is its own copy, as another process would have it
        schema = stage_by_time(orders, "create_time", where, first=run, last=run + 1, bounds=bounds, own_base=True)
        while True:
            todo = len(left)
            try:
                finish(run_orders(spark, stream_of(spark, schema, where), fx.provinces(spark, sf_dir), W.user_dim(spark, sf_dir), root,
                                  f"{where}/ckpt", first_batch=1 + 100 * run, compact_every=101, written=written, available_now=True))
                break
            except Exception:  # a planned failure only
                if len(left) == todo:
                    raise
    return root


def _order_outputs(spark: SparkSession, root: str) -> DataFrame:
    """The order index, with the number of messages that the topic has of each order."""
    outputs = Manifest(spark, root)
    sent = outputs.read("topics").where("topic = 'dwd_order_info'").groupBy(
        F.col("key").cast("bigint").alias("id")).agg(F.count(F.lit(1)).cast("int").alias("n_topic"))
    return latest_docs(outputs.read("index")).join(sent, "id", "left").select(
        "id", "user_id", "create_date", "if_first_order", "province_name", "user_age_group", "n_topic")


@register("stream_order_outputs", """
SELECT id, user_id, create_date, if_first_order, province_name, user_age_group, 1 AS n_topic FROM order_dwd""")
def stream_order_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_outputs(spark, _order_job(spark, sf_dir))


@_register_same("stream_order_restart", "stream_order_outputs")
def stream_order_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with a failure after the status is written, another between index and topic, and one after
    both and before the manifest (A13): all of a batch is seen once."""
    return _order_outputs(spark, _order_job(spark, sf_dir, ("status", "index", "topics")))


@register("stream_order_status", """
SELECT user_id, if_consumed FROM user_status
UNION SELECT CAST(user_id AS VARCHAR), '1' FROM order_first WHERE if_first_order = '1'""")
def stream_order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user status after both runs of the order job."""
    return status_store(spark, _order_job(spark, sf_dir)).read()


@_register_same("stream_timed_totals", "trademark_amount_total")
def stream_timed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timed run (H1): batches every second until all files are read, then stopped from outside. Amounts by
    trademark, added up over the batches, each of which has one time (B16)."""
    root = scratch_path(spark, "stream-timed")
    schema = stage_by_time(_wide_copy(spark, sf_dir, root, paid=True), "create_time", root, slices=None, copied=True)
    q = run_timed_totals(spark, stream_of(spark, schema, root), f"{root}/out", f"{root}/ckpt", trigger="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = Manifest(spark, f"{root}/out").read("totals")
    if rows.groupBy("batch_id").agg(F.countDistinct("stat_time").alias("n")).where("n <> 1").count():
        raise ValueError("a batch has several times")
    t = rows.groupBy("trademark_id", "trademark_name").agg(exact_sum("amount").alias("amount"))
    return t.select("trademark_id", "trademark_name", as_double("amount").alias("amount"))


# ------------------------------------------------------------------ sightings and late rows

@register("stream_line_sightings", """
SELECT order_id, order_detail_id, after_s FROM wide_all CROSS JOIN (VALUES (0), (1020)) AS d(after_s)""")
def stream_line_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line is delivered three times: at its time, 5 minutes later (a duplicate, which renews the memory) and
    12 minutes after that (new, as the memory of 10 minutes is over, though it began 17 minutes before)."""
    root = scratch_path(spark, "stream-sightings")
    lines = W.wide_rows(spark, sf_dir, within_s=None).select("order_id", "order_detail_id", "create_time")
    after = F.explode(F.array(*(F.lit(s) for s in (0, 300, 1020)))).alias("after_s")
    sent = lines.select("*", after).withColumn("create_time", D.add_seconds("create_time", F.col("after_s")))
    schema = stage_by_time(sent, "create_time", root, slices=None)
    rows = stream_of(spark, schema, root).withColumn("at", D.event_time("create_time"))
    run_available(once_a_sighting(rows, ["order_id", "order_detail_id"], "at"), f"{root}/ckpt", path=f"{root}/out")
    return spark.read.parquet(f"{root}/out").select("order_id", "order_detail_id", "after_s")


@register("stream_late_rows", """
SELECT count(*) AS dropped FROM order_detail WHERE id % 5 = 0""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth order line comes after the watermark has passed it (H3): the windowed join drops it, and the
    count of dropped rows says so."""
    root = scratch_path(spark, "stream-late")
    orders = base_copy(W.dwd_orders(spark, sf_dir), f"{root}/orders")
    lines = base_copy(W.dwd_details(spark, sf_dir), f"{root}/lines")
    n = slices_by_size(spark, f"{root}/orders", f"{root}/lines")
    # a turn is a slice: n of the rows that come in time, by their time, then the row far ahead, then the late ones
    when = F.lit(0)
    if n > 1:
        (lo, _), (_, hi) = time_bounds(orders, "create_time"), time_bounds(lines, "create_time")
        when = F.coalesce(F.least(F.floor((micros("create_time") - F.lit(lo)) / F.lit((hi - lo) // n + 1)), F.lit(n - 1)), F.lit(0))
    lines = lines.withColumn("turn", F.when(F.col("id") % 5 == 0, n + 1).otherwise(when))
    orders = orders.withColumn("turn", when)

    def pushed(df: DataFrame) -> DataFrame:
        """The rows that come in time, then one far ahead, which moves the watermark, then the late ones."""
        last = df.where(F.col("turn") < n).agg(F.max_by(F.struct(*df.columns), "create_time").alias("r")).select("r.*")
        ahead = last.withColumn("id", F.lit(PROBE).cast(df.schema["id"].dataType)).withColumn("turn", F.lit(n)).withColumn(
            "create_time", F.timestamp_add("DAY", F.lit(3650), F.col("create_time")))
        return df.unionByName(ahead)

    late = LateRows()
    spark.streams.addListener(late)
    try:
        for first, last in ((0, n), (n, n + 1), (n + 1, n + 2)):  # a run each, as the watermark of a batch drops rows of the next
            part = {"slices": n + 2, "bounds": (0, n + 1), "first": first, "last": last}
            o_schema = stage_by_time(pushed(orders), "turn", f"{root}/o", **part)
            d_schema = stage_by_time(pushed(lines), "turn", f"{root}/d", **part)
            if first == 0:
                delete_folder(spark, f"{root}/orders")
                delete_folder(spark, f"{root}/lines")
            joined = join_wide_stream(stream_of(spark, o_schema, f"{root}/o"), stream_of(spark, d_schema, f"{root}/d"), dedup_delay=None)
            late.wait(run_available(joined, f"{root}/ckpt", path=f"{root}/out"))
    finally:
        spark.streams.removeListener(late)
    return late.rows(spark).agg(F.sum("dropped").alias("dropped"))


@_register_same("stream_wide_outputs", "order_pay_split")
def stream_wide_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide job: the split rows of the table that the topic has as well."""
    root = scratch_path(spark, "wide-outputs")
    schema = stage_by_time(_wide_copy(spark, sf_dir, root), "create_time", root, slices=None, copied=True)
    finish(run_wide(stream_of(spark, schema, root), f"{root}/out", f"{root}/ckpt", ttl_ms=None, available_now=True))
    sent = spark.read.parquet(f"{root}/out/topics").select(F.col("key").cast("bigint").alias("order_detail_id"))
    return _split_out(spark.read.parquet(f"{root}/out/table").join(sent, "order_detail_id"))


@register("stream_ods_dims", """
SELECT 'gmall_sku_info' AS name, id, 'Brand#' || tm_id AS label FROM (
  SELECT CAST(p_partkey AS VARCHAR) AS id, replace(p_brand, 'Brand#', '') AS tm_id FROM part WHERE p_partkey % 4 <> 3)
UNION ALL SELECT 'gmall_province_info', CAST(n_nationkey AS VARCHAR), n_name FROM nation WHERE n_nationkey % 4 <> 3
UNION ALL SELECT 'gmall_user_info', CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 3 = 0 THEN '男' ELSE '女' END
FROM customer WHERE c_custkey % 4 <> 3""")
def stream_ods_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed -> ODS topics -> dimension logs, each step a stream; users get their derived columns."""
    root = scratch_path(spark, "ods")
    feed = feeds.row_feed(spark, sf_dir, ("part", "nation", "customer")).withColumn("n", F.pmod(F.xxhash64("value"), F.lit(3)))
    schema = stage_by_time(feed, "n", f"{root}/feed", slices=3)
    finish(run_ods(stream_of(spark, schema, f"{root}/feed"), f"{root}/topics", f"{root}/ckpt-ods", available_now=True))
    topics = spark.readStream.schema("value string, batch_id bigint, topic string").parquet(f"{root}/topics")
    out = None
    for table, shape, label in feeds.DIM_FROM_FEED:
        spec = DIM_SPECS[table]
        rows = shape(topics.where(F.col("topic") == spec.topic)).withColumn("position", F.col("batch_id"))
        if table == "user_info":
            rows = derive_user(rows, fx.USER_ASOF)
        finish(run_dim(spark, spec, rows, f"{root}/{table}", f"{root}/ckpt-{table}", order_col="position", available_now=True))
        got = read_dim(spark, spec, f"{root}/{table}").select(F.lit(spec.name).alias("name"), "id", F.col(label).alias("label"))
        out = got if out is None else out.unionByName(got)
    return out


# ------------------------------------------------------------------ sources and delivery

def _start_log_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start log published as JSON text (the DAU topic); for every fiftieth event a cut message comes besides."""
    logs = fx.start_logs(spark, sf_dir)
    text = logs.select(F.to_json(F.struct("ts", "event_id", "common", "start")).alias("value"), "ts", "event_id")
    cut = text.where(F.col("event_id") % 50 == 0).withColumn("value", F.substring("value", 1, 20))
    return text.unionByName(cut)


def _topic(spark: SparkSession, root: str) -> DataFrame:
    return read_topic(spark, "gmall_start/files", fmt="parquet", path=root, maxFilesPerTrigger=str(files_a_slice(spark, f"{root}/gmall_start")))


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Subscribe to the start-log topic (file form), decode, and land rows and unreadable text."""
    root = scratch_path(spark, "topic")
    stage_by_time(_start_log_text(spark, sf_dir), "ts", f"{root}/gmall_start")
    shape = lambda good: good.select(F.col("common.mid").alias("mid"), F.col("common.uid").alias("uid"), "ts", "event_id")
    finish(run_decoded(_topic(spark, root), decode_start_log, shape, f"{root}/out", f"{root}/ckpt", available_now=True))
    return f"{root}/out"


@register("src_topic", "SELECT mid, uid, ts, event_id FROM start_log")
def src_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_landed(spark, sf_dir)}/good").drop("batch_id")


@register("src_topic_quarantine", """
SELECT COUNT(*) AS n, COUNT(DISTINCT CASE WHEN event_id % 50 = 0 THEN 1 END) AS kinds FROM start_log WHERE event_id % 50 = 0""")
def src_topic_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable messages: how many, and how many distinct lengths (all are cut alike)."""
    bad = spark.read.parquet(f"{_landed(spark, sf_dir)}/bad")
    return bad.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.length("value")).alias("kinds"))


@register("resume", """
SELECT mid, ts, event_id, strftime(dt, '%Y-%m-%d') AS dt, CAST(hr AS BIGINT) AS hr FROM start_log""")
def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop after the first of two slices, add the rest, restart from the checkpoint: every row once."""
    root = scratch_path(spark, "resume")
    text = _start_log_text(spark, sf_dir)
    bounds = time_bounds(text, "ts")
    shape = lambda good: start_log_calendar(good).select(
        F.col("common.mid").alias("mid"), "ts", "event_id", D.date_text("dt").alias("dt"), F.col("hr").cast("bigint").alias("hr"))
    for first, last in ((0, 1), (1, 2)):
        stage_by_time(text, "ts", f"{root}/gmall_start", first=first, last=last, bounds=bounds)
        finish(run_decoded(_topic(spark, root), decode_start_log, shape, f"{root}/out", f"{root}/ckpt", available_now=True))
    return spark.read.parquet(f"{root}/out/good").drop("batch_id")


@_register_same("exactly_once", "trademark_amount_total")
def exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch trademark sums as the batch's own partition. The second batch fails after its output is
    written and before it is committed; the query is restarted from its checkpoint, runs that batch
    again, and the totals still count each line once."""
    root = scratch_path(spark, "exactly-once")
    schema = stage_by_time(_wide_copy(spark, sf_dir, root, paid=True), "create_time", root, slices=None, copied=True)
    out = f"{root}/out"
    fail = {1}

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(trademark_total(batch), out, "batch_id", batch_id)
        if batch_id in fail:
            fail.clear()
            raise RuntimeError("stopped between output and commit")

    try:
        run_available(stream_of(spark, schema, root), f"{root}/ckpt", foreach_batch=write)
    except Exception:  # the planned failure only
        if fail:
            raise
    run_available(stream_of(spark, schema, root), f"{root}/ckpt", foreach_batch=write)
    t = spark.read.parquet(out).groupBy("trademark_id", "trademark_name").agg(exact_sum("amount").alias("amount"))
    return t.select("trademark_id", "trademark_name", as_double("amount").alias("amount"))
