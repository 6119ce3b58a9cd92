"""Stream forms of the warehouse operators (section 2.11).

Each takes a streaming DataFrame with the same columns as its batch twin and
returns a streaming DataFrame, or starts a ``foreachBatch`` query whose outputs keep each
batch apart. Only the windowed join has a watermark (its window); sums, splits and first
starts take every row whenever it arrives.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import elapsed, event_time, stamp, wallclock_of_epoch_ms
from ..functions.money import MONEY, exact_sum
from ..operators.cdc import route_row_feed, unreadable
from ..operators.dau import dau_document, start_log_calendar
from ..operators.dim_store import DimStore
from ..operators.dims import DIM_SPECS, DimSpec, append_changes
from ..operators.joins import key_set
from ..operators.orders import enrich_province, enrich_user, flag_first_order, new_user_status, order_calendar
from ..operators.split import cents, plain_share
from ..operators.stats import trademark_stat, trademark_total
from ..operators.wide import detail_side, order_side, wide_columns, window_condition
from ..session import ensure_state_provider
from ..sinks.batches import replace_batch
from ..sinks.docs import daily_docs
from ..sinks.manifest import Manifest
from ..sinks.topics import to_topic, write_topics
from .processors import (
    BUCKET,
    DAY_KEEP_MS,
    KEY,
    LAST,
    NO_TIME,
    SIGHTING_MS,
    SPLIT_TTL_MS,
    FirstOrderProcessor,
    FirstStartProcessor,
    PaySplitProcessor,
    SightingProcessor,
    keyed,
)
from .runs import start

# Fixed value: state lifetime of the warehouse's join.
JOIN_DEDUP_DELAY = "10 minutes"
# Buckets of the keys of a stateful stream, fixed with its checkpoint: many where a bucket's rows are sorted together.
DEVICE_BUCKETS = 128
USER_BUCKETS = 512
ORDER_BUCKETS = 2048


def _with_fields(df: DataFrame, *fields: T.StructField) -> T.StructType:
    return T.StructType([*df.schema.fields, *fields])


def first_starts_stream(logs: DataFrame, zone: str = "UTC", keep_ms: int = DAY_KEEP_MS) -> DataFrame:
    """The document of each device's first start of a day (F1). The memory is state by device: a day is
    cleared ``keep_ms`` after its end, and rows as late as that are still judged by it. Devices share
    ``DEVICE_BUCKETS`` states."""
    ensure_state_provider(logs.sparkSession)
    wall = wallclock_of_epoch_ms(F.col("ts"), zone)
    in_day = (elapsed(F.to_date(wall).cast("timestamp_ntz"), wall) * 1000).cast("bigint")
    flat = start_log_calendar(logs, zone).select(
        F.col("common.mid").alias("device"), "common", "dt", "hr", "ts", "event_id", (F.col("ts") - in_day + 86_400_000).alias("end_ms"))
    docs = dau_document(flat, "device", "event_id", "end_ms", F.timestamp_millis(F.col("ts")).alias("at"))
    rows, back = keyed(docs, ["device"], DEVICE_BUCKETS, times=["at"], start_day=F.coalesce("dt", F.lit("")),
                       start_ts=F.coalesce("ts", F.lit(LAST)), start_id=F.coalesce("event_id", F.lit(LAST)),
                       start_end=F.coalesce("end_ms", F.lit(-1).cast("bigint")))
    first = rows.withWatermark("at", f"{keep_ms} milliseconds").groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=FirstStartProcessor(keep_ms), outputStructType=rows.schema, outputMode="Append", timeMode="EventTime")
    return back(first).drop("device", "event_id", "end_ms", "at")


def run_dau(spark: SparkSession, logs: DataFrame, path: str, checkpoint: str, zone: str = "UTC",
            keep_ms: int = DAY_KEEP_MS, **kw) -> StreamingQuery:
    """First start per (day, device) (F1) into the daily index at ``path``, each batch as partitions of its own.

    Inside a batch the least (time, event id) is first, so file order and the number of files do
    not matter. The memory is state; nothing that was written is read again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(batch.withColumn("day", F.col("dt")), path, "batch_id", batch_id, ["day"])

    return start(first_starts_stream(logs, zone, keep_ms), checkpoint, foreach_batch=write, **kw)


def once_a_sighting(rows: DataFrame, keys: Sequence[str], time_col: str, keep_ms: int = SIGHTING_MS) -> DataFrame:
    """Rows whose key was not seen within ``keep_ms`` before (F2), each sighting renewing the memory. ``time_col`` is
    a timestamp; rows later than ``keep_ms`` are dropped by the watermark. Lines of one order are
    keys of their own, so an order of any size is spread; keys share ``ORDER_BUCKETS`` states."""
    ensure_state_provider(rows.sparkSession)
    staged, back = keyed(rows, keys, ORDER_BUCKETS, times=[time_col], seen_ms=F.coalesce(F.unix_millis(time_col), F.lit(NO_TIME)))
    return back(staged.withWatermark(time_col, f"{keep_ms} milliseconds").groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=SightingProcessor(keep_ms), outputStructType=staged.schema, outputMode="Append", timeMode="EventTime"))


def read_dau(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("day", "batch_id")


def flag_first_order_stream(orders: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """First-order flag with the users who have ordered kept in state (F3, H4), ``USER_BUCKETS`` states for all."""
    ensure_state_provider(orders.sparkSession)
    init = None
    if status is not None:
        init = keyed(key_set(status, "user_id", "user_id", cast="bigint"), ["user_id"], USER_BUCKETS)[0].select(
            BUCKET, KEY).groupBy(BUCKET)
    rows, back = keyed(orders, ["user_id"], USER_BUCKETS, order_at=F.col("create_time"), order_no=F.coalesce("id", F.lit(LAST)))
    return back(rows.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=FirstOrderProcessor(), outputStructType=_with_fields(rows, T.StructField("if_first_order", T.StringType())),
        outputMode="Append", timeMode="None", initialState=init,
    ), "if_first_order")


def split_payment_stream(wide: DataFrame, ttl_ms: int | None = SPLIT_TTL_MS, order_key: str = "order_id",
                         line_key: str = "order_detail_id") -> DataFrame:
    """Payment split with per-order running sums in state.

    Lines are taken whenever they arrive. State expires ``ttl_ms`` of processing time after an
    order's last line. A query that expires state never runs out of batches, so a replay that is
    to stop by itself (``availableNow``) passes None and keeps its state. Nulls count as in the batch
    form: an amount as 0, and a share that cannot be computed is null. Orders share ``ORDER_BUCKETS`` states.
    """
    ensure_state_provider(wide.sparkSession)
    amount = (F.col("sku_price") * F.col("sku_num")).cast(MONEY)
    share0, zero = plain_share(F.col("final_total_amount"), amount, F.col("original_total_amount")), F.lit(0).cast("bigint")
    rows, back = keyed(
        wide.drop("final_detail_amount"), [order_key], ORDER_BUCKETS,
        pay_line=F.coalesce(F.col(line_key).cast("bigint"), F.lit(LAST)),
        pay_amount_c=F.coalesce(cents(amount), zero), pay_share0_c=F.coalesce(cents(share0), zero),
        pay_total_c=F.coalesce(cents(F.col("original_total_amount")), zero), pay_final_c=F.coalesce(cents(F.col("final_total_amount")), zero),
        pay_open=amount.isNull() | F.col("original_total_amount").isNull(),
        pay_no_share=share0.isNull(), pay_no_final=F.col("final_total_amount").isNull())
    out = back(rows.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=PaySplitProcessor(ttl_ms),
        outputStructType=_with_fields(rows, T.StructField("pay_share_c", T.LongType()), T.StructField("pay_last", T.BooleanType())),
        outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None",
    ), "pay_share_c", "pay_last", "pay_no_share", "pay_no_final")
    given = (F.col("pay_share_c").cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)
    share = F.when(~F.when(F.col("pay_last"), F.col("pay_no_final")).otherwise(F.col("pay_no_share")), given)
    cols = [c if c != "final_detail_amount" else share.alias(c) for c in wide.columns]
    return out.select(*cols)


def join_wide_stream(orders: DataFrame, details: DataFrame, within_s: int = 20, batch_s: int = 5,
                     delay: str = "20 seconds", dedup_delay: str | None = JOIN_DEDUP_DELAY) -> DataFrame:
    """Stream-stream join under the sliding-window condition, then one row per (order, line) (D6, F2). Rows older
    than the watermark of the batch before are dropped; ``LateRows`` counts them. The state of both sides is on the
    executors' disks (RocksDB), with one bounded cache an executor."""
    ensure_state_provider(orders.sparkSession)
    o = order_side(orders).withColumn("o__et", event_time(F.col("o_create_time"))).withWatermark("o__et", delay)
    d = detail_side(details).withColumn("d__et", event_time(F.col("d__ts"))).withWatermark("d__et", delay)
    cond = (o.o_order_id == d.d__order_id) & window_condition(o.o__et, d.d__et, within_s, batch_s, instant=True)
    joined = o.join(d, cond, "inner").drop("d__et")  # one event-time column downstream
    if dedup_delay:
        joined = joined.dropDuplicatesWithinWatermark(["o_order_id", "d_order_detail_id"])
    return wide_columns(joined)


def run_trademark_stat(wide: DataFrame, path: str, checkpoint: str, every: str = "5 seconds", **kw) -> StreamingQuery:
    """Sums per trademark and event-time bucket of each micro-batch, as the batch's own partition.

    Every row counts, however late: a bucket's amount is the sum of its increments.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(trademark_stat(batch, every=every), path, "batch_id", batch_id)

    return start(wide, checkpoint, foreach_batch=write, **kw)


def read_trademark_stat(spark: SparkSession, path: str) -> DataFrame:
    """The increments added up per bucket."""
    rows = spark.read.parquet(path)
    return rows.groupBy("stat_time", "trademark_id", "trademark_name").agg(exact_sum("amount").alias("amount"))


def run_decoded(rows: DataFrame, decode: Callable[[DataFrame], tuple[DataFrame, DataFrame]], shape: Callable[[DataFrame], DataFrame],
                path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Decode a topic's text; typed rows go to ``path/good``, unreadable text to ``path/bad``, each batch
    as its own partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good, bad = decode(batch)
            replace_batch(shape(good), f"{path}/good", "batch_id", batch_id)
            replace_batch(bad.select("value"), f"{path}/bad", "batch_id", batch_id)
        finally:
            batch.unpersist()

    return start(rows, checkpoint, foreach_batch=write, **kw)


STATUS = DIM_SPECS["user_status"]


def status_store(spark: SparkSession, root: str) -> DimStore:
    """The user status of the order job at ``root``."""
    return DimStore(spark, STATUS, f"{root}/status")


def run_orders(spark: SparkSession, orders: DataFrame, provinces: DataFrame, users: DataFrame, root: str,
               checkpoint: str, first_batch: int = 0, compact_every: int = 100,
               written: Callable[[str], None] = lambda name: None, **kw) -> StreamingQuery:
    """The order job (H8): calendar, first-order flag against the user status, province and user columns;
    then, from one persisted batch, new user status, the order index and the topic.

    Index and topic become visible together, by the manifest at ``root``. The status store is the
    memory of first orders, so a new run, also one with a new checkpoint, knows the users of
    earlier runs; it gives its batches numbers from ``first_batch`` on. Only the buckets of the
    batch's users are read, as they were before the batch, and every ``compact_every`` batches
    the store is compacted. The status is written before the manifest: a batch that fails in
    between is repeated, and its status replaced.
    """
    manifest, store = Manifest(spark, root), status_store(spark, root)

    def write(batch: DataFrame, batch_id: int) -> None:
        number = first_batch + batch_id
        if manifest.committed(number):
            return
        known = store.read(batch.select("user_id"), before=number)
        o = enrich_user(enrich_province(flag_first_order(order_calendar(batch), known), provinces), users).persist()
        try:
            store.append(new_user_status(o).withColumn("position", F.lit(0)), number, "position")
            written("status")
            manifest.write(number, lambda: {
                "index": daily_docs(o, "create_date", "id", ["create_time"]),
                "topics": to_topic(o, "dwd_order_info", key="id")}, written=written)
        finally:
            o.unpersist()
        if number % compact_every == 0:
            store.compact(number)

    return start(orders, checkpoint, foreach_batch=write, **kw)


def run_wide(wide: DataFrame, path: str, checkpoint: str, ttl_ms: int | None = SPLIT_TTL_MS, **kw) -> StreamingQuery:
    """The wide job (H8): the payment split in state, then each batch to the table and the topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            replace_batch(batch, f"{path}/table", "batch_id", batch_id)
            write_topics(to_topic(batch, "dws_order_wide", key="order_detail_id"), path=f"{path}/topics", fmt="parquet",
                         batch_id=batch_id)
        finally:
            batch.unpersist()

    return start(split_payment_stream(wide, ttl_ms), checkpoint, foreach_batch=write, **kw)


def run_ods(feed: DataFrame, path: str, checkpoint: str, route: Callable[[DataFrame], DataFrame] = route_row_feed,
            **kw) -> StreamingQuery:
    """The ODS job: a change feed routed to one topic per table, each batch in folders of its own.
    Messages that are not a JSON object go to ``<path>-unreadable``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_topics(route(batch), path=path, fmt="parquet", batch_id=batch_id)
        replace_batch(unreadable(batch).select("value"), f"{path}-unreadable", "batch_id", batch_id)

    return start(feed, checkpoint, foreach_batch=write, **kw)


def run_dim(spark: SparkSession, spec: DimSpec, source: DataFrame, path: str, checkpoint: str,
            order_col: str, **kw) -> StreamingQuery:
    """Upsert a dimension stream into its change log, one batch folder per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_changes(batch, spec, path, batch_id, order_col)

    return start(source, checkpoint, foreach_batch=write, **kw)


def run_dim_store(store: DimStore, source: DataFrame, checkpoint: str, order_col: str, compact_every: int = 100, keep: int = 1,
                  **kw) -> StreamingQuery:
    """Upsert a dimension stream into a keyed store (H9, A8), compacted between its batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            store.compact(batch_id, keep)  # the batches before this one are done
        store.append(batch, batch_id, order_col)

    return start(source, checkpoint, foreach_batch=write, **kw)


def enrich_stream(details: DataFrame, snapshot: Callable[[DataFrame, int], DataFrame], path: str, checkpoint: str,
                  enrich: Callable[[DataFrame, DataFrame], DataFrame], **kw) -> StreamingQuery:
    """Stream-static join inside ``foreachBatch``: ``snapshot`` gives the dimension for a batch and its number (H5).

    Each batch replaces its own output folder, so a replayed batch is not doubled.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = enrich(batch, snapshot(batch, batch_id))
        replace_batch(out, path, "batch_id", batch_id)

    return start(details, checkpoint, foreach_batch=write, **kw)


def run_timed_totals(spark: SparkSession, wide: DataFrame, root: str, checkpoint: str,
                     clock: Callable[[], str] | None = None, written: Callable[[str], None] = lambda name: None,
                     **kw) -> StreamingQuery:
    """Amount per trademark of each batch with the batch's time (H1, B16): one time for all rows of a batch, that of
    its first attempt. ``clock`` gives the time as text; without it, the session's wall clock."""
    manifest = Manifest(spark, root)
    now = clock or (lambda: spark.range(1).select(stamp()).first()[0])

    def write(batch: DataFrame, batch_id: int) -> None:
        if manifest.committed(batch_id):
            return
        at = manifest.begin(batch_id, now())
        manifest.write(batch_id, lambda: {"totals": trademark_total(batch).withColumn("stat_time", F.lit(at))}, at, written)

    return start(wide, checkpoint, foreach_batch=write, **kw)
