"""A keyed dimension and state store on files.

Changes are kept by batch and by bucket, a hash of the key, as folders. So a reader that asks
for keys reads the buckets of these keys only: the distinct buckets (as many numbers as there
are buckets, at most) become a partition filter, and other folders are never opened.

    <path>/log/_batch=<n>/_bucket=<b>/      the last change of each key in the batch
    <path>/snapshots/<n>-<id>/_bucket=<b>/  the last row of each key before batch <n>
    <path>/generations/<n>                  names the snapshot before batch <n>

A reader takes the newest generation and the batches from it on. Compaction writes a snapshot
beside the one in use, then names it: the name appears by one rename, so before it readers see
the old generation and after it the new one, and a failure before it leaves nothing but an
unnamed folder. What no kept generation needs is removed after.

A snapshot as of a batch (``pinned``) is written down by the first run of a batch, so that a
repeated batch sees the dimension that the first run saw, whatever came in between.

Defined cases: a null key is kept as a key of its own and matches no request; of changes of a key
in a batch the last by order counts, ties by the other columns; a store that was never written
reads as empty.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.batches import delete_folder, exists, replace_batch
from ..sinks.once import names, read_text, write_once
from .dedup import latest_per_key
from .dims import BATCH_COL, ORDER_COL, DimSpec, spec_columns

BUCKET_COL = "_bucket"
BUCKETS = 256


@dataclass(frozen=True)
class DimStore:
    """The store of one dimension below ``path``. The number of buckets is fixed with the first write."""

    spark: SparkSession
    spec: DimSpec
    path: str
    buckets: int = BUCKETS

    # -------------------------------------------------------------- layout

    def _schema(self, *more: str) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.spec.columns] + [
            T.StructField(ORDER_COL, T.LongType())] + [T.StructField(c, T.LongType()) for c in more])

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets))

    def _generations(self) -> list[int]:
        return sorted(int(n) for n in names(self.spark, f"{self.path}/generations"))

    def _batches(self) -> list[int]:
        return [int(n.split("=")[1]) for n in names(self.spark, f"{self.path}/log", f"{BATCH_COL}=")]

    def _generation(self, before: int | None) -> int | None:
        """The newest generation that holds nothing of ``before`` or later."""
        fit = [g for g in self._generations() if before is None or g <= before]
        return fit[-1] if fit else None

    # -------------------------------------------------------------- write

    def append(self, rows: DataFrame, batch_id: int, order_col: str) -> None:
        """Write the changes of a batch; a repeated batch replaces its own."""
        ordered = rows.withColumn(ORDER_COL, F.col(order_col).cast("bigint"))
        last = latest_per_key(ordered.select(*spec_columns(ordered, self.spec), ORDER_COL), [self.spec.key],
                              [ORDER_COL, *self.spec.columns])
        dealt = last.withColumn(BUCKET_COL, self.bucket_of(F.col(self.spec.key))).repartition(BUCKET_COL)  # a file a bucket
        replace_batch(dealt, f"{self.path}/log", BATCH_COL, batch_id, [BUCKET_COL])

    # -------------------------------------------------------------- read

    def _buckets_of(self, keys: DataFrame) -> list[int]:
        """The distinct buckets of the keys (one column): at most ``buckets`` numbers, whatever the keys."""
        return [r[0] for r in keys.select(self.bucket_of(F.col(keys.columns[0])).alias("b")).distinct().collect()]

    def _rows(self, before: int | None) -> DataFrame:
        """Snapshot and later changes, several rows a key, with batch, order and bucket."""
        generation = self._generation(before)
        if generation is None and before is not None and self._generations():
            raise ValueError(f"batch {before} is older than the oldest generation kept")
        parts = []
        if generation is not None:
            folder = read_text(self.spark, f"{self.path}/generations/{generation}")
            parts.append(self.spark.read.schema(self._schema(BUCKET_COL)).parquet(f"{self.path}/snapshots/{folder}").withColumn(
                BATCH_COL, F.lit(-1).cast("bigint")))
        if exists(self.spark, f"{self.path}/log"):
            log = self.spark.read.schema(self._schema(BATCH_COL, BUCKET_COL)).parquet(f"{self.path}/log")
            parts.append(log.where(F.col(BATCH_COL) >= (generation if generation is not None else -(1 << 62))))
        if not parts:
            return self.spark.createDataFrame([], self._schema(BUCKET_COL, BATCH_COL))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out if before is None else out.where(F.col(BATCH_COL) < before)

    def read(self, keys: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """The last row of each key; ``keys`` (one column): only those in the buckets of these keys, for a
        join that follows; ``before``: as it was before that batch."""
        rows = self._rows(before)
        if keys is not None:
            rows = rows.where(F.col(BUCKET_COL).isin(self._buckets_of(keys)))
        last = latest_per_key(rows, [self.spec.key], [BATCH_COL, ORDER_COL])
        return last.select(*self.spec.columns)

    def newest_batch(self) -> int:
        """The number after the newest batch in the log (a folder name), or the newest generation."""
        held = [b + 1 for b in self._batches()]
        return max([*held, *self._generations(), 0])

    def pinned(self, pins: str, batch_id: int, keys: DataFrame | None = None) -> DataFrame:
        """The dimension as the first run of ``batch_id`` saw it; the first run writes that down below ``pins``."""
        before = int(write_once(self.spark, f"{pins}/{int(batch_id)}", str(self.newest_batch())))
        return self.read(keys, before=before)

    # -------------------------------------------------------------- compact

    def compact(self, before: int, keep: int = 1) -> None:
        """Make a generation of all batches below ``before``. ``keep`` earlier generations stay, for readers that
        began with them; older ones, and the batches that only they need, are removed."""
        if before not in self._generations():
            folder = f"{int(before)}-{uuid.uuid4().hex[:8]}"
            rows = latest_per_key(self._rows(before), [self.spec.key], [BATCH_COL, ORDER_COL]).drop(BATCH_COL)
            rows.repartition(BUCKET_COL).write.partitionBy(BUCKET_COL).parquet(f"{self.path}/snapshots/{folder}")
            write_once(self.spark, f"{self.path}/generations/{int(before)}", folder)
        generations = self._generations()
        kept = generations[-1 - keep:]  # before the first one, everything is in the log
        in_use = {read_text(self.spark, f"{self.path}/generations/{g}") for g in kept}
        for g in generations[: len(generations) - len(kept)]:
            delete_folder(self.spark, f"{self.path}/generations/{g}")
        for folder in names(self.spark, f"{self.path}/snapshots"):
            if folder not in in_use:
                delete_folder(self.spark, f"{self.path}/snapshots/{folder}")
        for batch in self._batches() if len(generations) > keep else []:
            if batch < kept[0]:
                delete_folder(self.spark, f"{self.path}/log/{BATCH_COL}={batch}")
