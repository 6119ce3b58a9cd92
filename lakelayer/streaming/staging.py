"""Lay a table out as a stream of files in event-time order (test and replay input).

The table is cut into time slices of equal width. It is written once, partitioned by slice and
by a hash of the row, so every slice consists of as many files, ``FILES`` or one for ``FILE_BYTES`` of
the whole table, written (and later read) by as many tasks, with its rows in no order. A file source takes
files by modification time; the files of a slice get a time after those of the slice before, so a
source that takes a slice's number of files per micro-batch replays the table slice by slice. Slices are written
in up to ``TURNS`` turns, each of which reads the base copy and drops its shuffle, and the copy goes when its last slice
is written, so little more than the staged files of a large table is on disk at a time. A last slice may hold one probe row far
in the future that only pushes the watermark; its keys are set by the caller so that its
outputs can be filtered away.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import elapsed
from ..session import shuffles_dropped
from ..sinks.batches import delete_folder
from ..sinks.once import read_text, write_once

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
PROBE_SHIFT_DAYS = 30
FILES = 8
FILE_BYTES = 16 << 20  # of the base copy (compressed columns) to a file of a slice: some 100 MB of rows when shuffled
SLICE_BYTES = 1 << 30  # of the base copy to a slice whose number is not given, and to a turn of writing slices at least
TURNS = 3
SLICE, FILE = "_slice", "_file"


def micros(ts: str) -> Column:
    """A wall-clock time as the number by which slices are cut."""
    return (elapsed(F.expr(_EPOCH_NTZ), ts) * 1000000).cast("bigint")


def _as_number(df: DataFrame, ts: str) -> Column:
    dtype = df.schema[ts].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return micros(ts)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(ts))
    return F.col(ts).cast("bigint")


def _shifted(df: DataFrame, ts: str, col: Column) -> Column:
    dtype = df.schema[ts].dataType
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.timestamp_add("DAY", F.lit(PROBE_SHIFT_DAYS), col)
    return col + F.lit(PROBE_SHIFT_DAYS * 86400 * 1000)


def time_bounds(df: DataFrame, ts: str) -> tuple[int, int]:
    """(min, max) of the time column as numbers (one aggregate row)."""
    with shuffles_dropped(df.sparkSession):
        row = df.agg(F.min(_as_number(df, ts)).alias("lo"), F.max(_as_number(df, ts)).alias("hi")).first()
    return int(row["lo"]), int(row["hi"])


def _order_files(spark: SparkSession, path: str) -> None:
    """Give the files of slice i the i-th time; a file source reads them in this order."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for s in fs.listStatus(root):
        name = s.getPath().getName()
        if name.startswith(f"{SLICE}="):
            when = 1_000_000_000_000 + int(name.split("=")[1]) * 60_000
            for d in fs.listStatus(s.getPath()):
                for f in fs.listStatus(d.getPath()):
                    fs.setTimes(f.getPath(), when, -1)


def _fill(spark: SparkSession, path: str, schema: T.StructType, files: int) -> None:
    """Empty files for hashes that no row of a slice has, so that a number of files never reaches into the next slice."""
    jvm = spark.sparkContext._jvm
    conf, hadoop = spark.sparkContext._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path}/files")
    fs = root.getFileSystem(conf)
    empty = None
    for s in fs.listStatus(root):
        if s.getPath().getName().startswith(f"{SLICE}="):
            there = {d.getPath().getName() for d in fs.listStatus(s.getPath())}
            for name in (f"{FILE}={i}" for i in range(files)):
                if name not in there:
                    if empty is None:
                        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/_empty")
                        empty = next(f.getPath() for f in fs.listStatus(hadoop.Path(f"{path}/_empty"))
                                     if f.getPath().getName().endswith(".parquet"))
                    fs.mkdirs(hadoop.Path(s.getPath(), name))
                    hadoop.FileUtil.copy(fs, empty, fs, hadoop.Path(s.getPath(), f"{name}/{empty.getName()}"), False, conf)


def folder_bytes(spark: SparkSession, path: str) -> int:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def files_a_slice(spark: SparkSession, path: str) -> int:
    """The number of files that a slice below ``path`` was dealt over."""
    text = read_text(spark, f"{path}/_files")
    return int(text) if text else FILES


def base_copy(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as the base copy at ``path``, and read from it; the shuffles that made it are deleted."""
    spark = df.sparkSession
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(f"{path}/_base")
    return spark.read.schema(df.schema).parquet(f"{path}/_base")


def slices_by_size(spark: SparkSession, *paths: str) -> int:
    """A slice for ``SLICE_BYTES`` of the base copies at ``paths``."""
    return max(1, -(-sum(folder_bytes(spark, f"{p}/_base") for p in paths) // SLICE_BYTES))


def stage_by_time(
    df: DataFrame,
    ts: str,
    path: str,
    slices: int | None = 2,
    probe: Mapping[str, Column] | None = None,
    first: int = 0,
    last: int | None = None,
    bounds: tuple[int, int] | None = None,
    own_base: bool = False,
    copied: bool = False,
) -> T.StructType:
    """Write slices ``first..last-1`` of ``df`` (and the probe row, if given) to ``path``. Later slices of a
    path use the copy of ``df`` made with the first. ``own_base`` asks for a copy of these slices alone (the
    bounds must be given). Without ``slices`` there is one for ``SLICE_BYTES``, two at least, and all are written. ``copied``: ``df`` is the
    ``base_copy`` at ``path``, and ``slices`` suit its size."""
    spark = df.sparkSession
    base_path = f"{path}/_base"

    def number(rows: DataFrame, lo: int, hi: int) -> Column:
        width = max(1, (hi - lo) // slices + 1)
        return F.least(F.floor((_as_number(rows, ts) - F.lit(lo)) / F.lit(width)), F.lit(slices - 1))

    if own_base and (bounds is None or slices is None or last is None):
        raise ValueError("a copy of some slices needs the bounds of all")
    if slices is None and (first or last is not None):
        raise ValueError("some slices need the number of all")
    with shuffles_dropped(spark):
        if own_base:
            base_copy(df.where(number(df, *bounds).between(first, last - 1)), path)
        elif first == 0 and not copied:
            base_copy(df, path)
        size = folder_bytes(spark, base_path)
        # a slice may hold all rows of a copy of few slices; what was dealt first fixes the number for later slices of the path
        by_size = copied or slices is None
        if slices is None:
            slices = max(2, slices_by_size(spark, path))
        shared = max(1, slices // 2) if by_size else 1
        last = slices if last is None else last
        files = int(write_once(spark, f"{path}/_files", str(max(FILES, -(-size // (FILE_BYTES * shared))))))
        base = spark.read.schema(df.schema).parquet(base_path)
        lo, hi = bounds if bounds is not None else time_bounds(base, ts)
        text = F.to_json(F.struct(*base.columns))
        turn = max(-(-(last - first) // TURNS), (last - first) * SLICE_BYTES // max(1, size))
        for begin in range(first, last, turn):
            end = min(begin + turn, last)
            rows = base.withColumn(SLICE, number(base, lo, hi)).where(F.col(SLICE).between(begin, end - 1))
            if probe is not None and end >= slices:
                row = base.groupBy().agg(F.max_by(F.struct(*base.columns), F.col(ts)).alias("r")).select("r.*")
                row = row.withColumn(ts, _shifted(base, ts, F.col(ts)))
                for c, v in probe.items():
                    row = row.withColumn(c, v.cast(base.schema[c].dataType))
                rows = rows.unionByName(row.withColumn(SLICE, F.lit(slices).cast(rows.schema[SLICE].dataType)))
            dealt = rows.withColumn(FILE, F.pmod(F.xxhash64(text), F.lit(files)))
            dealt.repartition(files * (end - begin), SLICE, FILE).write.mode("append").partitionBy(SLICE, FILE).parquet(f"{path}/files")
    if by_size:
        _fill(spark, path, base.schema, files)
    if last >= slices:
        delete_folder(spark, base_path)
    _order_files(spark, f"{path}/files")
    return base.schema


def stream_of(spark: SparkSession, schema: T.StructType, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The staged files as a stream, a slice to a micro-batch."""
    n = files_per_batch or files_a_slice(spark, path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", n).parquet(f"{path}/files")
    return stream.select(*schema.names)
