"""Batches of documents that ask questions of hash-partitioned corpus statistics.

Documents are dealt into batches (one shuffle of the texts, shared by the steps of a
query). A batch reduces its texts to distinct 64-bit hashes, sorts them and cuts the
sorted array into parts by hash range; each part is one row of packed numbers. A part
gathers the rows of all batches, works over the union, and answers each batch with an
array aligned to what it asked. So statistics over the whole corpus are found without
any of it in one place, no hash is sent twice by a batch, and a frequent hash costs a
part one entry per batch.

A batch is a group of rows in one task: ``spark.sql.shuffle.partitions`` has to be sized
so that its texts, some tens of MB, fit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .arrow import prepare

FOLD = np.uint64(0x9E3779B97F4A7C15)


def batches_and_parts(spark: SparkSession) -> int:
    prepare(spark)
    return shuffle_partitions(spark)


def dealt(docs: DataFrame, batches: int, *columns) -> DataFrame:
    """``docs`` as doc_id, text, ``columns``, batch; equal rows may share a batch, equal texts do not."""
    return docs.select("doc_id", "text", *columns,
                       F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int").alias("batch"))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close ones over the whole range."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def chained(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a pair of hashes; the order counts."""
    return mixed(left * FOLD + mixed(right + FOLD))


def cuts(sorted_hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where the sorted hashes of part 0, 1, ... begin and end: ``parts + 1`` positions."""
    edges = [(p << 64) // parts for p in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(sorted_hashes, np.array(edges, np.uint64), "left"),
                           [len(sorted_hashes)]]).astype(np.int64)


def packed(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def unpacked(table: pa.Table, column: str, dtype) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype) for b in table.column(column).to_pylist()]


def planes(x: np.ndarray) -> bytes:
    """The bytes of sorted numbers, all first bytes together and so on, which compresses well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def from_planes(body: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    rows = np.frombuffer(body, np.uint8).reshape(size, -1).T
    return np.ascontiguousarray(rows).view(dtype).ravel()
