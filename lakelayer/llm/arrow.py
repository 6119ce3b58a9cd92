"""Small helpers for Arrow-batched Python stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Ship the package and bound the rows of an Arrow batch, as a row may hold a very long text."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` on every Arrow batch of ``df``. Ids stay Arrow values, so a null beside a large id does no harm."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := fn(b)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def gather(values: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of ``values`` one after the other (run i begins at ``starts[i]``), and their running ends."""
    sizes = starts[which + 1] - starts[which]
    ends = np.cumsum(sizes)
    pick = np.repeat(starts[which] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    return values[pick], ends
