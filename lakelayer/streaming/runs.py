"""Start streaming queries.

The position in the source and the state of every stateful operator live in
the checkpoint folder; a restarted query resumes from it. Outputs are written
after the batch and the commit log after the output, so delivery is at least
once; ``foreachBatch`` writers that replace the batch's own partition make it
exactly once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..session import shuffles_dropped

# Fixed value: the warehouse's batch interval.
BATCH_INTERVAL = "5 seconds"


def start(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    fmt: str = "parquet",
    output_mode: str = "append",
    trigger: str | None = BATCH_INTERVAL,
    available_now: bool = False,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    query_name: str | None = None,
    **opts: str,
) -> StreamingQuery:
    """Start ``df`` into a sink: a file/Kafka sink by ``fmt``, or ``foreach_batch``."""
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt)
        if path:
            w = w.option("path", path)
    for k, v in opts.items():
        w = w.option(k, v)
    with shuffles_dropped(df.sparkSession):
        return w.start()


def run_available(df: DataFrame, checkpoint: str, **kw) -> StreamingQuery:
    """Process everything available now, in as many batches as the source allows, and stop."""
    return finish(start(df, checkpoint, available_now=True, **kw))


def finish(q: StreamingQuery) -> StreamingQuery:
    """Wait for a query that stops by itself; its failure is raised."""
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")
    return q


class LateRows(StreamingQueryListener):
    """Counts, by query and batch, the rows that stateful operators dropped as older than the watermark (H3).

    Register with ``spark.streams.addListener`` before the query starts. ``rows`` gives the counts
    as a table, a row a batch that dropped any, with the batch's watermark.
    """

    def __init__(self) -> None:
        self.counts: dict[tuple[str, int], tuple[int, str]] = {}
        self.ended: set[str] = set()  # run ids

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        if dropped:
            self.counts[str(p.id), p.batchId] = (dropped, p.eventTime.get("watermark", ""))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def wait(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Until the events of a run that has ended are all here (they come a little later)."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self.ended and time.monotonic() < until:
            time.sleep(0.05)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(q, b, n, w) for (q, b), (n, w) in sorted(self.counts.items())],
                                     "query string, batch_id bigint, dropped bigint, watermark string")
