"""Read and append analytics rows over JDBC (A5-A7 reads, A10 append).

Both are Spark's own JDBC source and sink. The append keeps the warehouse's
settings: batches of 100 rows, 3 writers, no transaction (each batch commits on
its own, so a retried task may add a batch twice; pair it with a table that
de-duplicates on its key, or use the file sinks for exactly-once).

A large read is split over ``num_partitions`` range queries on a numeric
column; without one, the whole query is read by a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The warehouse's JDBC append settings.
APPEND_BATCH_ROWS = 100
APPEND_WRITERS = 3


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    batchsize: int = APPEND_BATCH_ROWS,
    writers: int = APPEND_WRITERS,
    isolation: str = "NONE",
    **props: str,
) -> None:
    """Append ``df`` to ``table``; ``writers`` caps the open connections.

    Spark coalesces to ``numPartitions`` before writing, so the cap bounds the
    load on the database, not the parallelism of the job that made ``df``.
    """
    w = (
        df.write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", str(batchsize))
        .option("numPartitions", str(writers))
        .option("isolationLevel", isolation)
    )
    for k, v in props.items():
        w = w.option(k, v)
    w.save()


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int | None = None,
    fetchsize: int = 10_000,
    **props: str,
) -> DataFrame:
    """Rows of a query or table; columns and types come from the result metadata."""
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetchsize))
    if partition_column:
        if bounds is None or not num_partitions:
            raise ValueError("a partition column needs bounds and num_partitions")
        # Spark's range split works on dbtable; wrap a query as a derived table.
        src = table if table else f"({query}) q"
        r = (
            r.option("dbtable", src)
            .option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(num_partitions))
        )
    elif table:
        r = r.option("dbtable", table)
    else:
        r = r.option("query", query)
    for k, v in props.items():
        r = r.option(k, v)
    return r.load()
