"""Subscribe to a topic (A1, A3).

With Kafka on the classpath this is ``readStream.format("kafka")``; the resume
position is the query checkpoint (``startingOffsets`` applies to the first run
only). The same call reads a folder per topic in file formats, which is what
the tests use: there is no Kafka connector in this image.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic(
    spark: SparkSession,
    topic: str,
    fmt: str = "kafka",
    start: str = "latest",
    path: str | None = None,
    stream: bool = True,
    **opts: str,
) -> DataFrame:
    """A stream (or batch) of ``value`` text (+ ``topic``) from one topic.

    ``fmt="kafka"`` needs ``kafka.bootstrap.servers`` in ``opts``. For file
    formats, ``path`` is the folder that holds the topic's folder.
    """
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        r = reader.format("kafka").option("subscribe", topic)
        if stream:
            r = r.option("startingOffsets", start)
        for k, v in opts.items():
            r = r.option(k, v)
        return r.load().select(
            F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp"
        )
    where = f"{path.rstrip('/')}/{topic}" if path else topic
    r = reader.format(fmt)
    for k, v in opts.items():
        r = r.option(k, v)
    if fmt == "text":
        df = r.load(where)
    else:
        r = r.schema("value string")
        df = r.load(where)
    return df.select(F.col("value"), F.lit(topic).alias("topic"))
