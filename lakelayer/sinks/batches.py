"""Write a batch as partitions of its own, so that a repeated batch replaces itself.

The batch id comes first in the folder layout. A replay deletes the whole batch folder and
writes it again, also when the new batch is empty: dynamic partition overwrite would leave
the old rows of an empty batch in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exists(spark, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def delete_folder(spark, path: str) -> None:
    """Delete a folder through the file system that Spark uses for it; a missing one is fine."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def replace_batch(df: DataFrame, path: str, batch_col: str, batch_id: int, by: Sequence[str] = (),
                  fmt: str = "parquet") -> None:
    """Make ``df`` the contents of batch ``batch_id`` below ``path``."""
    delete_folder(df.sparkSession, f"{path}/{batch_col}={int(batch_id)}")
    out = df.withColumn(batch_col, F.lit(int(batch_id)).cast("bigint"))
    out.write.mode("append").partitionBy(batch_col, *by).format(fmt).save(path)
