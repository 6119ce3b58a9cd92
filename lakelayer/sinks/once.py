"""Small files that appear whole and once, through Spark's file system.

A text is written under a name of its own and renamed to its place. A rename either happens or
does not, so a reader sees the whole text or none; and a place that is taken keeps what it has,
so of two writers (a batch and its replay) the first decides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text at ``path``, None if there is none. For small files only."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> str:
    """Put ``text`` at ``path`` unless there is one already; the text that is there in the end."""
    there = read_text(spark, path)
    if there is not None:
        return there
    fs, where = _fs(spark, path)
    fs.mkdirs(where.getParent())
    jvm = spark.sparkContext._jvm
    own = jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_writing-{uuid.uuid4().hex}")
    stream = fs.create(own)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(own, where):
        fs.delete(own, False)
    return read_text(spark, path)


def names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """The names in a folder that begin with ``prefix``, sorted; without one, those of files being written are left out."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(n for n in found if (n.startswith(prefix) if prefix else not n.startswith(("_", "."))))
