r"""Reproducible global shuffle into shards, DataFrame functions only.

Every document gets a global row number, a Feistel permutation sends that number
to its place in the shuffled order, and the place gives shard and slot by
division: ``shard = place % shards``, ``slot = place / shards``. Anyone can compute
the place of a row number (and back) from the row count and the seed alone.

* Row numbers: rows are cut into ``buckets`` by a hash of the id, numbered inside
  each bucket by (id, size, crc), and offset by the sizes of the buckets before.
  Only the bucket sizes (``BUCKETS`` rows at most) meet in one place.
* Feistel network over ``a * b >= rows`` with a mixed radix (a, b): alternately the
  left half is shifted by a keyed function of the right, modulo a, and the right by
  one of the left, modulo b, which is a permutation of the a * b numbers.
* Cycle walking: a place beyond the row count is permuted again until it falls
  inside. At most ``a * b - rows < a`` numbers lie outside, so the walk of a row
  ends within that many steps; this bound, not a guess, sizes the walk.

The law is ``rows``: shard counts differ by at most one, slots have no gaps.

Defined cases: a null text has size 1 and crc 0; null or repeated ids are numbered
like others (equal rows among themselves in any order, which no output shows);
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .registry import register, table

SHARDS = 16
BUCKET_ROWS = 250_000  # about, of a bucket that one task numbers
BUCKETS = 1 << 17  # at most; their sizes meet in one place
ROUNDS = 6


def _keyed(*parts: Column | str) -> Column:
    """The round function: 60 bits of an MD5 over the parts, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def _permuted(x: Column, a: Column, b: Column, seed: int, rounds: int) -> Column:
    """The Feistel image of ``x`` in [0, a * b)."""
    start = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, b).alias("r"))

    def step(s: Column, i: Column) -> Column:
        key = lambda half: _keyed(F.lit(str(seed)), i.cast("string"), half.cast("string"))
        left = F.struct(F.pmod(s["l"] + key(s["r"]), a).alias("l"), s["r"].alias("r"))
        right = F.struct(s["l"].alias("l"), F.pmod(s["r"] + key(s["l"]), b).alias("r"))
        return F.when(i % 2 == 0, left).otherwise(right)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step, lambda s: s["l"] * b + s["r"])


def place(row: Column, rows: Column, seed: int = 0, rounds: int = ROUNDS) -> Column:
    """The shuffled place in [0, rows) of row number ``row``."""
    a = F.ceil(F.sqrt(rows.cast("double"))).cast("long")
    b = F.ceil(rows / a).cast("long")
    def walked(once: Column) -> Column:
        # only a row whose first image lies outside walks: about one in sqrt(rows)
        walk = F.aggregate(
            F.sequence(F.lit(1).cast("long"), a * b - rows),
            once, lambda y, _: F.when(y < rows, y).otherwise(_permuted(y, a, b, seed, rounds)))
        return F.when(once < rows, once).otherwise(walk)

    # the image is computed once: the fold of no elements, whose end result is the walk
    first = F.aggregate(F.array().cast("array<int>"), _permuted(row, a, b, seed, rounds), lambda y, _: y, walked)
    return F.when(rows > 0, first)


def global_row_numbers(rows: DataFrame, key: list[str], buckets: int | None = None) -> DataFrame:
    """``rows`` with ``row_no`` (0 .. n-1, no gaps) and ``n_rows``; the order is fixed by ``key`` and the
    number of buckets, by default one for ``BUCKET_ROWS`` rows."""
    buckets = buckets or min(max(4096, -(-rows.count() // BUCKET_ROWS)), BUCKETS)
    b = rows.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    sizes = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    w = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "_bucket", (F.sum("_size").over(w) - F.col("_size")).alias("_before"),
        F.sum("_size").over(every).alias("n_rows"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key))
    # offsets has at most ``buckets`` rows of three longs
    return (b.withColumn("_inside", inside.cast("long"))
            .join(F.broadcast(offsets), "_bucket")
            .withColumn("row_no", F.col("_before") + F.col("_inside") - 1)
            .drop("_bucket", "_before", "_inside"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = 0, buckets: int | None = None) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    numbered = global_row_numbers(rows, ["doc_id", "size", "text_crc32"], buckets)
    placed = numbered.withColumn("place", place(F.col("row_no"), F.col("n_rows"), seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_no")


@register("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
