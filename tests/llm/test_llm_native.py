"""Operators of DataFrame functions: exact deduplication and sharding."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from lakelayer.llm.exact_dedup import exact_dedup, keep_first_copies
from lakelayer.llm.sharding import ROUNDS, place, shard_documents


def test_hash_collisions_are_told_apart(make_docs):
    docs = make_docs([(1, "ab"), (2, "cd"), (3, "a\tb"), (4, "a  b"), (5, "cd")])
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(docs, content_hash=F.length).collect()}
    assert got == {1: (1, 1, True), 2: (2, 2, True), 5: (2, 2, False), 3: (3, 2, True), 4: (3, 2, False)}


def test_copies_of_one_text_are_combined_before_the_shuffle(make_docs):
    plan = exact_dedup(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "partial_min" in plan


def test_keep_first_copies_goes_by_id_and_text(make_docs):
    docs = make_docs([(3, "x y"), (5, "x  y"), (5, "z"), (7, "z")])
    assert sorted((r["doc_id"], r["text"]) for r in keep_first_copies(docs).collect()) == [(3, "x y"), (5, "z")]


def _keyed(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def _place(row, rows, seed=0):
    a = math.ceil(math.sqrt(rows))
    b = -(-rows // a)

    def once(x):
        left, right = divmod(x, b)
        for i in range(ROUNDS):
            if i % 2 == 0:
                left = (left + _keyed(seed, i, right)) % a
            else:
                right = (right + _keyed(seed, i, left)) % b
        return left * b + right

    y = once(row)
    while y >= rows:
        y = once(y)
    return y


def test_place_is_the_feistel_permutation(spark):
    for rows in (1, 2, 3, 7, 50, 101):
        got = spark.range(rows).select("id", place(F.col("id"), F.lit(rows).cast("long"), seed=3).alias("p")).collect()
        assert {r["id"]: r["p"] for r in got} == {i: _place(i, rows, 3) for i in range(rows)}
        assert sorted(r["p"] for r in got) == list(range(rows))


def test_shards(make_docs):
    rnd = random.Random(5)
    rows = [(i, "é" * rnd.randint(0, 9) if i % 9 else None) for i in rnd.sample(range(10_000), 203)]
    out = shard_documents(make_docs(rows)).collect()
    again = shard_documents(make_docs(rows[::-1]).repartition(5)).collect()
    assert sorted(out) == sorted(again)
    sizes = Counter(r["shard"] for r in out)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(n))
    text = dict(rows)
    for r in out:
        data = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    # the order is shuffled, not the order of ids
    assert [r["doc_id"] for r in sorted(out, key=lambda r: (r["slot"], r["shard"]))] != sorted(text)


def test_the_cost_of_a_place_does_not_grow_with_the_rows(spark):
    """The walk is evaluated only where the first image lies outside: as good as never at 10^10 + 1 rows."""
    import time

    def seconds(rows):
        df = spark.range(2000).select(place(F.col("id") + F.lit(rows // 2), F.lit(rows).cast("long")).alias("p"))
        df.agg(F.max("p")).collect()
        t = time.perf_counter()
        assert df.agg(F.max("p")).first()[0] < rows
        return time.perf_counter() - t

    # walking for every row took 80 times as long at the greater count
    assert seconds(10**10 + 1) < 8 * seconds(10**4 + 1) + 1
