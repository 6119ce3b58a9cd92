"""Keyed store, manifest, expiring state, late rows and the timed run."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakelayer.operators import dim_store
from lakelayer.operators.dim_store import DimStore
from lakelayer.operators.dims import DIM_SPECS
from lakelayer.sinks.manifest import Manifest
from lakelayer.sinks.once import names, read_text, write_once
from lakelayer.streaming.runs import finish, run_available
from lakelayer.streaming.twins import once_a_sighting, read_dau, run_dau, run_dim_store, run_timed_totals

TRADEMARK = DIM_SPECS["base_trademark"]


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id string, tm_name string, v int")


def _names(df):
    return {r["id"]: r["tm_name"] for r in df.collect()}


def test_a_place_keeps_its_first_text(spark, tmp_path):
    where = str(tmp_path / "a" / "b")
    assert read_text(spark, where) is None
    assert [write_once(spark, where, t) for t in ("one", "two")] == ["one", "one"]
    assert names(spark, str(tmp_path / "a")) == ["b"] and names(spark, str(tmp_path / "none")) == []


def test_keys_of_one_bucket_read_one_bucket(spark, tmp_path):
    store = DimStore(spark, TRADEMARK, str(tmp_path), buckets=16)
    rows = _rows(spark, [(str(i), f"n{i}", 1) for i in range(500)] + [(None, "nobody", 1)])
    store.append(rows, 0, "v")
    store.compact(1)
    store.append(_rows(spark, [(str(i), f"m{i}", 1) for i in range(0, 500, 2)]), 1, "v")
    want = {str(i): f"{'nm'[i % 2 == 0]}{i}" for i in range(500)}
    assert _names(store.read()) == {**want, None: "nobody"}
    keys = spark.createDataFrame([("7",)], "k string")
    found = store.read(keys)
    bucket = keys.select(store.bucket_of(F.col("k"))).first()[0]
    for f in tmp_path.rglob("*.parquet"):  # files of other buckets cannot be read any more
        if f"_bucket={bucket}" not in str(f):
            f.write_bytes(b"not parquet")
    for f in tmp_path.rglob(".*.crc"):
        f.unlink()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_bucket#" in plan.split("PartitionFilters")[1][:200]
    every = spark.createDataFrame([(k,) for k in want], "k string")
    same = [r["k"] for r in every.where(store.bucket_of(F.col("k")) == bucket).collect()]
    assert _names(found) == {k: want[k] for k in same} and "7" in same and len(same) < 100
    assert _names(store.read(keys.limit(0))) == {}


def test_compaction_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    store = DimStore(spark, TRADEMARK, str(tmp_path), buckets=4)
    for b in range(3):
        store.append(_rows(spark, [(str(i), f"{b}", 1) for i in range(b, 9)]), b, "v")
    want = {str(i): str(min(i, 2)) for i in range(9)}

    def stop(*_):
        raise RuntimeError("before the rename")

    with monkeypatch.context() as m:
        m.setattr(dim_store, "write_once", stop)
        with pytest.raises(RuntimeError):
            store.compact(2, keep=0)
    assert _names(store.read()) == want and store._generations() == []
    reader = store.read()  # planned on the log as it is
    store.compact(2, keep=1)
    assert _names(store.read()) == want and _names(reader) == want  # what the reader began with stays
    assert _names(store.read(before=2)) == {str(i): str(min(i, 1)) for i in range(9)}
    store.append(_rows(spark, [("0", "3", 1)]), 3, "v")
    store.compact(4, keep=0)
    assert _names(store.read()) == {**want, "0": "3"}
    assert store._generations() == [4] and store._batches() == []
    assert len(names(spark, str(tmp_path / "snapshots"))) == 1  # the unnamed one of the failure is gone as well
    with pytest.raises(ValueError):
        store.read(before=1)
    store.compact(4, keep=0)
    assert _names(store.read()) == {**want, "0": "3"}


def test_an_empty_store_and_repeated_batches(spark, tmp_path):
    store = DimStore(spark, TRADEMARK, str(tmp_path / "s"), buckets=4)
    assert store.read().collect() == [] and store.newest_batch() == 0
    for name in ("x", "y"):
        store.append(_rows(spark, [("1", name, 1), ("1", name + "2", 2)]), 5, "v")
    assert _names(store.read()) == {"1": "y2"} and _names(store.read(before=5)) == {}
    pins = str(tmp_path / "pins")
    assert _names(store.pinned(pins, 0)) == {"1": "y2"}
    store.append(_rows(spark, [("1", "z", 1)]), 6, "v")
    assert _names(store.pinned(pins, 0)) == {"1": "y2"} and _names(store.pinned(pins, 1)) == {"1": "z"}


def _stream(spark, path, batches, schema):
    """Each list of rows as one file, one file a micro-batch."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_the_store_is_compacted_between_batches(spark, tmp_path):
    batches = [[(str(i), f"{b}", b) for i in range(b, 6)] for b in range(4)]
    source = _stream(spark, str(tmp_path / "in"), batches, "id string, tm_name string, v int")
    store = DimStore(spark, TRADEMARK, str(tmp_path / "store"), buckets=4)
    finish(run_dim_store(store, source, str(tmp_path / "c"), "v", compact_every=1, keep=0, available_now=True))
    assert _names(store.read()) == {str(i): str(min(i, 3)) for i in range(6)}
    assert store._generations() == [3] and store._batches() == [3]


def test_outputs_of_a_batch_are_seen_together(spark, tmp_path):
    m = Manifest(spark, str(tmp_path))
    df = spark.createDataFrame([(1,)], "x int")

    def stop(name):
        if name == "a":
            raise RuntimeError("between a and b")

    with pytest.raises(RuntimeError):
        m.write(0, lambda: {"a": df, "b": df}, written=stop)
    assert m.read("a").count() == 0 and not m.committed(0)
    assert m.write(0, lambda: {"a": df, "b": df})
    assert not m.write(0, lambda: {"a": df.union(df), "b": df})  # named already: nothing is written
    assert [r["x"] for r in m.read("a").collect()] == [r["x"] for r in m.read("b").collect()] == [1]
    assert len(names(spark, f"{tmp_path}/a/batch_id=0", "attempt=")) == 2
    m.clean()
    assert len(names(spark, f"{tmp_path}/a/batch_id=0", "attempt=")) == 1 and m.read("a").count() == 1


COMMON = "struct<ar:string,uid:string,os:string,ch:string,md:string,mid:string,vc:string,ba:string>"
DAY = 86_400_000


def test_a_day_is_kept_a_day_longer_then_cleared(spark, tmp_path):
    """A row that comes 20 hours after its day's end is no first start; a day's state is gone when the timer has fired."""
    start = 1704067200000
    row = lambda ms, e, mid: (start + ms, e, ("a", str(e), "o", "c", "m", mid, "v", "b"))
    batches = [[row(1000, 1, "d1"), row(500, 2, "d1"), row(700, 3, "d2")], [row(DAY + 20 * 3_600_000, 4, "d3")],
               [row(900, 5, "d1"), row(DAY - 1, 6, "d4"), row(DAY + 5, 7, "d1")],  # 20 hours late: d1 known, d4 counts
               [row(3 * DAY, 8, "d3")], [row(3 * DAY + 1, 9, "d1")], [row(2 * DAY + 3_600_000, 10, "d5")]]
    stream = _stream(spark, str(tmp_path / "in"), batches, f"ts long, event_id long, common {COMMON}")
    finish(run_dau(spark, stream, str(tmp_path / "out"), str(tmp_path / "c"), available_now=True))
    got = {(r["dt"], r["mid"], r["uid"]) for r in read_dau(spark, str(tmp_path / "out")).collect()}
    assert got == {("2024-01-01", "d1", "2"), ("2024-01-01", "d2", "3"), ("2024-01-02", "d3", "4"), ("2024-01-01", "d4", "6"),
                   ("2024-01-02", "d1", "7"), ("2024-01-04", "d3", "8"), ("2024-01-04", "d1", "9"), ("2024-01-03", "d5", "10")}
    state = spark.read.format("statestore").option("stateVarName", "days").load(str(tmp_path / "c")).select("key.*", "user_map_key.*")
    assert {r["day"] for r in state.collect()} <= {"2024-01-02", "2024-01-03", "2024-01-04"}


def test_sightings_renew_the_memory(spark, tmp_path):
    at = lambda m: 1_704_067_200 + m * 60
    batches = [[("a", at(0)), ("b", at(0))], [("a", at(5)), ("b", at(11))], [("a", at(14)), ("a", at(26))], [("b", at(20)), ("a", at(37))]]
    stream = _stream(spark, str(tmp_path / "in"), batches, "k string, s long").withColumn("at", F.timestamp_seconds("s"))
    run_available(once_a_sighting(stream, ["k"], "at"), str(tmp_path / "c"), path=str(tmp_path / "out"))
    got = sorted((r["k"], (r["s"] - 1_704_067_200) // 60) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # 5 and 14 follow a sighting within 10 minutes, 26 and 37 do not; b: 11 passes, 20 does not
    assert got == [("a", 0), ("a", 26), ("a", 37), ("b", 0), ("b", 11)]


WIDE = "tm_id long, tm_name string, final_detail_amount decimal(18,2)"


def test_a_repeated_batch_keeps_its_time(spark, tmp_path):
    """The timed run fails between the output and its naming, is started again and stopped from outside."""
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    stream = _stream(spark, path, [[(1, "a", Decimal(5))], [(1, "a", Decimal(7)), (2, "b", Decimal(1))]], WIDE)
    clock = iter(["10:00", "10:05", "10:10", "10:15"])
    fail = {1}

    def written(name):
        if name == "totals" and len(names(spark, f"{root}/manifest")) in fail:
            fail.clear()
            raise RuntimeError("stopped")

    run = lambda: run_timed_totals(spark, stream, root, str(tmp_path / "c"), clock=lambda: next(clock), written=written, trigger="100 milliseconds")
    with pytest.raises(Exception, match="stopped"):
        run().processAllAvailable()
    q = run()
    q.processAllAvailable()
    q.stop()
    got = sorted((r["batch_id"], r["stat_time"], r["trademark_id"], r["amount"]) for r in Manifest(spark, root).read("totals").collect())
    assert got == [(0, "10:00", 1, Decimal(5)), (1, "10:05", 1, Decimal(7)), (1, "10:05", 2, Decimal(1))]
