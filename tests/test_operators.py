from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.operators.cdc import route_array_feed, route_row_feed, unreadable
from lakelayer.operators.dau import dau_document, dau_first, start_log_calendar
from lakelayer.operators.dedup import first_seen, latest_per_key
from lakelayer.operators.dims import DIM_SPECS, append_changes, compact, read_dim
from lakelayer.operators.orders import enrich_province, flag_against_status, flag_first_order, new_user_status
from lakelayer.operators.prefix import grouped_prefix_sums
from lakelayer.operators.split import split_payment
from lakelayer.operators.stats import trademark_stat, trademark_total
from lakelayer.operators.wide import join_wide
from lakelayer.sinks.docs import read_daily_docs, write_daily_docs
from lakelayer.sinks.topics import write_topics
from lakelayer.sources.decode import ORDER_INFO_SCHEMA, decode

WIDE = ("order_detail_id long, order_id long, sku_price decimal(18,2), sku_num long, "
        "original_total_amount decimal(18,2), final_total_amount decimal(18,2), final_detail_amount decimal(18,2)")


def _wide(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], WIDE)


def _shares(df):
    return [r["final_detail_amount"] for r in df.orderBy("order_detail_id").collect()]


@pytest.mark.parametrize("lines_per_slice", [4096, 2, 1])
def test_split_three_lines(spark, lines_per_slice):
    w = _wide(spark, [(1, 7, Decimal(33), 1, Decimal(100), Decimal(90)),
                      (2, 7, Decimal(33), 1, Decimal(100), Decimal(90)),
                      (3, 7, Decimal(34), 1, Decimal(100), Decimal(90))])
    got = _shares(split_payment(w, lines_per_slice=lines_per_slice))
    assert got == [Decimal("29.70"), Decimal("29.70"), Decimal("30.60")]


def test_split_missing_lines_take_no_remainder(spark):
    # Lines add up to 66 of 100: no line is "last", every line gets its plain share.
    w = _wide(spark, [(1, 7, Decimal(33), 1, Decimal(100), Decimal(90)),
                      (2, 7, Decimal(33), 1, Decimal(100), Decimal(90))])
    assert _shares(split_payment(w)) == [Decimal("29.70"), Decimal("29.70")]


def test_split_zero_order_takes_remainder_without_division(spark):
    w = _wide(spark, [(1, 8, Decimal(0), 1, Decimal(0), Decimal(10)),
                      (2, 8, Decimal(0), 3, Decimal(0), Decimal(10))])
    assert _shares(split_payment(w)) == [Decimal("10.00"), Decimal("0.00")]


def test_split_shares_sum_to_paid_with_rounding(spark):
    rows = [(i, 9, Decimal("3.33"), 1, Decimal("9.99"), Decimal("10.00")) for i in range(1, 4)]
    got = _shares(split_payment(_wide(spark, rows)))
    assert sum(got) == Decimal("10.00") and got[:2] == [Decimal("3.33"), Decimal("3.33")]


def test_prefix_with_hot_group_over_many_slices(spark):
    df = spark.range(0, 50000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 101).alias("g"),
        F.col("id").alias("o"), (F.col("id") % 7).alias("v"))
    got = grouped_prefix_sums(df, ["g"], ["o"], ["v"], [F.floor(F.col("o") / 1000)])
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.select("g", "o", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("v_before"))
    assert got.select("g", "o", "v_before").exceptAll(exp).count() == 0
    assert got.count() == 50000


def test_prefix_keeps_values_and_null_groups(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(None, 1, 5, big), (None, 2, None, None), (None, 3, 7, 1), (1, 1, 2, None), (1, 9, 3, big)],
                               "g long, o long, v long, other long")
    got = grouped_prefix_sums(df, ["g"], ["o"], ["v"], [F.floor(F.col("o") / 2)])
    assert sorted((r["g"] or 0, r["o"], r["v_before"]) for r in got.collect()) == [
        (0, 1, 0), (0, 2, 5), (0, 3, 5), (1, 1, 0), (1, 9, 2)]
    assert sorted(r["other"] or 0 for r in got.collect()) == [0, 0, 1, big, big]


def test_lookup_keeps_one_row_per_fact(spark):
    orders = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id long, province_id long")
    province = spark.createDataFrame([("5", "old", "a", "i", 1), ("5", "new", "b", "j", 2), (None, "x", "x", "x", 9)],
                                     "id string, name string, area_code string, iso_code string, version int")
    got = enrich_province(orders, province, order=["version"])
    assert sorted((r["id"], r["province_name"]) for r in got.collect()) == [(1, "new"), (2, None), (3, None)]
    again = enrich_province(orders, province.drop("version"))  # without an order the choice is still fixed
    assert again.count() == 3


def test_sums_of_cents_are_exact(spark):
    w = spark.createDataFrame([(1, "a", Decimal("900719925474099.33"))] * 30, "tm_id long, tm_name string, final_detail_amount decimal(18,2)")
    assert trademark_total(w).first()["amount"] == Decimal("900719925474099.33") * 30


def test_dimension_log(spark, tmp_path):
    spec = DIM_SPECS["base_trademark"]
    path = str(tmp_path / "log")
    rows = lambda *r: spark.createDataFrame(list(r), "id string, tm_name string, pos long")
    append_changes(rows(("1", "a", 5), ("1", "b", 7), ("2", "c", 6)), spec, path, 0, "pos")  # two changes of a key
    append_changes(rows(("2", "d", 1)), spec, path, 1, "pos")
    latest = lambda p=path: sorted(tuple(r) for r in read_dim(spark, spec, p).collect())
    assert latest() == [("1", "b"), ("2", "d")]
    append_changes(rows(("2", "d", 1)), spec, path, 1, "pos")  # a replay
    assert latest() == [("1", "b"), ("2", "d")]
    compact(spark, spec, path, str(tmp_path / "compact"))
    assert latest(str(tmp_path / "compact")) == latest()
    append_changes(rows(("2", "d", 1)).limit(0), spec, path, 1, "pos")  # a replay that is empty now
    assert latest() == [("1", "b"), ("2", "c")]


def test_daily_index_takes_the_last_of_a_batch(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs = spark.createDataFrame([("2024-01-01", "a", 2, "last"), ("2024-01-01", "a", 1, "first"), ("2024-01-02", "a", 1, "x")],
                                 "day0 string, id string, pos long, v string")
    write_daily_docs(docs, "day0", "id", path, 0, order=["pos"])
    write_daily_docs(docs, "day0", "id", path, 0, order=["pos"])
    got = sorted((r["day"], r["id"], r["v"]) for r in read_daily_docs(spark, path).collect())
    assert got == [("2024-01-01", "a", "last"), ("2024-01-02", "a", "x")]


def test_topic_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "topics")
    df = spark.createDataFrame([("t1", "x"), ("t2", "y")], "topic string, value string")
    for batch in (0, 0, 1):
        write_topics(df, path=path, fmt="parquet", batch_id=batch)
    assert spark.read.parquet(path).groupBy("topic").count().orderBy("topic").collect() == [("t1", 2), ("t2", 2)]


def test_first_order_flags(spark):
    orders = spark.createDataFrame([
        (1, 10, "2024-01-01 10:00:00"), (2, 10, "2024-01-01 09:00:00"), (3, 10, "2024-01-02 00:00:00"),
        (4, 20, "2024-01-01 00:00:00"),  # user 20 has ordered before
        (5, 30, "2024-01-01 00:00:00"), (6, 30, "2024-01-01 00:00:00"),  # tie -> smaller id
    ], "id long, user_id long, create_time string").withColumn("create_time", F.to_timestamp_ntz("create_time"))
    status = spark.createDataFrame([("20", "1")], "user_id string, if_consumed string")
    got = {r["id"]: r["if_first_order"] for r in flag_first_order(orders, status).collect()}
    assert got == {1: "0", 2: "1", 3: "0", 4: "0", 5: "1", 6: "0"}
    naive = {r["id"]: r["if_first_order"] for r in flag_against_status(orders, status).collect()}
    assert naive == {1: "1", 2: "1", 3: "1", 4: "0", 5: "1", 6: "1"}
    assert sorted(r["user_id"] for r in new_user_status(flag_first_order(orders, status)).collect()) == ["10", "30"]


def test_join_window(spark):
    orders = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "id long, create_time string") \
        .withColumn("create_time", F.to_timestamp_ntz("create_time"))
    details = spark.createDataFrame([(11, 1, "2024-01-01 00:00:03"), (12, 1, "2024-01-01 00:00:15"),
                                     (13, 1, "2024-01-01 00:00:24"), (14, 1, "2023-12-31 23:59:50")],
                                    "id long, order_id long, create_time string") \
        .withColumn("create_time", F.to_timestamp_ntz("create_time"))
    got = sorted(r["order_detail_id"] for r in join_wide(orders, details).collect())
    assert got == [11, 12, 14]  # 24 s away misses every 20 s window
    assert join_wide(orders, details, within_s=None).count() == 4


def test_first_seen_and_latest(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 0, "a"), (2, 5, "c"), (2, 5, "c")], "k long, o long, v string")
    assert sorted(tuple(r) for r in first_seen(df, ["k"], ["o"]).collect()) == [(1, 0, "a"), (2, 5, "c")]
    assert sorted(tuple(r) for r in latest_per_key(df, ["k"], ["o"]).collect()) == [(1, 1, "b"), (2, 5, "c")]


def test_dau_first_start_per_device_per_day(spark):
    common = "struct<ar:string,uid:string,os:string,ch:string,md:string,mid:string,vc:string,ba:string>"
    rows = [(1704153599000, 2, ("a", "1", "o", "c", "m", "d1", "v", "b")),   # 2024-01-01 23:59:59
            (1704153601000, 3, ("a", "1", "o", "c", "m", "d1", "v", "b")),   # next day
            (1704067200000, 1, ("a", "1", "o", "c", "m", "d1", "v", "b")),   # first of day 1
            (1704067200000, 0, ("a", "2", "o", "c", "m", "d2", "v", "b"))]
    logs = spark.createDataFrame(rows, f"ts long, event_id long, common {common}")
    docs = dau_document(dau_first(start_log_calendar(logs))).collect()
    got = sorted((r["dt"], r["mid"], r["ts"], r["hr"], r["mi"]) for r in docs)
    assert got == [("2024-01-01", "d1", 1704067200000, "0", "00"), ("2024-01-01", "d2", 1704067200000, "0", "00"),
                   ("2024-01-02", "d1", 1704153601000, "0", "00")]


def test_trademark_keys(spark):
    w = spark.createDataFrame([
        (1, "Brand_A", Decimal("1.10"), "2024-01-01 00:00:01"), (1, "Brand_A", Decimal("2.20"), "2024-01-01 00:00:04"),
        (None, None, Decimal("5.00"), "2024-01-01 00:00:06"), (2, "", Decimal("1.00"), "2024-01-01 00:00:06"),
    ], "tm_id long, tm_name string, final_detail_amount decimal(18,2), create_time string") \
        .withColumn("create_time", F.to_timestamp_ntz("create_time"))
    tot = {(r["trademark_id"], r["trademark_name"]): r["amount"] for r in trademark_total(w).collect()}
    assert tot == {(1, "Brand_A"): Decimal("3.30"), (0, None): Decimal("5.00"), (2, ""): Decimal("1.00")}
    stat = sorted((r["stat_time"], r["trademark_id"]) for r in trademark_stat(w).collect())
    assert stat == [("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:05", 0), ("2024-01-01 00:00:05", 2)]


def test_decode_is_lenient_and_quarantines(spark):
    df = spark.createDataFrame([
        ('{"ID": "7", "user_id": 3, "Final_Total_Amount": "12.50", "extra": 1, "create_time": "2024-01-01 00:00:00"}',),
        ('{"id": 8}',),
        ("not json",),
        ('{"id": "x"}',),
    ], "value string")
    good, bad = decode(df, ORDER_INFO_SCHEMA)
    rows = {r["id"]: r for r in good.collect()}
    assert rows[7]["user_id"] == 3 and rows[7]["final_total_amount"] == Decimal("12.50")
    assert str(rows[7]["create_time"]) == "2024-01-01 00:00:00"
    assert rows[8]["user_id"] is None
    assert None in rows  # "x" is not a number: the field is null, the row is kept
    assert [r["value"] for r in bad.collect()] == ["not json"]
    twice = spark.createDataFrame([('{"id": 1, "ID": 2}',)], "value string")  # the last counts
    assert decode(twice, ORDER_INFO_SCHEMA)[0].first()["id"] == 2


def test_cdc_routing_rules(spark):
    arr = spark.createDataFrame([
        ('{"type":"INSERT","table":"t1","data":[{"id":"1"},{"id":"2"}]}',),
        ('{"type":"insert","table":"t1","data":[{"id":"3"}]}',),
        ('{"type":"UPDATE","table":"t2","data":[{"id":"4"}]}',),
    ], "value string")
    got = sorted((r["topic"], r["value"]) for r in route_array_feed(arr).collect())
    assert got == [("ods_t1", '{"id":"1"}'), ("ods_t1", '{"id":"2"}')]
    exact = '{"b":1442.00,"a":12345678901234567.89,"c":123456789012345678901234567890123456789012,"s":"1.50 \\"2\\""}'
    sent = spark.createDataFrame([('{"type":"INSERT","table":"t1","data":[' + exact + ']}',)], "value string")
    assert [r["value"] for r in route_array_feed(sent).collect()] == [exact]
    sent = spark.createDataFrame([('{"type":"insert","table":"order_info","data":' + exact + '}',)], "value string")
    assert [r["value"] for r in route_row_feed(sent).collect()] == [exact]
    row = spark.createDataFrame([
        ('{"type":"insert","table":"order_info","data":{"id":"1"}}',),
        ('{"type":"update","table":"order_info","data":{"id":"2"}}',),
        ('{"type":"delete","table":"sku_info","data":{"id":"3"}}',),
        ('{"type":"bootstrap-start","table":"sku_info","data":{}}',),
        ('{"type":"insert","table":"sku_info","data":null}',),
        ('{"type":"insert","table":"sku_info"}',),
        ('{"type":"insert","table":"other","data":{"id":"9"}}',),
    ], "value string")
    assert sorted(r["topic"] for r in route_row_feed(row).collect()) == ["ods_order_info", "ods_sku_info"]
    assert [r["topic"] for r in route_row_feed(row, drop_deletes=True).collect()] == ["ods_order_info"]


E000 = ""


@pytest.mark.parametrize("text", [f"{E000}12{E000}", f"a{E000}{E000}b", f"{E000}", "", "0", f"x\\\\{E000}1.5{E000}", "1,2.5 [3.4]",
                                  "\\ue00012.0\\ue000", "\\\\ue0001.5"])
@pytest.mark.parametrize("number", ["1442.00", "1234567890123456.78", "9" * 40, "-0.10e5", '"12.50"'])
def test_records_and_fields_keep_every_text_and_number(spark, text, number):
    """Private-use characters, raw or escaped, and long decimals come through both readers."""
    import json

    record = f'{{"id":"1","t":"{text}","n":{number}}}'
    want = (json.loads(f'"{text}"'), number.strip('"'))
    message = f'{{"database":"d","table":"order_info","type":"insert","ts":1,"data":{record}}}'
    array = message.replace('"insert"', '"INSERT"').replace(f'"data":{record}', f'"data":[{record},{record}]')
    out = [r["value"] for r in route_row_feed(spark.createDataFrame([(message,)], "value string")).collect()]
    out += [r["value"] for r in route_array_feed(spark.createDataFrame([(array,)], "value string")).collect()]
    assert len(out) == 3
    for v in out:
        assert json.loads(v)["t"] == want[0] and f'"n":{number}' in v
    fields = decode(spark.createDataFrame([(record,)], "value string"), T.StructType([
        T.StructField("t", T.StringType()), T.StructField("n", T.StringType())]))[0].first()
    assert tuple(fields) == want


def test_unquoted_decimals_are_exact(spark):
    df = spark.createDataFrame([('{"id": 5, "final_total_amount": 1234567890123456.78, "feight_fee": 0.10}',)], "value string")
    got = decode(df, ORDER_INFO_SCHEMA)[0].first()
    assert (got["id"], got["final_total_amount"], got["feight_fee"]) == (5, Decimal("1234567890123456.78"), Decimal("0.10"))


def test_unreadable_messages_are_told_apart(spark):
    rows = ['{"type":"insert","table":"order_info","data":{"id":"1"}}', '{"a":1}', '{"type":"ins', "", "[1]", None]
    got = [r["value"] for r in unreadable(spark.createDataFrame([(r,) for r in rows], "value string")).collect()]
    assert sorted(map(str, got)) == sorted(['{"type":"ins', "", "[1]", "None"])
