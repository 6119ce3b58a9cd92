from decimal import Decimal

from pyspark.sql import functions as F

from lakelayer.functions import dates as D
from lakelayer.functions.money import round_cents
from lakelayer.operators.dims import AGE_LABELS, GENDER_LABELS, derive_user


def test_round_cents_is_half_up_on_doubles(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-0.005,), (0.125,), (29.7,)], "x double")
    got = [r[0] for r in df.select(round_cents("x")).collect()]
    # floor(x*100 + 0.5)/100 in double precision: 1.005*100 is 100.49999999999999 (-> 1.00, where
    # round() gives 1.01); 2.675*100 is exactly 267.5 (-> 2.68); -0.005 -> 0.00 (round() gives -0.01).
    assert got == [Decimal("1.00"), Decimal("2.68"), Decimal("0.00"), Decimal("0.13"), Decimal("29.70")]


def test_date_scalars(spark):
    df = spark.createDataFrame([("2024-01-01 08:00:00", "2024-01-01 08:15:00", ""),
                                ("2024-01-02", "2024-01-01 23:59:59", None),
                                ("not a time", "2024-01-01 00:00:00", "x")], "a string, b string, c string")
    rows = df.select(D.epoch_ms(F.col("a")).alias("ms"), D.seconds_between(F.col("a"), F.col("b")).alias("s"),
                     D.is_blank(F.col("c")).alias("blank")).collect()
    assert rows[0]["ms"] == 1704067200000  # 08:00 at +08:00 is midnight UTC
    assert rows[0]["s"] == 900
    assert rows[1]["s"] == -1  # date without time parses as midnight
    assert rows[2]["ms"] is None and rows[2]["s"] is None
    assert [r["blank"] for r in rows] == [True, True, False]


def test_wall_clock_texts_do_not_pass_through_an_instant(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # skips 02:00-03:00 on this day
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00", "2024-03-10 03:30:00")], "a string, b string")
        r = df.select(D.time_text(D.parse_time("a")).alias("t"), D.seconds_between("a", "b").alias("s")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert tuple(r) == ("2024-03-10 02:30:00", 3600)


def test_calendar_of_epoch_ms_follows_zone(spark):
    df = spark.createDataFrame([(1704067200000,)], "ts long")  # 2024-01-01 00:00 UTC
    utc = df.select(D.wallclock_of_epoch_ms(F.col("ts")).alias("w")).first()["w"]
    sh = df.select(D.wallclock_of_epoch_ms(F.col("ts"), "Asia/Shanghai").alias("w")).first()["w"]
    assert str(utc) == "2024-01-01 00:00:00" and str(sh) == "2024-01-01 08:00:00"


def test_age_bands_and_gender_names(spark):
    asof = "2024-01-01 00:00:00"
    users = spark.createDataFrame([
        ("a", "2004-09-27 00:00:00", "M"),   # 19 (365-day years)
        ("b", "2003-12-27 00:00:00", "F"),   # 20 -> middle band
        ("c", "1993-12-29 00:00:00", "m"),   # 30 -> middle band
        ("d", "1992-12-29 00:00:00", ""),    # 31
        ("e", "2030-01-01 00:00:00", None),  # future birthday: negative age, first band
        ("f", "1990-06-01", "M"),            # no time part
        ("g", "garbage", "M"),               # unreadable
    ], "id string, birthday string, gender string")
    got = {r["id"]: (r["age_group"], r["gender_name"]) for r in derive_user(users, asof).collect()}
    young, middle, old = AGE_LABELS
    male, female = GENDER_LABELS
    assert got["a"] == (young, male)
    assert got["b"] == (middle, female)
    assert got["c"] == (middle, female)  # lower-case m is not M
    assert got["d"] == (old, female)     # empty gender -> second name
    assert got["e"] == (young, female)   # null gender -> second name
    assert got["f"] == (old, male)
    assert got["g"] == (None, male)
