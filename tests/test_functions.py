"""Scalar functions on small hand-made rows: times, bins, labels, text, parsing."""

from pyspark.sql import functions as F

from dockcast.functions import bins as B
from dockcast.functions import text as TX
from dockcast.functions import time as TM


def _one(spark, exprs, data, schema):
    return spark.createDataFrame(data, schema).select(*exprs).collect()


def test_parse_update_time_offsets_and_junk(spark):
    rows = _one(spark, [TM.epoch_millis(TM.parse_update_time("s")).alias("ms"),
                        TM.hour_of_day(TM.parse_update_time("s")).alias("h")],
                [("2017-02-26T18:29:59+00:00",), ("2017-02-26T18:29:59+01:00",), ("2017-02-26T18:29:59Z",),
                 ("junk",), (None,), ("2017-13-26T18:29:59",)], "s string")
    assert [r.h for r in rows[:3]] == [18, 18, 18]          # wall clock kept, offset dropped
    assert rows[0].ms == rows[1].ms == rows[2].ms == 1488133799000
    assert all(r.ms is None for r in rows[3:])


def test_fixture_example_row(spark):
    """FIXTURES.md 1: 2017-02-26T18:29:59, 0 stands, 10 bikes -> day 0, hour 18, minute 25,
    nPlace 0, nBike 2, label 6, x 1105."""
    df = spark.createDataFrame([("2017-02-26T18:29:59+00:00", 0, 10)], "s string, places int, bikes int")
    ts = TM.parse_update_time("s")
    r = df.select(*TM.time_features(ts), B.count_bin("places").alias("nPlace"), B.count_bin("bikes").alias("nBike"),
                  B.class_label(B.count_bin("bikes"), B.count_bin("places")).alias("label")).first()
    assert (r.day, r.hour, r.minute, r.x) == (0, 18, 25, 1105)
    assert (r.nPlace, r.nBike, r.label) == (0.0, 2.0, 6.0)
    assert r.minute_of_week == 18 * 60 + 25


def test_minute_bucket_floors(spark):
    rows = _one(spark, [TM.minute_bucket("m").alias("b")], [(29,), (4,), (5,), (0,), (59,)], "m int")
    assert [r.b for r in rows] == [25, 0, 5, 0, 55]


def test_bin_edges(spark):
    rows = _one(spark, [B.count_bin("v").alias("b")], [(0,), (3,), (4,), (9,), (10,), (None,)], "v int")
    assert [r.b for r in rows] == [0.0, 0.0, 1.0, 1.0, 2.0, None]


def test_label_text_covers_all_classes(spark):
    rows = _one(spark, [B.label_text("l").alias("t")], [(float(i),) for i in range(9)] + [(9.0,)], "l double")
    texts = [r.t for r in rows]
    assert texts[0] == "bikes 0-3, places 0-3"
    assert texts[5] == "bikes 4-9, places 10+"
    assert texts[8] == "bikes 10+, places 10+"
    assert len(set(texts[:9])) == 9 and texts[9] is None


def test_clamp_and_warm_flag(spark):
    rows = _one(spark, [B.clamp("v").alias("c"), B.warm_flag("t").alias("w")],
                [(9, 14.9), (10, 15.0), (25, None)], "v int, t double")
    assert [(r.c, r.w) for r in rows] == [(9.0, 0.0), (10.0, 1.0), (10.0, None)]


def test_lenient_numbers(spark):
    rows = _one(spark, [TX.lenient_count("s").alias("n"), TX.lenient_number("s", "bigint").alias("id")],
                [("12",), (" 7 ",), ("12.9",), ("junk",), (None,)], "s string")
    assert [r.n for r in rows] == [12, 7, 12, 0, 0]
    assert [r.id for r in rows] == [12, 7, 12, None, None]


def test_topology_and_weights(spark):
    r = spark.createDataFrame([("5-20-20-9", "1.5;-2;3e-1;")], "t string, w string") \
        .select(TX.parse_topology("t").alias("t"), TX.parse_weights("w").alias("w")).first()
    assert r.t == [5, 20, 20, 9]
    assert r.w == [1.5, -2.0, 0.3]
    assert TX.topology_list("20-20") == [20, 20]


def test_shift_and_texts(spark):
    df = spark.createDataFrame([("2024-01-31 08:00:00", 37)], "s string, d bigint") \
        .select(F.col("s").cast("timestamp_ntz").alias("ts"), "d")
    r = df.select(TM.shift_minutes("ts", "d").alias("t")).select(
        TM.day_text("t").alias("a"), TM.short_text("t").alias("b"), TM.on_poll_minute("t").alias("p")).first()
    assert (r.a, r.b, r.p) == ("20240131", "31/01 08:37", False)


def test_time_functions_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = spark.createDataFrame([("2024-03-10T02:30:00+00:00",)], "s string").select(
            TM.epoch_millis(TM.parse_update_time("s")).alias("ms"), TM.hour_of_day(TM.parse_update_time("s")).alias("h"),
            TM.short_text(TM.from_epoch_millis(TM.epoch_millis(TM.parse_update_time("s")))).alias("t")).first()
        assert (r.ms, r.h, r.t) == (1710037800000, 2, "10/03 02:30")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
