import datetime as dt

from pyspark.sql import functions as F

from tarn.functions import values as V


def one(spark, expr, data, schema="v string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_censor_symbols(spark):
    got = one(spark, V.censor_symbols("v"), [("<0.5",), (">20",), ("a<5",), (None,)])
    assert got == ["less_than_0.5", "greater_than_20", "a<5", None]


def test_numeric_value(spark):
    data = [("less_than_0.5",), ("greater_than_20",), ("less_than_0.5 ",), ("less_than_",),
            ("None",), ("missing",), ("NA",), ("*",), ("",), ("1,000",), ("1d",), ("12.5",),
            ("1e5",), (None,)]
    got = one(spark, V.numeric_value("v"), data)
    assert got == [0.5, 20.0, None, None, None, None, None, None, None, None, None, 12.5, 100000.0, None]


def test_censor_marker_and_adjust(spark):
    assert one(spark, V.censor_marker("v"), [("10.25",), ("less_than_10.25",)]) == [".", "less_than_."]
    df = spark.createDataFrame([("less_than_.", 0.5), ("greater_than_", 20.0), ("", 7.0), (None, 3.0)],
                               "c string, x double")
    got = [r[0] for r in df.select(V.adjusted_value("c", "x")).collect()]
    assert got[0] == 0.25 and round(got[1], 9) == 22.0 and got[2] == 7.0 and got[3] == 3.0


def test_obs_time(spark):
    data = [("20240131T010203",), ("2024-01-31T01:02:03",), ("missing",), ("20240230T010203",),
            ("2024-01-31T01:02:03.5",), (None,)]
    got = one(spark, V.obs_time("v"), data)
    want = dt.datetime(2024, 1, 31, 1, 2, 3)
    assert got == [want, want, None, None, None, None]


def test_record_key(spark):
    df = spark.createDataFrame(
        [("L1", "C1", "TN", "20240101T000000"), ("L1", "C1", "TN", "Missing"),
         (None, "C1", "TN", "x"), ("L1", None, "TN", "x"), ("L1", "C1", None, "x")],
        "a string, b string, c string, t string")
    got = [r[0] for r in df.select(V.record_key("a", "b", "c", "t", F.lit("2024-01-01"), F.lit("2030-01-01"))).collect()]
    assert got == ["L1_C1_TN_20240101T000000", "L1_C1_TN_error-2024-01-01-2030-01-01", None, None, None]


def test_strip_specials_keeps_macrons(spark):
    got = one(spark, V.strip_specials("v"), [("Lake Taupō/Rotorua-iti (ā)!",)])
    assert got == ["Lake TaupōRotoruaiti ā"]


def test_truncate_cell(spark):
    s253, s254 = "a" * 253, "b" * 254
    emoji = "😀" * 300
    got = one(spark, V.truncate_cell("v", 253), [(s253,), (s254,), (emoji,)])
    assert got == [s253, "b" * 253, "😀" * 253]
    assert one(spark, V.truncate_cell("v"), [(s254,), (emoji,)]) == [s254, emoji]


def test_split_position(spark):
    lat, lon = V.split_position("v")
    df = spark.createDataFrame([(" -41.2  174.7 ",), ("1",), ("1 2 3",), (None,)], "v string")
    got = [(r[0], r[1]) for r in df.select(lat, lon).collect()]
    assert got == [("-41.2", "174.7"), (None, None), (None, None), (None, None)]


def test_sanitise_name(spark):
    assert V.sanitise_name("main.temp (°C)") == "main_temp___C_"
    assert one(spark, V.sanitise_name_col("v"), [("Lake Taupō-1",)]) == ["Lake_Taupō_1"]


def test_nan_rejected_and_as_of(spark):
    assert one(spark, V.nan_to_null("x"), [(float("nan"),), (1.5,), (None,)], "x double") == [None, 1.5, None]
    got = one(spark, V.is_rejected_value("v"), [("1,000",), ("1d",), ("12.5",), ("NA",), ("less_than_1",), (None,)])
    assert got == [True, True, False, False, False, False]
    assert one(spark, V.as_of_date("v"), [("2024-03-01",)]) == ["2024-02-29"]


def test_tolerant_double(spark):
    got = one(spark, V.tolerant_double("v"), [("-41.5",), ("-99999",), ("abc",), ("1d",)])
    assert got == [-41.5, -99999.0, None, None]
