import datetime as dt

from pyspark.sql import functions as F

from runway.functions import packed, text, timecols


def one(spark, expr, value, schema):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr).first()[0]


def test_block_hour(spark):
    df = spark.createDataFrame([("0600-0659",), ("0001-0559",), ("",), (None,)], "b string")
    got = [r[0] for r in df.select(timecols.block_hour("b")).collect()]
    assert got == [6, 0, None, None]


def test_hhmm_round_hour_rounds_half_up(spark):
    df = spark.createDataFrame([(1750,), (1749,), (50,), (5,), (2359,)], "t int")
    got = [r[0] for r in df.select(timecols.hhmm_round_hour("t")).collect()]
    assert got == [18, 17, 1, 0, 24]


def test_minutes_to_hours(spark):
    df = spark.createDataFrame([(90.0,), (89.0,), (None,)], "m double")
    assert [r[0] for r in df.select(timecols.minutes_to_hours("m")).collect()] == [2, 1, None]


def test_hhmm_timestamp_cases(spark):
    df = spark.createDataFrame(
        [(dt.date(2018, 1, 2), 5, 2400), (dt.date(2018, 1, 2), 2330, 115)], "d date, dep int, arr int")
    got = df.select(timecols.hhmm_timestamp("d", "dep").alias("a"),
                    timecols.hhmm_timestamp("d", "arr").alias("b")).collect()
    assert got[0]["a"] == dt.datetime(2018, 1, 2, 0, 5)
    assert got[0]["b"] is None                      # 24:00 -> NULL, no ANSI error
    assert got[1]["b"] == dt.datetime(2018, 1, 2, 1, 15)   # overnight keeps the departure date
    assert df.select(timecols.hhmm_timestamp("d", "dep")).schema[0].dataType.typeName() == "timestamp_ntz"


def test_trunc_hour_is_time_zone_free(spark):
    df = spark.createDataFrame([("2024-01-05 05:50:59",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert df.select(timecols.trunc_hour("t")).first()[0] == dt.datetime(2024, 1, 5, 5, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_plus_one_day(spark):
    assert one(spark, timecols.plus_one_day("d"), "2019-03-15", "d string") == dt.date(2019, 3, 16)


def test_city_key_cleanup_order(spark):
    df = spark.createDataFrame([("New York, NY",), ("St. Louis, MO",), ("Kansas City, MO",),
                                ("Dallas/Fort Worth, TX",), (None,)], "c string")
    got = [r[0] for r in df.select(text.city_key(text.comma_part("c", 0))).collect()]
    assert got == ["NEW YORK", " LOUIS", "KANSAS", "DALLAS FORT WORTH", None]


def test_comma_part_keeps_leading_space_and_is_null_safe(spark):
    df = spark.createDataFrame([("JFK INTERNATIONAL AIRPORT, NY US",), ("NO COMMA",)], "n string")
    got = [r[0] for r in df.select(text.comma_part("n", 1)).collect()]
    assert got == [" NY US", None]


def test_concat_key_null_part_gives_null(spark):
    df = spark.createDataFrame([("AA", 12), (None, 7)], "c string, n int")
    got = [r[0] for r in df.select(text.concat_key("c", "n", sep="_")).collect()]
    assert got == ["AA_12", None]


def test_delay_label(spark):
    df = spark.createDataFrame([(135.4,), (-3.0,), (0.0,), (None,)], "x double")
    got = [r[0] for r in df.select(text.delay_label("x")).collect()]
    assert got == [" 2h15m", "-1h57m", " 0h 0m", None]


def test_call_sign(spark):
    assert one(spark, text.call_sign("c"), "JFK", "c string") == "KJFK"


def _decode(spark, **packs):
    cols = ["TMP", "WND", "VIS", "DEW", "SLP", "AA1"]
    row = tuple(packs.get(c) for c in cols)
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in cols))
    return df


def test_decode_plain_values(spark):
    df = _decode(spark, TMP="+0056,1", WND="310,1,N,0046,1", VIS="016000,1,9,9", DEW="-0044,1",
                 SLP="10132,1", AA1="01,0005,9,5")
    m = packed.decoded_measures()
    r = df.select(*[c.alias(k) for k, c in m.items()]).first()
    assert round(r["temp_f"], 6) == 42.08
    assert round(r["dew_pt_f"], 6) == 24.08
    assert round(r["wnd_mps"], 6) == 4.6
    assert r["vis_m"] == 16000.0
    assert round(r["slp_hpa"], 6) == 1013.2
    assert round(r["precip_mm"], 6) == 0.5


def test_decode_placeholders_and_bad_packs(spark):
    df = _decode(spark, TMP="+9999,9", AA1="00,0005,9,5")
    r = df.select(*[c.alias(k) for k, c in packed.decoded_measures().items()]).first()
    assert round(r["temp_f"], 2) == 1831.82          # faithful default
    assert r["precip_mm"] is None                      # zero period
    assert r["wnd_mps"] is None                        # NULL pack
    r = df.select(*[c.alias(k) for k, c in packed.decoded_measures(missing_codes=True).items()]).first()
    assert r["temp_f"] is None
    short = _decode(spark, TMP="", AA1="01")
    r = short.select(*[c.alias(k) for k, c in packed.decoded_measures().items()]).first()
    assert r["temp_f"] is None and r["precip_mm"] is None


def test_text_sub_fields_kept_as_text(spark):
    df = _decode(spark, TMP="+0056,1", WND="310,1,N,0046,1")
    r = df.select(*[c.alias(k) for k, c in packed.text_sub_fields().items()]).first()
    assert r["temp_qual"] == "1" and r["wnd_deg"] == "310" and r["wnd_2"] == "N"
