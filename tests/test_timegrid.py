import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quoteline.functions.timegrid import (
    bucket_start,
    ceil_to_grid_sql,
    end_of_day_sql,
    epoch_ms,
    epoch_ms_ntz_sql,
    floor_to_grid,
    format_time_sql,
    parse_interval,
    parse_time,
    parse_time_sql,
    validate_window,
)


def test_parse_time_forms():
    assert parse_time(1600000000250) == 1600000000250
    assert parse_time("1600000000250") == 1600000000250
    assert parse_time("2020-09-13_12:26:40.250") == 1600000000250
    # any separator before the milliseconds
    assert parse_time("2020-09-13_12:26:40:250") == 1600000000250
    assert parse_time("1970-01-01_00:00:00.000") == 0


def test_parse_time_before_1970_adds_milliseconds():
    # 1969-12-31 23:59:59 is -1 s; .500 makes it -500 ms (not the text "-1" + "500")
    assert parse_time("1969-12-31_23:59:59.500") == -500


def test_parse_time_errors():
    with pytest.raises(ValueError):
        parse_time("2020-09-13 12:26:40")
    for bad in ("2020-09-13_12:26:40.+25", "2020-13-01_00:00:00.000", "2020-09-13_12:26:40.2500", "2020-9-13_12:26:40.250"):
        with pytest.raises(ValueError):
            parse_time(bad)
    with pytest.raises(ValueError):
        parse_time("yesterday.001")
    with pytest.raises(TypeError):
        parse_time(True)
    with pytest.raises(ValueError):
        parse_time(1.5)


def test_interval_and_window_validation():
    assert parse_interval(60) == 60
    assert parse_interval("60") == 60
    assert parse_interval(2.5) == 2.5
    for bad in (0, -1, float("inf"), float("nan")):
        with pytest.raises(ValueError):
            parse_interval(bad)
    with pytest.raises(ValueError):
        parse_interval(2.5, integral=True)
    with pytest.raises(ValueError):
        validate_window(10, 5, 1)
    assert validate_window("1970-01-01_00:00:01.000", 2000, 100.0) == (1000, 2000, 100)


def test_column_forms(spark):
    df = spark.createDataFrame([(t,) for t in (-86400001, -1, 0, 1, 999, 86399999, 86400000, 1600000000250)], "t long")
    out = df.select(
        "t",
        F.expr(end_of_day_sql("t")).alias("eod"),
        F.expr(format_time_sql("t")).alias("txt"),
        F.expr(ceil_to_grid_sql("t", 1000, 300)).alias("up"),
        floor_to_grid(F.col("t"), 1000, 300).alias("down"),
        bucket_start(F.col("t"), 1000, 300).alias("b"),
    ).withColumn("back", F.expr(parse_time_sql("txt")))
    for r in out.collect():
        t = r["t"]
        assert r["eod"] == (t // 86400000) * 86400000 + 86399999
        assert parse_time(r["txt"]) == t
        assert r["back"] == t
        assert r["up"] >= t and (r["up"] - 1000) % 300 == 0 and r["up"] - t < 300
        assert r["down"] <= t and (r["down"] - 1000) % 300 == 0 and t - r["down"] < 300
        assert r["b"] == r["down"]


def test_fractional_bucket_follows_float_rule(spark):
    start, iv = 1000, 2.5
    ts = [1000, 1001, 1002, 1003, 1005, 1007, 1999]
    df = spark.createDataFrame([(t,) for t in ts], "t long")
    got = [r["b"] for r in df.select(bucket_start(F.col("t"), start, iv).alias("b")).collect()]
    assert got == [int(start + int((t - start) / iv) * iv) for t in ts]


def test_epoch_ms_of_timestamps_is_zone_free(spark):
    import datetime as dt

    rows = [(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),), (dt.datetime(1969, 12, 31, 23, 59, 59, 999500),),
            (dt.datetime(2024, 7, 1, 12, 30, 0, 1000),), (dt.datetime(2024, 3, 10, 2, 30, 0),)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("ts", T.TimestampNTZType())]))
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        expect = [1704067207179, -1, 1719837000001, 1710037800000]
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(epoch_ms(F.col("ts"), T.TimestampNTZType())).collect()]
            assert got == expect, zone
            as_text = [r[0] for r in df.selectExpr(epoch_ms_ntz_sql("ts")).collect()]
            assert as_text == expect, zone
            sql_text = df.selectExpr(f"{format_time_sql(epoch_ms_ntz_sql('ts'))} AS p").selectExpr(
                "p", f"{parse_time_sql('p')} AS back")
            assert [(parse_time(r["p"]), r["back"]) for r in sql_text.collect()] == [(e, e) for e in expect], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
