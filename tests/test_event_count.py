import datetime as dt

import pytest
from pyspark.sql import types as T

from quoteline import event_count, time_range

SCHEMA = "created long"


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_worked_example(spark):
    # start 1000, end 1300, interval 100; 999, 1300 and null are out of range, bucket 1100 is empty
    df = spark.createDataFrame([(t,) for t in (999, 1000, 1099, 1250, 1300, None)], SCHEMA)
    out = event_count(df, 1000, 1300, 100)
    assert out.schema["timestamp"].dataType == T.LongType()
    assert out.schema["count"].dataType == T.LongType()
    assert _rows(out) == [(1000, 2), (1200, 1)]


def test_sorted_and_sparse(spark):
    rows = [(5000 + 7 * i,) for i in range(500)] + [(1000,)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = _rows(event_count(df, 1000, 9000, 250))
    assert [t for t, _ in got] == sorted(t for t, _ in got)
    expect = {}
    for (t,) in rows:
        if 1000 <= t < 9000:
            b = 1000 + (t - 1000) // 250 * 250
            expect[b] = expect.get(b, 0) + 1
    assert dict(got) == expect
    assert sum(c for _, c in got) == time_range(df, 1000, 9000).count()


def test_fractional_interval(spark):
    ts = list(range(1000, 1100, 3))
    df = spark.createDataFrame([(t,) for t in ts], SCHEMA)
    got = dict(_rows(event_count(df, 1000, 1100, 7.5)))
    expect = {}
    for t in ts:
        b = int(1000 + int((t - 1000) / 7.5) * 7.5)
        expect[b] = expect.get(b, 0) + 1
    assert got == expect


def test_time_parameters_as_text(spark):
    df = spark.createDataFrame([(1349159961001,), (1349159961500,)], SCHEMA)
    out = event_count(df, "2012-10-02_06:39:21.001", "2012-10-02_06:39:22.000", 1000)
    assert _rows(out) == [(1349159961001, 2)]


def test_timestamp_input_and_pushdown(spark, workdir):
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType())])
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0, 499999),), (dt.datetime(2024, 1, 1, 0, 0, 0, 500000),),
            (dt.datetime(2024, 1, 1, 1, 0, 0, 499999),), (dt.datetime(2024, 1, 1, 1, 0, 0, 500000),)]
    spark.createDataFrame(rows, schema).write.parquet(f"{workdir}/ev")
    df = spark.read.parquet(f"{workdir}/ev")
    start = 1704067200500
    out = event_count(df, start, start + 3600000, 3600000, time_col="ts")
    assert _rows(out) == [(start, 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_bad_parameters(spark):
    df = spark.createDataFrame([(1,)], SCHEMA)
    with pytest.raises(ValueError):
        event_count(df, 10, 5, 1)
    with pytest.raises(ValueError):
        event_count(df, 0, 5, 0)


def test_equals_window_function(spark):
    # The bucket equals Spark's tumbling window with a start offset, on real timestamps
    from pyspark.sql import functions as F

    from quoteline.functions.timegrid import epoch_ms

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    start, end, iv = 1704067200500, 1705795200000, 3600000
    ours = {tuple(r) for r in event_count(ev, start, end, iv, time_col="ts", sort=False).collect()}
    ms = epoch_ms(F.col("ts"), T.TimestampNTZType())
    win = (
        ev.where((ms >= start) & (ms < end))
        .groupBy(F.window("ts", "3600000 milliseconds", "3600000 milliseconds", f"{start % iv} milliseconds"))
        .agg(F.count("*").alias("count"))
        .select(epoch_ms(F.col("window.start"), T.TimestampNTZType()).alias("timestamp"), "count")
    )
    assert ours == {tuple(r) for r in win.collect()}
    assert len(ours) > 0


def test_negative_times(spark):
    df = spark.createDataFrame([(t,) for t in (-301, -300, -1, 0, 99)], SCHEMA)
    assert _rows(event_count(df, -300, 100, 100)) == [(-300, 1), (-100, 1), (0, 2)]


def test_int_time_column_with_large_bounds(spark, workdir):
    spark.createDataFrame([(5,), (15,), (2147483647,)], "created int").write.parquet(f"{workdir}/ints")
    df = spark.read.parquet(f"{workdir}/ints")
    assert _rows(event_count(df, 0, 1 << 40, 10)) == [(0, 1), (10, 1), (2147483640, 1)]
    assert _rows(event_count(df, 1 << 33, 1 << 40, 10)) == []
    plan = time_range(df, 0, 20)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created,0)" in plan and "LessThan(created,20)" in plan


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(times=st.lists(st.one_of(st.none(), st.integers(-5000, 5000)), max_size=40),
       start=st.integers(-3000, 3000), span=st.integers(0, 6000),
       interval=st.one_of(st.integers(1, 700), st.floats(0.5, 700.0).map(lambda x: round(x, 3))))
def test_counts_equal_definition(spark, times, start, span, interval):
    end = start + span
    df = spark.createDataFrame([(t,) for t in times], SCHEMA)
    got = _rows(event_count(df, start, end, interval))
    expect = {}
    for t in times:
        if t is not None and start <= t < end:
            if isinstance(interval, int) or float(interval).is_integer():
                b = start + (t - start) // int(interval) * int(interval)
            else:
                b = int(start + int((t - start) / interval) * interval)
            expect[b] = expect.get(b, 0) + 1
    assert got == sorted(expect.items())


def test_zone_aware_timestamp_input(spark, workdir):
    import datetime as dt

    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0, 500000, tzinfo=dt.timezone.utc),),
            (dt.datetime(2024, 1, 1, 0, 59, 59, 999999, tzinfo=dt.timezone.utc),),
            (dt.datetime(2024, 1, 1, 1, 0, 0, 500000, tzinfo=dt.timezone.utc),)]
    schema = T.StructType([T.StructField("ts", T.TimestampType())])
    spark.createDataFrame(rows, schema).write.parquet(f"{workdir}/ltz")
    df = spark.read.parquet(f"{workdir}/ltz")
    start = 1704067200500
    out = event_count(df, start, start + 7200000, 3600000, time_col="ts")
    assert _rows(out) == [(start, 2), (start + 3600000, 1)]
    assert "GreaterThanOrEqual(ts" in out._jdf.queryExecution().executedPlan().toString()


def test_range_skips_row_groups_of_integer_times(spark, workdir):
    """Rows that leave the scan, against the table's rows, on a file of many row groups."""
    from quoteline.operators.event_count import time_range

    path = f"{workdir}/many-groups"
    spark.range(200_000).selectExpr("id AS created").coalesce(1).write.option("parquet.block.size", 65_536) \
        .option("parquet.page.row.count.limit", 2_000).parquet(path)
    found = time_range(spark.read.parquet(path), 1000, 2000)
    assert found.count() == 1000
    plan = found._jdf.queryExecution().executedPlan()
    assert "GreaterThanOrEqual(created,1000)" in plan.toString()
    found.collect()
    scan = found.select("created")
    scan.collect()
    leaves = scan._jdf.queryExecution().executedPlan().collectLeaves()
    rows = leaves.apply(0).metrics().apply("numOutputRows").value()
    assert rows < 100_000
