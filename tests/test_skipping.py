"""What a time range reads: rows that leave the scan, against the rows of the table."""

import pytest

from quoteline.operators.event_count import event_count, time_range
from quoteline.operators.ordering import with_positions
from quoteline.plans.runner import register_builtin_modules, run_analysis
from quoteline.sources.registry import Catalog
from quoteline.sources.sinks import SinkError, save_by_day

DAY = 86_400_000
ROWS = 40_000


@pytest.fixture()
def one_plan(spark):
    """Without adaptive plans the scan's counters are those of the plan that was asked."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _scanned(df):
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return rows, sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def _events(spark, kind):
    # 40 days, 1,000 rows each, in no order; one row without a time
    ms = f"CAST(pmod(id * 7919, {ROWS}) * {DAY // 1000} AS BIGINT)"
    column = {"bigint": ms, "timestamp": f"timestamp_millis({ms})",
              "timestamp_ntz": f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {ms} / 1000)"}[kind]
    return spark.range(ROWS).selectExpr("id", f"IF(id = 17, NULL, {column}) AS t")


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "timestamp_ntz"])
def test_days_out_of_range_are_not_read(spark, workdir, one_plan, kind):
    catalog = Catalog(spark, f"{workdir}/catalog")
    register_builtin_modules(catalog)
    path = save_by_day(catalog, _events(spark, kind), f"{workdir}/files", "events", "/in/log.src", "t")
    saved = spark.read.parquet(path)
    assert saved.count() == ROWS and saved.where("day IS NULL").count() == 1
    start, end = 10 * DAY + 5, 12 * DAY
    want = sorted(map(tuple, event_count(_events(spark, kind), start, end, 3_600_000, time_col="t").collect()))
    got, read = _scanned(event_count(saved, start, end, 3_600_000, time_col="t", day_col="day"))
    assert sorted(map(tuple, got)) == want and len(want) == 48
    assert read <= 2 * ROWS // 40  # two days of forty
    params = {"start_time": start, "end_time": end, "interval": 3_600_000, "time_column": "t", "day_column": "day"}
    assert sorted(map(tuple, run_analysis(spark, catalog, "EventCount", params, ["log_EVENTS"]).collect())) == want
    # the ends of a range: a day that is touched by one millisecond, and none
    for start, end in ((11 * DAY - 1, 11 * DAY + 1), (-5, 1), (3 * DAY, 3 * DAY), (-DAY, 0)):
        got = time_range(saved, start, end, "t", "day")
        assert sorted(r["id"] for r in got.collect()) == sorted(
            r["id"] for r in time_range(_events(spark, kind), start, end, "t").collect())


def test_row_groups_out_of_range_are_not_read(spark, workdir, one_plan):
    """Imported tables hold integers in time order: a file of many row groups is read in part."""
    rows = _events(spark, "bigint").withColumnRenamed("t", "created")
    rows.repartition(1).sortWithinPartitions("created").write.option("parquet.block.size", 16 * 1024).option(
        "parquet.page.size", 1024).option("parquet.block.size.row.check.min", 100).parquet(f"{workdir}/book")
    got, read = _scanned(event_count(spark.read.parquet(f"{workdir}/book"), 10 * DAY, 12 * DAY, DAY))
    assert [r["count"] for r in got] == [1000, 1000] and read < ROWS / 4


def test_a_day_column_is_not_overwritten(spark, workdir):
    with pytest.raises(SinkError, match="has a column"):
        save_by_day(Catalog(spark, f"{workdir}/c"), spark.range(1).selectExpr("id AS t", "1 AS day"), f"{workdir}/f", "x", "/a/b.c", "t")


@pytest.mark.parametrize("partitions", [1, 7])
def test_positions_follow_the_order(spark, partitions):
    df = spark.range(5_000).repartition(partitions).orderBy("id", ascending=False)
    got = with_positions(df)
    assert got.columns == ["id", "position"]
    assert {(r["id"], r["position"]) for r in got.collect()} == {(4_999 - i, i + 1) for i in range(5_000)}
    assert with_positions(df.where("id < 0")).count() == 0
