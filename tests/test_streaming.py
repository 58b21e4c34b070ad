import pytest

from quoteline.sources.schemas import ORDERS_SCHEMA
from quoteline.sources.sinks import SinkError
from quoteline.streaming.ingest import ingest_table

ROW = (1, 1, 1, 1000, 1250, 66, 10, 5, 0, None, None, 1)


def test_incremental_import_reads_each_file_once(spark, workdir):
    src, out, ckpt = f"{workdir}/AB00.h5", f"{workdir}/AB00_ORDERS.parquet", f"{workdir}/ckpt"
    spark.createDataFrame([ROW], ORDERS_SCHEMA).write.parquet(f"{src}/ORDERS/day1")
    ingest_table(spark, src, "orders", out, checkpoint=ckpt).awaitTermination(120)
    assert spark.read.parquet(out).count() == 1
    # a new day arrives; the restarted query picks up only the new file
    spark.createDataFrame([ROW, ROW], ORDERS_SCHEMA).write.parquet(f"{src}/ORDERS/day2")
    ingest_table(spark, src, "orders", out, checkpoint=ckpt).awaitTermination(120)
    back = spark.read.parquet(out).drop("batch")
    assert back.count() == 3
    assert back.schema == ORDERS_SCHEMA


def test_many_sources_by_identifier(spark, workdir):
    out, ckpt = f"{workdir}/ORDERS", f"{workdir}/ckpt-many"
    spark.createDataFrame([ROW], ORDERS_SCHEMA).write.parquet(f"{workdir}/in/AB00.h5/ORDERS/day1")
    spark.createDataFrame([ROW, ROW], ORDERS_SCHEMA).write.parquet(f"{workdir}/in/CD01.h5/ORDERS/day1")
    for _ in range(2):
        ingest_table(spark, f"{workdir}/in/*.h5", "orders", out, checkpoint=ckpt, by_identifier=True).awaitTermination(120)
        counts = {r["identifier"]: r["count"] for r in spark.read.parquet(out).groupBy("identifier").count().collect()}
        spark.createDataFrame([ROW], ORDERS_SCHEMA).write.mode("append").parquet(f"{workdir}/in/AB00.h5/ORDERS/day2")
    assert counts == {"AB00": 2, "CD01": 2}


def test_ingest_refuses_a_folder_with_other_data(spark, workdir):
    spark.createDataFrame([ROW], ORDERS_SCHEMA).write.parquet(f"{workdir}/files/identifier=AB00")
    spark.createDataFrame([ROW], ORDERS_SCHEMA).write.parquet(f"{workdir}/AB00.h5/ORDERS/day1")
    with pytest.raises(SinkError, match="identifier=AB00"):
        ingest_table(spark, f"{workdir}/AB00.h5", "orders", f"{workdir}/files")


def test_file_without_a_column_stops_the_ingest(spark, workdir):
    spark.createDataFrame([ROW], ORDERS_SCHEMA).drop("price").write.parquet(f"{workdir}/AB00.h5/ORDERS/day1")
    query = ingest_table(spark, f"{workdir}/AB00.h5", "orders", f"{workdir}/out")
    with pytest.raises(Exception, match="missing columns"):
        query.awaitTermination(120)


def test_one_lacking_file_among_many(spark, workdir):
    """The files of a batch are not opened one by one on the driver; one that lacks a column is still found."""
    rows = spark.range(40).selectExpr("CAST(id AS INT) AS id", *(
        f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in ORDERS_SCHEMA.fields[1:]))
    rows.repartition(40).write.parquet(f"{workdir}/AB00.h5/ORDERS/day1")
    tracker = spark.sparkContext.statusTracker()
    query = ingest_table(spark, f"{workdir}/AB00.h5", "orders", f"{workdir}/out", checkpoint=f"{workdir}/ckpt")
    query.awaitTermination(120)
    assert len(tracker.getJobIdsForGroup(str(query.runId))) < 10
    assert sorted(r["id"] for r in spark.read.parquet(f"{workdir}/out").collect()) == list(range(40))
    spark.createDataFrame([ROW], ORDERS_SCHEMA).drop("created").write.parquet(f"{workdir}/AB00.h5/ORDERS/day2")
    query = ingest_table(spark, f"{workdir}/AB00.h5", "orders", f"{workdir}/out", checkpoint=f"{workdir}/ckpt")
    with pytest.raises(Exception, match=r"missing columns \['created'\]"):
        query.awaitTermination(120)
    assert spark.read.parquet(f"{workdir}/out").count() == 40
