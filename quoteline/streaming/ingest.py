"""Incremental import: new per-day files of one table become rows of a typed Parquet dataset.

The batch import (:mod:`quoteline.sources.importing`) reads a whole source once.  When per-day
files keep arriving, the same conform step runs as a Structured Streaming query over the
table's folder: the file source remembers which files it has read in the checkpoint.  Each micro-batch
is written to a folder of its own, ``<target>/batch=<number>``, which a repeated batch overwrites, so
every file is imported exactly once and the target is an ordinary Parquet dataset (with the batch
number as a partition column).  The target must be new or made by this query: a folder with other data
is refused.  ``available_now=True`` processes what is there and stops (a scheduled batch); otherwise
the query keeps running and picks up new files every ``every``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.paths import identifier_col, join_path
from ..session import scratch_path
from ..sources.importing import require_stored, wide_schema
from ..sources.schemas import TABLE_SCHEMAS, conform
from ..sources.sinks import SinkError


def _refuse_other_data(spark: SparkSession, target: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(folder):
        other = [n for n in (s.getPath().getName() for s in fs.listStatus(folder))
                 if not n.startswith(("batch=", "_", "."))]
        if other:
            raise SinkError(f"{target} holds data of another kind ({other[0]}); the ingest needs a folder of its own")


def ingest_table(spark: SparkSession, source: str, table: str, target_path: str, checkpoint: str | None = None,
                 fmt: str = "parquet", available_now: bool = True, every: str = "1 minute",
                 max_files_per_trigger: int | None = None, by_identifier: bool = False) -> StreamingQuery:
    """Start the incremental import of ``<source>/<TABLE>`` into ``target_path``.

    ``source`` may be a glob over many sources (``/incoming/*.h5``); with ``by_identifier`` each
    row gets its source's identifier and every batch is partitioned by it, so one query serves
    every source.  A file without one of the table's columns stops the query: in Parquet the task that reads
    it reports that, so a batch of many files needs no pass over them before; files of other self-describing formats
    are opened one by one first.  Parquet files may store integers in different widths.
    ``checkpoint`` must be a shared folder; by default a new folder under the session's
    ``spark.checkpoint.dir``.
    """
    table = table.upper()
    schema = TABLE_SCHEMAS[table]
    _refuse_other_data(spark, target_path)
    # Per-day files may sit in per-day folders of any name, so the listing is recursive.
    wide = wide_schema(None, table) if fmt == "parquet" else None
    reader = spark.readStream.schema(wide or schema).format(fmt).option("recursiveFileLookup", "true")
    if fmt in ("csv", "json"):
        reader = reader.option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    raw = reader.load(join_path(source, table))
    typed = conform(require_stored(raw, wide) if wide else raw, schema)
    if by_identifier:
        source_dir = F.regexp_extract(F.input_file_name(), rf"^(.*)/{table}/", 1)
        typed = typed.withColumn("identifier", identifier_col(source_dir))

    one_by_one = fmt not in ("parquet", "csv", "json")
    if one_by_one:
        typed = typed.withColumn("_file", F.input_file_name())

    def save(batch: DataFrame, number: int) -> None:
        if one_by_one:  # the stream's schema is given, so each file's own one is checked here
            for row in batch.select("_file").distinct().collect():  # the files of one micro-batch
                conform(batch.sparkSession.read.format(fmt).load(row["_file"]), schema)
            batch = batch.drop("_file")
        writer = batch.write.mode("overwrite")
        if by_identifier:
            writer = writer.partitionBy("identifier")
        writer.parquet(f"{target_path.rstrip('/')}/batch={number}")

    query = typed.writeStream.foreachBatch(save).option(
        "checkpointLocation", checkpoint or scratch_path(spark, f"ingest-{table.lower()}"))
    query = query.trigger(availableNow=True) if available_now else query.trigger(processingTime=every)
    return query.start()
