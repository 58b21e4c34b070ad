"""Import of order-book sources into typed Parquet datasets.

A source is a folder ``.../<identifier>.<ext>`` holding one sub-folder per table (``ORDERS``,
``CANCELS``, ``TRADES``), each with one or more per-day files (flat, or in ``day=...``
partition folders).  Spark lists the files and splits them into tasks; the fixed schema is
applied by ``conform``.  Each (source, table) becomes one dataset ``<identifier>_<TABLE>``.

An import is all or nothing.  Every name is derived and checked, every (source, table) must have files, and
the tables' columns are checked, before the first write.  Data goes to a folder of its own for each
import (``<target>/import-<id>``) and all datasets are recorded in one append after the last
write, so what a failed attempt has written is never read, and a retry starts anew.

*Many sources.*  In the partitioned layout the number of jobs depends on the tables, not on the sources: one
listing of all files, compared with the expected (source, table) pairs by an anti-join; for each table one
distributed read of the footers; one join of the names with the catalogue; one write a table.  A column that
single files lack is found by the write itself (a missing column is read as a value that no file can hold).

*Files.*  Rows are exchanged by source before they are written, so a source is not scattered over all tasks: by default
with Spark's REBALANCE (small sources share a task, a large one is split; about ``bytes / advisory partition
size`` files a source), or over a given number of ``partitions``, a source getting as many of them as its share of the rows;
over more where a task would get above :data:`TASK_ROWS` rows, as its sort grows with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import BOOK_TABLES, dataset_name, identifier_col, identifier_of, join_path
from ..operators.catalog import CatalogError
from .registry import Catalog
from .schemas import TABLE_SCHEMAS, TIME_COLUMNS, conform
from .sinks import SinkError

# Formats without a stored schema: read with the table's columns given up front.
_TEXT_FORMATS = {"csv", "json"}
_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
# What a column that a Parquet file lacks is read as: an int column cannot hold it, and as epoch
# milliseconds it names no time.
_ABSENT = -(1 << 63)
# Rows that one task of a write is dealt where ``partitions`` is given: more rows take more tasks.
TASK_ROWS = 1_000_000


def _table_name(table: str) -> str:
    name = table.upper()
    if name not in TABLE_SCHEMAS:
        raise CatalogError(f"unknown table {table!r}; expected one of {sorted(TABLE_SCHEMAS)}")
    return name


def _reader(spark: SparkSession, table: str, fmt: str, options: Mapping[str, str] | None):
    # Per-day files may sit in per-day folders of any name, so the listing is recursive.
    opts = {"recursiveFileLookup": "true", **dict(options or {})}
    if fmt not in _TEXT_FORMATS:
        return spark.read.format(fmt).options(**opts)
    # Text: no inference pass, and a value that is no number fails the import instead of becoming
    # null.  Columns are read as bigint, so that the cast to int reports an overflow.
    wide = T.StructType([T.StructField(f.name, T.LongType(), True) for f in TABLE_SCHEMAS[table].fields])
    return spark.read.format(fmt).options(**{"mode": "FAILFAST", **opts}).schema(wide)


def read_book_table(spark: SparkSession, source: str, table: str, fmt: str = "parquet",
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """All per-day files of one table of one source, with the table's fixed schema.

    Self-describing formats are read as stored and then cast.  In text formats a malformed value or
    an int overflow raises when the data is read (``options={"mode": ...}`` overrides the first).
    """
    table = _table_name(table)
    return conform(_reader(spark, table, fmt, options).load(join_path(source, table)), TABLE_SCHEMAS[table])


def _stored_schema(spark: SparkSession, sources: Sequence[str], table: str, fmt: str, options) -> T.StructType | None:
    """The columns that the files of one table have, over all sources; the footers are read by the executors.
    None where the sources store a column in different types."""
    reader = _reader(spark, table, fmt, options).option("mergeSchema", "true")
    try:
        return reader.load([join_path(src, table) for src in sources]).schema
    except Exception as exc:
        if "MERGE" in str(exc).upper():
            return None
        raise


def wide_schema(stored: T.StructType | None, table: str) -> T.StructType:
    """The table's columns as stored; integers as bigint, which :data:`_ABSENT` stands in for where a file
    lacks the column."""
    have = {f.name.lower(): f for f in stored.fields} if stored is not None else {}
    mark = {k: f"{_ABSENT}L" for k in ("EXISTS_DEFAULT", "CURRENT_DEFAULT")}
    fields = []
    for f in TABLE_SCHEMAS[table].fields:
        found = have.get(f.name.lower(), f)
        whole = isinstance(found.dataType, _INTEGRAL)
        fields.append(T.StructField(found.name, T.LongType() if whole else found.dataType, True, mark if whole else None))
    return T.StructType(fields)


def require_stored(raw: DataFrame, wide: T.StructType) -> DataFrame:
    """``raw``, read from Parquet files with the schema ``wide``, failing where a file lacks one of its columns."""
    whole = [f.name for f in wide.fields if isinstance(f.dataType, T.LongType)]
    return raw.withColumns({
        c: F.when(F.col(c) == F.lit(_ABSENT), F.raise_error(
            F.concat(F.lit(f"missing columns ['{c}'] in "), F.input_file_name())).cast("long")).otherwise(F.col(c))
        for c in whole})


def read_book_tables(spark: SparkSession, sources: Sequence[str], table: str, fmt: str = "parquet",
                     options: Mapping[str, str] | None = None) -> DataFrame:
    """One table of many sources in one scan, with an ``identifier`` column taken from each
    row's file path (the source folder's word before its extension).  Parquet files may store integers in
    different widths; one that lacks a column of the table fails the job when it is read."""
    table = _table_name(table)
    reader = _reader(spark, table, fmt, options)
    path = F.input_file_name()
    if fmt == "parquet":
        stored = _stored_schema(spark, sources, table, fmt, options)
        if stored is not None:
            conform(spark.createDataFrame([], stored), TABLE_SCHEMAS[table])  # a column that every file lacks
        wide = wide_schema(stored, table)
        raw = reader.schema(wide).load([join_path(src, table) for src in sources])
        raw = require_stored(raw, wide)
    else:
        raw = reader.load([join_path(src, table) for src in sources])
    source_dir = F.regexp_extract(path, rf"^(.*)/{table}/", 1)
    return conform(raw.withColumn("identifier", identifier_col(source_dir)),
                   T.StructType([*TABLE_SCHEMAS[table].fields, T.StructField("identifier", T.StringType())]))


def _check_files(spark: SparkSession, ident_of: Mapping[str, str], tables: Sequence[str]) -> None:
    """Every (source, table) must have a file: one listing of all sources, anti-joined with what is expected."""
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(ident_of)).select("path")
    except Exception as exc:
        raise CatalogError(f"cannot read the sources: {exc}") from exc
    parts = F.regexp_extract("path", rf"^(.*)/({'|'.join(tables)})/", 1), F.regexp_extract("path", rf"^(.*)/({'|'.join(tables)})/", 2)
    found = listed.select(identifier_col(parts[0]).alias("identifier"), parts[1].alias("table")).distinct()
    sources = spark.createDataFrame([(s, i) for s, i in ident_of.items()], "source string, identifier string")
    expected = sources.select("source", "identifier", F.explode(F.array(*map(F.lit, tables))).alias("table"))
    absent = expected.join(found, ["identifier", "table"], "left_anti").select(F.concat_ws("/", "source", "table").alias("folder"))
    bad = [r["folder"] for r in absent.orderBy("folder").limit(21).collect()]
    if bad:
        raise CatalogError(f"cannot read {'; '.join(bad[:20])}{' and others' if len(bad) > 20 else ''}: no files")


def _checked(spark: SparkSession, sources: Sequence[str], tables: Sequence[str], fmt: str, options) -> None:
    """Open every (source, table), for the layout that writes them one by one: a missing folder or column is
    reported before anything is written.  Only listings and footers are read, several at a time."""
    def open_one(pair):
        source, table = pair
        try:
            read_book_table(spark, source, table, fmt, options)
        except Exception as exc:
            return f"{join_path(source, table)}: {exc}"

    with ThreadPoolExecutor(8) as pool:
        bad = [e for e in pool.map(open_one, [(s, t) for s in sources for t in tables]) if e]
    if bad:
        raise CatalogError("cannot read " + "; ".join(bad))


def _write(df: DataFrame, folder: str, by_identifier: bool) -> None:
    writer = df.write.mode("errorifexists")
    try:
        (writer.partitionBy("identifier") if by_identifier else writer).parquet(folder)
    except Exception as exc:
        raise SinkError(f"cannot write {folder}: {exc}") from exc


def import_dataset(spark: SparkSession, catalog: Catalog, paths: Sequence[str], target_dir: str | None = None,
                   description: str = "", details: str = "", fmt: str = "parquet",
                   tables: Sequence[str] = BOOK_TABLES, partitions: int | None = None,
                   options: Mapping[str, str] | None = None, layout: str = "partitioned") -> dict[str, str]:
    """Import every table of every source; returns ``{dataset name: path}``.

    ``layout="partitioned"`` runs one job per table for all sources together and writes
    ``<target>/import-<id>/<TABLE>/identifier=<identifier>``, each folder being one dataset (the sources without
    a row in a table share ``<TABLE>-empty``).  ``layout="by_source"`` writes
    ``<target>/import-<id>/<identifier>/<identifier>_<TABLE>.parquet``, one job per (source, table), for few sources.
    ``partitions`` is the number of tasks that write a table (in the partitioned layout more, if its rows are more than
    :data:`TASK_ROWS` for each): a source with a third of the rows is written by a
    third of them, a small one by one; by default Spark decides by bytes (see the module's text).
    Without ``target_dir`` the data goes under ``<catalogue root>/files``.  Every failure is a
    :class:`CatalogError`, after which nothing is recorded.
    """
    if layout not in ("partitioned", "by_source"):
        raise ValueError(f"unknown layout {layout!r}")
    if not paths:
        raise CatalogError("an import needs at least one source path")
    sources = [p.rstrip("/") for p in paths]
    names = list(dict.fromkeys(_table_name(t) for t in tables))
    ident_of = {s: identifier_of(s) for s in sources}
    if len(set(ident_of.values())) != len(paths):
        raise CatalogError("two sources share an identifier")
    entries = [(s, t, dataset_name(ident_of[s], t)) for t in names for s in sources]
    version = catalog.version("datasets")
    catalog.check_new_datasets([name for _, _, name in entries])
    root = join_path(target_dir or join_path(catalog.root, "files"), f"import-{uuid.uuid4().hex}")

    def ordered(df: DataFrame, table: str, *leading: str) -> DataFrame:
        # a local sort (no shuffle): the row groups' time ranges stay narrow, so range predicates skip most
        return df.sortWithinPartitions(*leading, TIME_COLUMNS[table])

    out = {}
    if layout == "partitioned":
        _check_files(spark, ident_of, names)
        frames = {}
        for table in names:
            try:
                frames[table] = read_book_tables(spark, sources, table, fmt, options)
            except Exception as exc:
                raise CatalogError(f"cannot read {table}: {exc}") from exc
        for table, rows in frames.items():
            folder = join_path(root, table)
            dealt = deal_by_source(rows, int(partitions)) if partitions else rows.hint("rebalance", "identifier")
            _write(ordered(dealt, table, "identifier"), folder, True)
            out |= _written(spark, folder, table, list(ident_of.values()))
    else:
        _checked(spark, sources, names, fmt, options)
        for source, table, name in entries:
            out[name] = join_path(root, ident_of[source], f"{name}.parquet")
            rows = read_book_table(spark, source, table, fmt, options)
            _write(ordered(rows.repartition(int(partitions)) if partitions else rows, table), out[name], False)
    catalog.create_datasets([
        dict(name=name, filepath=out[name], schema=TABLE_SCHEMAS[table].json(), identifier=ident_of[source],
             description=description, details=details)
        for source, table, name in entries
    ], checked=version)
    return out


def deal_by_source(rows: DataFrame, partitions: int) -> DataFrame:
    """``rows`` over ``partitions`` tasks, or one for each :data:`TASK_ROWS` rows if that is more, by their
    ``identifier``: a source of ``n`` rows goes to ``ceil(n / (all / partitions))`` different tasks, row by row in turn.
    Fewer sources than tasks get more than one of them, so what is broadcast is bounded by that number."""
    counts = rows.groupBy("identifier").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    partitions = max(partitions, -(-total // TASK_ROWS))
    share = max(1, -(-total // partitions))
    large = counts.selectExpr("identifier", f"CAST(ceil(n / {share}) AS INT) AS _tasks").where("_tasks > 1")
    # numbered within each scan task: the same rows get the same task if the scan is repeated
    numbered = rows.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(large), "identifier", "left")
    task = f"CAST(pmod(xxhash64(identifier) + pmod(_row, coalesce(_tasks, 1)), {partitions}) AS INT)"
    return numbered.withColumn("_task", F.expr(task)).repartitionById(partitions, "_task").select(*rows.columns)


def _written(spark: SparkSession, folder: str, table: str, identifiers: Sequence[str]) -> dict[str, str]:
    """Dataset name to folder, from one listing of what the write has made.  Sources without rows in the table have no
    partition folder and share an empty one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    made = {status.getPath().getName() for status in listed}
    empty = f"{folder}-empty"
    if any(f"identifier={i}" not in made for i in identifiers):
        spark.createDataFrame([], TABLE_SCHEMAS[table]).write.parquet(empty)
    return {dataset_name(i, table): f"{folder}/identifier={i}" if f"identifier={i}" in made else empty for i in identifiers}
