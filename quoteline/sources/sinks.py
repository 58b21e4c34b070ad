"""Sinks: save a DataFrame as a named dataset (K1) or as a feature set with lineage (K2).

Order of work: every check first (name free, module known, parents known), then the Parquet
write (``errorifexists``: an existing folder is never overwritten), then the catalogue rows, put if absent.
A failed check therefore leaves no orphan folder behind.  A run that dies between write and record does:
:func:`orphan_folders` lists such folders, and a save with ``over_orphan`` may write over one.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import base_name, dataset_name, identifier_of, join_path
from ..functions.timegrid import MS_PER_DAY, epoch_ms_sql
from ..operators.catalog import CatalogError, by_sorting
from .registry import Catalog, Known


class SinkError(CatalogError):
    """The data could not be written (bad target, existing folder, storage failure); nothing
    was recorded in the catalogue."""


def _write(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    try:
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    except Exception as exc:  # storage and analysis errors alike: report, record nothing
        raise SinkError(f"cannot write {path}: {str(exc) or type(exc).__name__}") from exc


def _bare(path: Column) -> Column:
    """A path without scheme and authority, and without doubled or trailing slashes: the same folder may be
    recorded as ``/a/b`` and listed as ``file:/a/b``."""
    plain = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.regexp_replace(F.regexp_replace(plain, "/+", "/"), "(.)/$", "$1")


def _under(recorded: DataFrame, folders: DataFrame) -> DataFrame:
    """The ``folder`` rows that lie in (or are) a recorded dataset's folder.  Every folder is joined with its
    own ancestors, so this is an equality join whatever the depth."""
    parts = F.split("folder", "/")
    steps = F.sequence(F.lit(1), F.size(parts))
    above = folders.select("folder", F.explode(F.transform(steps, lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("path"))
    return above.join(by_sorting(recorded), "path", "left_semi").select("folder").distinct()


def orphan_folders(catalog: Catalog, target_dir: str) -> DataFrame:
    """Folders under ``target_dir`` that hold data files but belong to no current dataset: ``folder``, ``files``
    and ``bytes``.  They are left by a run that died between writing and recording, or by a dropped
    dataset (its files stay).  The listing is Spark's own; paths are compared without scheme and authority."""
    spark = catalog.spark
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(target_dir)
                 .select(_bare(F.col("path")).alias("path"), "length"))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        files = spark.createDataFrame([], "path string, length long")
    folders = files.groupBy(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    recorded = catalog.datasets().select(_bare(F.col("filepath")).alias("path")).where("path <> ''")
    return folders.join(_under(recorded, folders.select("folder")), "folder", "left_anti")


def _mode(catalog: Catalog, path: str, over_orphan: bool) -> str:
    """How to write a new dataset's folder: over what lies there only if asked to, and if no current dataset
    lies in it, around it or is it."""
    if not over_orphan:
        return "errorifexists"
    here = catalog.spark.range(1).select(_bare(F.lit(path)).alias("folder"))
    recorded = catalog.datasets().select(_bare(F.col("filepath")).alias("path"))
    inside = recorded.where(F.startswith("path", F.concat(_bare(F.lit(path)), F.lit("/")))).select("path")
    if not (_under(recorded, here).isEmpty() and inside.isEmpty()):
        raise SinkError(f"cannot write {path}: a recorded dataset lies there")
    return "overwrite"


def save_dataset(catalog: Catalog, df: DataFrame, target_dir: str, table: str, source_path: str,
                 description: str = "", details: str = "", over_orphan: bool = False,
                 partition_by: Sequence[str] = ()) -> str:
    """K1: write ``df`` as ``<target_dir>/<identifier>/<identifier>_<TABLE>.parquet`` and record it.

    ``identifier`` is the word before the extension of ``source_path`` (P6); a path without one
    is an error.  With ``over_orphan`` a folder that a run which died has left there is
    overwritten.  Returns the dataset path.
    """
    if not target_dir:
        raise CatalogError("a target folder is required")
    identifier = identifier_of(source_path)
    name = dataset_name(identifier, table)
    path = join_path(target_dir, identifier, f"{name}.parquet")
    version = catalog.version("datasets")
    catalog.check_new_dataset(name)
    _write(df, path, _mode(catalog, path, over_orphan), partition_by)
    catalog.create_datasets([dict(name=name, filepath=path, schema=df.schema.json(), identifier=identifier,
                                  description=description, details=details)], checked=version)
    return path


def save_by_day(catalog: Catalog, df: DataFrame, target_dir: str, table: str, source_path: str, time_col: str,
                day_col: str = "day", description: str = "", details: str = "", over_orphan: bool = False) -> str:
    """K1 for tables that are read by time: :func:`save_dataset` with the UTC day of ``time_col`` (days since the
    epoch) as the partition column ``day_col``.  Reads that name the column (``day_col`` of ``time_range`` and ``event_count``)
    open the days of their range only, also where Spark cannot skip row groups (TIMESTAMP_NTZ).

    Rows are exchanged by day with Spark's REBALANCE, so a day is a few files however many tasks read the input,
    and a day with a large share of the rows is split; within a file rows are in time order.  A null time has a null day.
    """
    if day_col in df.columns:
        raise SinkError(f"the table has a column {day_col!r} already")
    ms = epoch_ms_sql(time_col, df.schema[time_col].dataType)
    dated = df.withColumn(day_col, F.expr(f"CAST(({ms} - pmod({ms}, {MS_PER_DAY}L)) DIV {MS_PER_DAY}L AS INT)"))
    rows = dated.hint("rebalance", day_col).sortWithinPartitions(day_col, time_col)
    return save_dataset(catalog, rows, target_dir, table, source_path, description, details, over_orphan, [day_col])


def parent_dataset_names(inputs: Sequence[str]) -> list[str]:
    """Parent names of a feature set: input dataset names as given, or the base name of an
    input given as a path (E6)."""
    return [base_name(i) if "/" in i else i for i in inputs]


def save_features(catalog: Catalog, df: DataFrame, target_dir: str, name: str, module_name: str,
                  module_parameters: Mapping | str, inputs: Sequence[str], description: str = "",
                  details: str = "", known: Known | None = None, over_orphan: bool = False) -> str:
    """K2: write ``df`` as ``<target_dir>/<name>.parquet``, record it as a feature set of
    ``module_name`` with its parameters, and one lineage edge per parent input.

    The module and every parent must exist and the name must be new, all checked before the
    write with one catalogue query (``known`` passes the rows of an earlier one on).  With ``over_orphan``
    a folder that a run which died has left at that path is overwritten.  Returns the feature-set path.
    """
    if not target_dir:
        raise CatalogError("a target folder is required")
    parents = parent_dataset_names(inputs)
    if known is None:
        known = catalog.known([name, *parents], [module_name])
    module = known.module(module_name)
    known.require_free(name)
    parent_ids = [r["id"] for r in known.inputs(parents).values()]
    path = join_path(target_dir, f"{name}.parquet")
    _write(df, path, _mode(catalog, path, over_orphan))
    params = module_parameters if isinstance(module_parameters, str) else json.dumps(module_parameters, sort_keys=True)
    with catalog.writing():
        fs_id = catalog.create_datasets([dict(name=name, filepath=path, schema=df.schema.json(), description=description,
                                              details=details, module_id=module["id"], module_parameters=params)],
                                        checked=known.version)[0]
        catalog.create_relation(fs_id, parent_ids)
    return path
