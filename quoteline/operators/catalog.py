"""Catalogue queries as DataFrame operators.

The catalogue is three tables: ``analyses`` (id, name, ...), ``datasets`` (id, name, module_id,
...) and ``lineage`` (left_fs_id, right_ds_id), one edge from a feature set to each parent.
They may come from the Parquet store (:mod:`quoteline.sources.registry`) or from any other
DataFrames with these columns.  Every operator is a join/aggregate plan; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Parent names in one array.
PAGE_SIZE = 1_000


class CatalogError(RuntimeError):
    """A catalogue rule is broken: unknown or duplicate name, missing module, missing input."""


def contains_match(col: Column, pattern: str) -> Column:
    """E5: case-insensitive contains-match; ``%`` and ``_`` in the pattern act as wildcards, a
    backslash stands for itself."""
    escaped = (pattern or "").replace("\\", "\\\\")
    return col.ilike(f"%{escaped}%")


def by_sorting(datasets: DataFrame) -> DataFrame:
    """Rows of the catalogue's datasets for a join that exchanges and sorts them.  Spark's estimate for a few columns
    of a Parquet table is a small part of what their rows take, so millions of names would pass for a broadcast and
    go through the driver."""
    return datasets.hint("merge")


def latest_state(log: DataFrame, key: str | Sequence[str], order: Sequence[str], dropped: Column,
                 keep: Sequence[str]) -> DataFrame:
    """The current row per key of an append-only log, or nothing if it was dropped.

    The latest row per key is found with one ``max`` over a struct led by the ``order``
    columns: a partial aggregate per map task, then one row per key after the shuffle, so a key
    holding a large share of the log costs no more than any other.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = F.struct(*[F.col(c) for c in keep], dropped.alias("_dropped"))
    latest = F.max(F.struct(*[F.col(c) for c in order], payload.alias("_row"))).alias("_latest")
    state = log.groupBy(*keys).agg(latest)
    return state.where(~F.col("_latest._row._dropped")).select(*keys, *[F.col(f"_latest._row.{c}").alias(c) for c in keep])


def search_modules(analyses: DataFrame, pattern: str = "") -> DataFrame:
    """Modules whose name contains ``pattern`` (all when empty)."""
    return analyses.where(contains_match(F.col("name"), pattern))


def parent_counts(lineage: DataFrame) -> DataFrame:
    """Number of parents per feature set (partial aggregate before the shuffle)."""
    return lineage.groupBy(F.col("left_fs_id").alias("id")).agg(F.count(F.lit(1)).alias("n_parents"))


def search_datasets(datasets: DataFrame, analyses: DataFrame, lineage: DataFrame, pattern: str = "") -> DataFrame:
    """C4 (+ J2, J3): datasets whose name contains ``pattern``, with the module that made them
    (null for imported datasets) and their number of parents."""
    hits = datasets.where(contains_match(F.col("name"), pattern))
    modules = analyses.select(F.col("id").alias("module_id"), F.col("name").alias("module_name"))
    # only the edges of matching datasets are counted (semi join before the grouping)
    hit_edges = lineage.join(hits.select(F.col("id").alias("left_fs_id")), "left_fs_id", "left_semi")
    return (
        hits.join(modules, "module_id", "left")
        .join(parent_counts(hit_edges), "id", "left")
        .select(
            "id", "name", "module_name",
            F.coalesce(F.col("n_parents"), F.lit(0).cast("long")).alias("n_parents"),
        )
    )


def dataset_listing(datasets: DataFrame, analyses: DataFrame, lineage: DataFrame, pattern: str = "") -> DataFrame:
    """C4 as the full listing: each matching dataset with its description and details and, for
    feature sets, the module name, the module parameters, the first :data:`PAGE_SIZE` parent names in order
    and the number of all parents (null for imported datasets); :func:`parent_pages` gives the others."""
    hits = datasets.where(contains_match(F.col("name"), pattern))
    modules = analyses.select(F.col("id").alias("module_id"), F.col("name").alias("module_name"))
    # only the edges of matching feature sets are aggregated (semi join before the grouping)
    hit_edges = lineage.join(by_sorting(hits.select(F.col("id").alias("left_fs_id"))), "left_fs_id", "left_semi")
    parents = dataset_parents(datasets, hit_edges).select("id", "parent_names", "n_parents")
    extra = [c for c in ("description", "details", "module_parameters") if c in datasets.columns]
    return (
        hits.join(modules, "module_id", "left")
        .join(parents, "id", "left")
        .select("id", "name", *extra, "module_name", "parent_names", "n_parents")
    )


def parent_edges(datasets: DataFrame, lineage: DataFrame) -> DataFrame:
    """J3 in long form: one row per (feature set, parent) with both names; no grouping, so it
    scales with the number of edges whatever their distribution."""
    names = datasets.select("id", "name")
    fs = names.withColumnRenamed("id", "left_fs_id")
    parent = names.withColumnRenamed("id", "right_ds_id").withColumnRenamed("name", "parent_name")
    return (
        lineage.select("left_fs_id", "right_ds_id")
        .join(fs, "left_fs_id")
        .join(parent, "right_ds_id")
        .select(F.col("left_fs_id").alias("id"), "name", F.col("right_ds_id").alias("parent_id"), "parent_name")
    )


def dataset_parents(datasets: DataFrame, lineage: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """J3 + A4: for each feature set, its parent names (sorted; the first ``page_size`` of them) and the
    number of all its parents.

    Sets made by a run have few parents (the inputs that the user named).  For others no array grows with them:
    the names are limited by rank, before the exchange too (each task hands on ``page_size`` names a set at most), and
    the number is counted apart.  :func:`parent_pages` gives all names.
    """
    names = datasets.select("id", "name")
    parents = lineage.join(by_sorting(names.selectExpr("id AS right_ds_id", "name AS parent_name")), "right_ds_id").select(
        F.col("left_fs_id").alias("id"), "parent_name")
    order = Window.partitionBy("id").orderBy("parent_name")
    first = (parents.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= page_size)
             .groupBy("id").agg(F.sort_array(F.collect_list("parent_name")).alias("parent_names")))
    counts = parents.groupBy("id").agg(F.count(F.lit(1)).alias("n_parents"))
    return by_sorting(names).join(first.join(counts, "id"), "id")


def parent_pages(datasets: DataFrame, lineage: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """A4 for sets of any number of parents: ``id``, ``page`` (from 0), ``parent_names`` (at most ``page_size``, in
    order over all pages of the set) and ``n_parents`` of the whole set.

    The rank of a parent is found in two steps, so that no task holds a set: the edges are ranged by (set,
    name) and written to the shared checkpoint folder; within a range they are numbered, and the counts of the
    ranges before (one row a set and range) give the offset.
    """
    if page_size < 1:
        raise ValueError("page_size must be positive")
    parents = parent_edges(datasets, lineage).select("id", "parent_id", "parent_name")
    n = int(datasets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the range of a row must not change between its two uses, so it is stored with it
    ranged = cut_lineage(parents.repartitionByRange(n, "id", "parent_name", "parent_id")
                         .withColumn("_range", F.spark_partition_id()))
    by_range = Window.partitionBy("id").orderBy("_range")
    offsets = ranged.groupBy("id", "_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "id", "_range", F.coalesce(F.sum("_n").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("id")).alias("n_parents"))
    within = Window.partitionBy("id", "_range").orderBy("parent_name", "parent_id")
    ranked = ranged.withColumn("_own", F.row_number().over(within)).join(offsets, ["id", "_range"])
    page = F.expr(f"(_before + _own - 1) DIV {int(page_size)}").alias("page")
    return ranked.groupBy("id", page).agg(F.sort_array(F.collect_list("parent_name")).alias("parent_names"),
                                          F.max("n_parents").alias("n_parents"))


def dataset_derived(datasets: DataFrame, lineage: DataFrame) -> DataFrame:
    """For each dataset with derived feature sets, how many derive from it."""
    derived = lineage.join(datasets.select(F.col("id").alias("left_fs_id")), "left_fs_id", "left_semi")
    counts = derived.groupBy(F.col("right_ds_id").alias("id")).agg(F.count(F.lit(1)).alias("n_derived"))
    return datasets.select("id", "name").join(counts, "id")


def requested_names(spark: SparkSession, names: Iterable[str] | DataFrame) -> DataFrame:
    """A one-column (``name``) DataFrame of requested names."""
    if isinstance(names, DataFrame):
        return names.select(F.col(names.columns[0]).cast("string").alias("name"))
    rows = [(str(n),) for n in names]
    schema = T.StructType([T.StructField("name", T.StringType(), False)])
    return spark.createDataFrame(rows, schema)


def missing_inputs(datasets: DataFrame, names: DataFrame) -> DataFrame:
    """The requested names (each once) that no dataset has."""
    return names.select("name").distinct().join(datasets.select("name"), "name", "left_anti")


def resolve_inputs(datasets: DataFrame, names: DataFrame, check: bool = True, unique: bool = False) -> DataFrame:
    """The dataset row for each requested name (``name``, ``id`` and any other columns).

    An unknown name is an error, not skipped.  The check runs inside the same single pass (a left
    join with a match marker; an unmatched name raises ``input dataset not found: <name>`` when
    the result is computed), so large requested sets cost one join, not two.  For a short list
    given by a user, :meth:`Catalog.lookup` reports every missing name at once instead.  Where a
    name occurs twice in ``datasets`` the row with the smallest ``(id, ...)`` wins;
    ``unique=True`` skips that step when names are known to be unique.
    """
    wanted = names.select("name").distinct()
    if check:
        marked = datasets.withColumn("_hit", F.lit(True))
        missing = F.raise_error(F.concat(F.lit("input dataset not found: "), F.col("name")))
        matched = (
            wanted.join(marked, "name", "left")
            .where(F.coalesce(F.col("_hit"), missing.cast("boolean")))
            .drop("_hit")
        )
    else:
        matched = datasets.join(wanted, "name", "left_semi")
    if unique:
        return matched
    cols = [c for c in datasets.columns if c != "name"]
    best = F.min(F.struct(*[F.col(c) for c in cols])).alias("_best")
    return matched.groupBy("name").agg(best).select("name", *[F.col(f"_best.{c}").alias(c) for c in cols])
