"""Run an analysis module by name on named datasets, optionally saving a feature set.

Everything happens in the caller's session: the module and the inputs are looked up in the
catalogue, the inputs are opened as lazy DataFrames, the module function composes its plan,
and the caller runs one action (or :func:`run_analysis` writes the feature set).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.paths import join_path
from ..operators.catalog import CatalogError
from ..sources.registry import Catalog
from ..sources.sinks import parent_dataset_names, save_features
from .modules import BUILTIN_MODULES

Module = Callable[[SparkSession, Mapping[str, DataFrame], Mapping], DataFrame]


def load_entrypoint(spec: str) -> Module:
    """Import ``package.module:function``."""
    if ":" not in spec:
        raise CatalogError(f"entry point {spec!r} is not of the form package.module:function")
    mod, _, fn = spec.partition(":")
    try:
        return getattr(importlib.import_module(mod), fn)
    except (ImportError, AttributeError) as exc:
        raise CatalogError(f"cannot load entry point {spec!r}: {exc}") from exc


def register_builtin_modules(catalog: Catalog) -> None:
    """Record the built-in modules that are not yet in the catalogue."""
    catalog.register_modules(
        [dict(name=n, entrypoint=spec, description=f"built-in module {n}") for n, spec in BUILTIN_MODULES.items()],
        skip_existing=True,
    )


def open_inputs(spark: SparkSession, catalog: Catalog, inputs: Sequence[str]) -> dict[str, DataFrame]:
    """J5 + S1: the named datasets as lazy DataFrames, in the order given.

    The list of names is the user's (driver-side, short); their catalogue rows are fetched in
    one query.  Every unknown name is reported.
    """
    return _open(spark, catalog.lookup(inputs), inputs)


def _open(spark: SparkSession, rows: Mapping, inputs: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.format(rows[n]["fileformat"] or "parquet").load(rows[n]["filepath"]) for n in inputs}


def sql_over(spark: SparkSession, frames: Mapping[str, DataFrame], text: str, args: Mapping | None = None) -> DataFrame:
    """S2 + F4: run ``text`` over the DataFrames, each written as ``{key}`` in the text, with named
    parameters (``:name``) bound by Spark, never spliced in.  No view of the session is touched."""
    return spark.sql(text, args=dict(args or {}), **frames)


def test_analysis(spark: SparkSession, module: Module | str, params: Mapping,
                  inputs: Mapping[str, DataFrame] | Sequence[str], catalog: Catalog | None = None) -> DataFrame:
    """K3: run a module function (or entry point) without registering or saving anything.

    ``inputs`` are DataFrames by name, or dataset names resolved through ``catalog``.
    """
    if module is None or params is None or not inputs:
        raise CatalogError("a dry run needs a module, its parameters and at least one input")
    if not isinstance(inputs, Mapping):
        if catalog is None:
            raise CatalogError("dataset names as inputs need a catalogue")
        inputs = open_inputs(spark, catalog, list(inputs))
    fn = load_entrypoint(module) if isinstance(module, str) else module
    return fn(spark, dict(inputs), dict(params))


def run_analysis(spark: SparkSession, catalog: Catalog, module_name: str | None = None, params: Mapping | None = None,
                 inputs: Sequence[str] | None = None, save: Mapping | None = None) -> DataFrame:
    """Run the module ``module_name`` on the datasets named in ``inputs``.

    With ``save=None`` the result is returned unsaved (a dry run).  With ``save`` =
    ``{"name"[, "target_dir", "description", "details"]}`` the result is written as a feature
    set with its module, parameters and parent datasets (by default under
    ``<catalogue root>/features``), and the saved data is returned.
    """
    if not module_name or params is None or not inputs:
        raise CatalogError("a run needs a module name, its parameters and at least one input dataset")
    new_name = (save or {}).get("name")
    # one catalogue query for the module, the inputs, the parents and the new name
    known = catalog.known([*inputs, *parent_dataset_names(inputs), new_name or ""], [module_name])
    module = known.module(module_name)
    frames = _open(spark, known.inputs(inputs), inputs)
    result = test_analysis(spark, module["entrypoint"], params, frames)
    if save is None:
        return result
    if not new_name:
        raise CatalogError("saving a feature set needs a name")
    target_dir = save.get("target_dir") or join_path(catalog.root, "features")
    path = save_features(catalog, result, target_dir, save["name"], module_name, dict(params), list(inputs),
                         save.get("description", ""), save.get("details", ""), known=known)
    return spark.read.parquet(path)
