"""The catalogue as three append-only Parquet tables under one shared folder.

``analyses`` (modules), ``datasets`` (imported datasets and feature sets) and ``lineage`` (one
edge from a feature set to each parent).  Every change appends rows; a drop appends a tombstone,
and the current state is the latest row per name (:func:`latest_state`), so no file is ever
rewritten in place.  Checks run before any data is written, so a failed check leaves nothing behind.

*Several writers.*  A change is made under the catalogue's lock, a file that is created without
overwriting.  What another writer has appended since a name was checked shows in the listing of the log;
then the name is checked again before the row is appended, so a name is recorded once (put if absent).
The file system must create a file exclusively (HDFS, local and most object stores do).

*Long logs.*  :meth:`Catalog.snapshot` writes the current state next to the log and starts a new log.  From then
on the state is the snapshot merged with the new log, so a read no longer grows with the catalogue's history.

The store holds metadata only, a handful of rows per dataset; the data itself stays in the datasets'
own Parquet folders.
"""

from __future__ import annotations

import contextlib
import getpass
import json
import math
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import join_path
from ..operators.catalog import (
    CatalogError,
    by_sorting,
    contains_match,
    dataset_listing,
    latest_state,
    requested_names,
    resolve_inputs,
)

_S, _TS, _L = T.StringType(), T.TimestampType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The columns of the three catalogue tables (``op`` and ``seq`` are the log's own).
ANALYSES_SCHEMA = _schema(
    ("id", _S), ("name", _S), ("description", _S), ("details", _S), ("filepath", _S), ("entrypoint", _S),
    ("created", _TS), ("user", _S), ("parameters", _S), ("inputs", _S), ("outputs", _S), ("op", _S), ("seq", _L),
)
DATASETS_SCHEMA = _schema(
    ("id", _S), ("name", _S), ("fileformat", _S), ("identifier", _S), ("description", _S), ("details", _S),
    ("filepath", _S), ("created", _TS), ("user", _S), ("module_id", _S), ("module_parameters", _S),
    ("schema", _S), ("op", _S), ("seq", _L),
)
LINEAGE_SCHEMA = _schema(("left_fs_id", _S), ("right_ds_id", _S), ("seq", _L))

SCHEMAS = {"analyses": ANALYSES_SCHEMA, "datasets": DATASETS_SCHEMA, "lineage": LINEAGE_SCHEMA}

#: File in the catalogue's folder that exists while a writer changes it.
LOCK = "_lock"


def _user() -> str:
    try:
        return getpass.getuser()
    except Exception:  # no login name in some containers
        return "unknown"


class Catalog:
    """Catalogue store rooted at ``root`` (a shared file-system folder)."""

    def __init__(self, spark: SparkSession, root: str, lock_wait: float = 60.0):
        self.spark = spark
        self.root = root.rstrip("/")
        self.lock_wait = lock_wait
        self._holds = False

    # -- raw logs -------------------------------------------------------------------------------
    @staticmethod
    def _log_parts(table: str, generation: int) -> list[str]:
        return [f"log-{generation}", table] if generation else [table]

    def path(self, table: str, generation: int = 0) -> str:
        """Folder of a table's log; every snapshot starts a new one."""
        return join_path(self.root, *self._log_parts(table, generation))

    def _read(self, table: str, path: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[table]).parquet(path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
                return self.spark.createDataFrame([], SCHEMAS[table])
            raise

    def log(self, table: str) -> DataFrame:
        """The rows that decide the current state: the last snapshot, if any, and the log since."""
        generation = self.generation()
        rows = self._read(table, self.path(table, generation))
        return self._read(table, self._snapshot_path(table, generation)).unionByName(rows) if generation else rows

    def _append(self, table: str, rows: list[dict]) -> None:
        """Append rows; only under the lock."""
        schema = SCHEMAS[table]
        df = self.spark.createDataFrame([Row(**{f.name: r.get(f.name) for f in schema.fields}) for r in rows], schema)
        df.coalesce(1).write.mode("append").parquet(self.path(table, self.generation()))

    # -- files ----------------------------------------------------------------------------------
    def _fs(self, *parts: str):
        """Hadoop's file system and path of a place in the catalogue's folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(join_path(self.root, *parts))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, *parts: str) -> list[str]:
        """Names in one folder (none if it does not exist)."""
        fs, path = self._fs(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _create(self, text: str, *parts: str) -> bool:
        """Create a small file unless it exists; says whether this call made it."""
        fs, path = self._fs(*parts)
        try:
            out = fs.create(path, False)
        except Py4JJavaError as exc:
            if fs.exists(path):
                return False
            raise CatalogError(f"cannot write {path}: {exc.java_exception}") from exc
        out.write(text.encode())
        out.close()
        return self._content(*parts) == text

    def _content(self, *parts: str) -> str:
        fs, path = self._fs(*parts)
        try:
            file = fs.open(path)
        except Py4JJavaError:  # gone in the meantime
            return ""
        text = bytes(file.readAllBytes()).decode()
        file.close()
        return text

    # -- several writers ------------------------------------------------------------------------
    @contextlib.contextmanager
    def writing(self) -> Iterator[None]:
        """Hold the catalogue's lock for a change.  A writer that finds it taken waits ``lock_wait`` seconds; the
        lock of a writer that died is removed by :meth:`break_lock`."""
        if self._holds:  # this writer has it already
            yield
            return
        owner = f"{_user()} {uuid.uuid4().hex} since {_now()}"
        until = time.monotonic() + self.lock_wait
        while not self._create(owner, LOCK):
            if time.monotonic() > until:
                raise CatalogError(f"{self.root} is being changed by {self._content(LOCK) or 'another writer'}; "
                                   "break_lock() removes the lock of a writer that is gone")
            time.sleep(0.05)
        self._holds = True
        try:
            yield
        finally:
            self._holds = False
            self.break_lock()

    def break_lock(self) -> None:
        """Remove the lock (of a writer that is known to be gone)."""
        fs, path = self._fs(LOCK)
        fs.delete(path, False)

    def version(self, table: str) -> tuple:
        """What the log of ``table`` consists of now: it changes with every append."""
        generation = self.generation()
        return (generation, *(n for n in self._names(*self._log_parts(table, generation)) if not n.startswith(("_", "."))))

    # -- snapshots ------------------------------------------------------------------------------
    def generation(self) -> int:
        """Number of the last finished snapshot, 0 without one."""
        return max((int(n) for n in self._names("snapshots") if n.isdigit()), default=0)

    def _snapshot_path(self, table: str, generation: int) -> str:
        return join_path(self.root, f"snapshot-{generation}", table)

    def snapshot(self, file_rows: int = 1_000_000) -> int:
        """Write the current state as a snapshot and start a new log; returns the snapshot's number.

        Readers go over to it when its marker appears, which is written last; what a snapshot that died has
        written is never read.  The files of earlier logs stay (they are the catalogue's history)."""
        with self.writing():
            number = self.generation() + 1
            for table, rows, keys in self._state():
                files = max(1, math.ceil(rows.count() / file_rows))
                rows.repartition(files, *keys).write.mode("overwrite").parquet(self._snapshot_path(table, number))
            if not self._create(f"{_user()} {_now()}", "snapshots", str(number)):
                raise CatalogError(f"snapshot {number} of {self.root} was written by another writer")
            return number

    def _state(self) -> Iterator[tuple[str, DataFrame, list[str]]]:
        """The current rows of every table as log rows older than any change, with the columns by which they are dealt."""
        put = {"op": F.lit("put"), "seq": F.lit(0).cast("long")}
        for table, rows, keys in (("analyses", self.analyses().withColumns(put), ["name"]),
                                  ("datasets", self.datasets().withColumns(put), ["name"]),
                                  ("lineage", self.lineage().withColumn("seq", put["seq"]), ["left_fs_id", "right_ds_id"])):
            yield table, rows.select(*SCHEMAS[table].names), keys

    # -- current state --------------------------------------------------------------------------
    def _current(self, table: str) -> DataFrame:
        keep = [f.name for f in SCHEMAS[table].fields if f.name not in ("op", "name")]
        return latest_state(self.log(table), "name", ["seq", "id"], F.col("op") == "drop", keep).drop("seq")

    def analyses(self) -> DataFrame:
        """Current modules (one row per name)."""
        return self._current("analyses")

    def datasets(self) -> DataFrame:
        """Current datasets and feature sets (one row per name)."""
        return self._current("datasets")

    def lineage(self) -> DataFrame:
        """Edges whose feature set and parent are both current."""
        ids = by_sorting(self.datasets().select("id"))
        edges = self.log("lineage").select("left_fs_id", "right_ds_id").distinct()
        return (
            edges.join(ids.withColumnRenamed("id", "left_fs_id"), "left_fs_id", "left_semi")
            .join(ids.withColumnRenamed("id", "right_ds_id"), "right_ds_id", "left_semi")
        )

    def _current_row(self, table: str, name: str) -> Row | None:
        """Latest log row of one name, unless it is a tombstone.  The name predicate reaches the
        Parquet scan and the top row is taken without a shuffle (``orderBy(...).limit(1)``)."""
        rows = (
            self.log(table).where(F.col("name") == F.lit(name))
            .orderBy(F.col("seq").desc(), F.col("id").desc()).limit(1).collect()
        )
        if not rows or rows[0]["op"] == "drop":
            return None
        return Row(**{k: v for k, v in rows[0].asDict().items() if k not in ("op", "seq")})

    def module(self, name: str) -> Row | None:
        """The current module of that name, or None."""
        return self._current_row("analyses", name)

    def dataset(self, name: str) -> Row | None:
        """The current dataset of that name, or None."""
        return self._current_row("datasets", name)

    def list_modules(self, pattern: str = "") -> DataFrame:
        """C5 listing: name, description and details of modules whose name contains ``pattern``."""
        hits = self.analyses().where(contains_match(F.col("name"), pattern))
        return hits.select("name", "description", "details", "entrypoint").orderBy("name")

    def list_datasets(self, pattern: str = "") -> DataFrame:
        """C4 listing: datasets whose name contains ``pattern``; feature sets also show their
        module, parameters and parents."""
        return dataset_listing(self.datasets(), self.analyses(), self.lineage(), pattern).orderBy("name")

    def lookup(self, names: Iterable[str]) -> dict[str, Row]:
        """J5 for a user's list of names (driver-side, short): their current dataset rows in one
        query; every unknown name is reported."""
        return self.known(list(names)).inputs(names)

    def known(self, datasets: Iterable[str] = (), modules: Iterable[str] = ()) -> Known:
        """Current rows of the given dataset and module names (driver-side, short lists), with one
        query over both logs; the name predicates reach the Parquet scans."""
        logs, version = [], self.version("datasets")
        for table, names in (("datasets", datasets), ("analyses", modules)):
            wanted = list(dict.fromkeys(str(n) for n in names if n))
            if wanted:
                logs.append(self.log(table).where(F.col("name").isin(wanted)).withColumn("table", F.lit(table)))
        state: dict[tuple[str, str], Row] = {}
        if logs:
            both = logs[0] if len(logs) == 1 else logs[0].unionByName(logs[1], allowMissingColumns=True)
            for row in sorted(both.collect(), key=lambda r: (r["seq"], r["id"])):
                state[row["table"], row["name"]] = row
        return Known({k: r for k, r in state.items() if r["op"] != "drop"}, version)

    def resolve(self, names: Iterable[str] | DataFrame) -> DataFrame:
        """J5 over the store for any number of names (a list or a DataFrame): one row per requested
        name; an unknown name raises when the result is computed (see :func:`resolve_inputs`)."""
        # current rows are one per name already (latest_state), so no de-duplication is needed
        return resolve_inputs(self.datasets(), requested_names(self.spark, names), unique=True)

    # -- changes --------------------------------------------------------------------------------
    def register_module(self, name: str, entrypoint: str, description: str = "", details: str = "",
                        filepath: str = "", parameters: str = "", inputs: str = "", outputs: str = "") -> str:
        """Record a module; its code is the importable function ``entrypoint``
        (``package.module:function``).  A current module of the same name is an error."""
        return self.register_modules([dict(name=name, entrypoint=entrypoint, description=description, details=details,
                                           filepath=filepath, parameters=parameters, inputs=inputs,
                                           outputs=outputs)])[0]

    def register_modules(self, modules: list[dict], skip_existing: bool = False) -> list[str]:
        """C6 for several modules: one lookup and one append for all of them.  A taken name is an
        error, or with ``skip_existing`` that module is left as it is (register if absent)."""
        names = [m.get("name") for m in modules]
        if not all(names) or len(set(names)) != len(names):
            raise CatalogError("every module needs a distinct name")
        with self.writing():
            taken = [r["name"] for r in self.analyses().where(F.col("name").isin(names)).select("name").collect()]
            if taken and not skip_existing:
                raise CatalogError(f"module name taken: {', '.join(sorted(taken))}")
            modules = [m for m in modules if m["name"] not in taken]
            if not modules:
                return []
            rows, seq, now, user = [], _seq(), _now(), _user()
            for m in modules:
                rows.append(dict({"description": "", "details": "", "filepath": "", "parameters": "", "inputs": "",
                                  "outputs": ""}, **m, id=uuid.uuid4().hex, created=now, user=user, op="put", seq=seq))
            self._append("analyses", rows)
            return [r["id"] for r in rows]

    def drop_module(self, name: str) -> None:
        """Tombstone a module; an unknown name is an error."""
        with self.writing():
            row = self.module(name)
            if row is None:
                raise CatalogError(f"no module named {name!r}")
            self._append("analyses", [dict(row.asDict(), op="drop", seq=_seq())])

    def create_dataset(self, name: str, filepath: str, schema: str, identifier: str = "", description: str = "",
                       details: str = "", fileformat: str = "parquet", module_id: str | None = None,
                       module_parameters: str = "") -> str:
        """Record a dataset; a current dataset of the same name is an error."""
        with self.writing():
            self.check_new_dataset(name)
            did = uuid.uuid4().hex
            self._append("datasets", [dict(
                id=did, name=name, fileformat=fileformat, identifier=identifier, description=description, details=details,
                filepath=filepath, created=_now(), user=_user(), module_id=module_id, module_parameters=module_parameters,
                schema=schema, op="put", seq=_seq(),
            )])
        return did

    def create_datasets(self, entries: list[dict], checked: tuple | None = None) -> list[str]:
        """C1 for several datasets: one lookup and one append.  Each entry has ``name``, ``filepath``, ``schema``
        and optionally the other ``datasets`` columns.  ``checked`` is the log's :meth:`version` from before an
        earlier check of the names: the lookup is left out if nothing has been appended since."""
        names = [e["name"] for e in entries]
        if not all(names) or len(set(names)) != len(names):
            raise CatalogError("every dataset needs a distinct name")
        with self.writing():
            if checked is None or checked != self.version("datasets"):
                self.check_new_datasets(names)
            seq, now, user = _seq(), _now(), _user()
            rows = [dict({"fileformat": "parquet", "identifier": "", "description": "", "details": "",
                          "module_id": None, "module_parameters": ""}, **e,
                         id=uuid.uuid4().hex, created=now, user=user, op="put", seq=seq) for e in entries]
            self._append("datasets", rows)
        return [r["id"] for r in rows]

    def record_datasets(self, rows: DataFrame) -> None:
        """C1 in bulk, for entries held in a DataFrame: ``name``, ``filepath`` and any other columns of
        the ``datasets`` table; what is missing is null, a missing ``id`` is made from the name.  Names
        must be new and distinct (checked by one aggregation); nothing is collected."""
        have = {c: F.col(c) for c in rows.columns}
        given = {"id": F.md5(F.col("name").cast("binary")), "fileformat": F.lit("parquet"), **have, "op": F.lit("put"),
                 "seq": F.lit(_seq()), "created": F.lit(_now()), "user": F.lit(_user())}
        entries = rows.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DATASETS_SCHEMA))
        with self.writing():
            names = entries.select("name", F.lit(1).alias("n")).unionByName(self.datasets().select("name", F.lit(1).alias("n")))
            twice = names.groupBy("name").agg(F.sum("n").alias("n")).where("n > 1 OR name IS NULL")
            bad = twice.agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name")).first()
            if bad["n"]:
                raise CatalogError(f"{bad['n']} dataset name(s) taken, given twice or null; the first: {bad['name']}")
            entries.write.mode("append").parquet(self.path("datasets", self.generation()))

    def compact(self, root: str, file_rows: int = 1_000_000) -> Catalog:
        """The current state in a new folder, a file for each ``file_rows`` rows of a table: appends are one
        small file each, so a long-lived catalogue is moved to a compacted one now and then (no file is changed
        in place).  Rows are dealt by their keys, so the work before is not drawn into the writing tasks."""
        new = Catalog(self.spark, root)
        for table, rows, keys in self._state():
            files = max(1, math.ceil(rows.count() / file_rows))
            rows.repartition(files, *keys).write.parquet(new.path(table))
        return new

    def check_new_datasets(self, names: Iterable[str]) -> None:
        """Every name must be free: one join of the names with the current state, however many they are (the message
        names the first twenty)."""
        wanted = requested_names(self.spark, names).distinct()
        taken = [r["name"] for r in wanted.join(by_sorting(self.datasets().select("name")), "name", "left_semi").orderBy("name").limit(21).collect()]
        if taken:
            raise CatalogError(f"dataset name taken: {', '.join(taken[:20])}{' and others' if len(taken) > 20 else ''}")

    def check_new_dataset(self, name: str) -> None:
        if not name:
            raise CatalogError("a dataset needs a name")
        if self.dataset(name) is not None:
            raise CatalogError(f"dataset name taken: {name}")

    def create_featureset(self, name: str, module_name: str, filepath: str, schema: str,
                          module_parameters: Mapping | str = "", description: str = "", details: str = "") -> str:
        """Record a feature set made by ``module_name`` (which must exist)."""
        module = self.module(module_name)
        if module is None:
            raise CatalogError(f"no module named {module_name!r}")
        params = module_parameters if isinstance(module_parameters, str) else json.dumps(module_parameters)
        return self.create_dataset(name, filepath, schema, description=description, details=details,
                                   module_id=module["id"], module_parameters=params)

    def create_relation(self, featureset_id: str, parent_ids: Iterable[str]) -> None:
        """One lineage edge from the feature set to each parent."""
        seq = _seq()
        rows = [dict(left_fs_id=featureset_id, right_ds_id=p, seq=seq) for p in dict.fromkeys(parent_ids)]
        if rows:
            with self.writing():
                self._append("lineage", rows)

    def drop_dataset(self, name: str) -> None:
        """Tombstone a dataset; its files stay.  Lineage edges touching it disappear from
        :meth:`lineage` because they are joined with the current datasets."""
        with self.writing():
            row = self.dataset(name)
            if row is None:
                raise CatalogError(f"no dataset named {name!r}")
            self._append("datasets", [dict(row.asDict(), op="drop", seq=_seq())])


class Known:
    """Current catalogue rows of a few names, fetched together (:meth:`Catalog.known`), and the version of the log
    of datasets from before."""

    def __init__(self, state: Mapping[tuple[str, str], Row], version: tuple | None = None):
        self._state, self.version = state, version

    def module(self, name: str) -> Row:
        """The module row; an unknown name is an error."""
        row = self._state.get(("analyses", name))
        if row is None:
            raise CatalogError(f"no module named {name!r}")
        return row

    def require_free(self, name: str) -> None:
        if not name:
            raise CatalogError("a dataset needs a name")
        if ("datasets", name) in self._state:
            raise CatalogError(f"dataset name taken: {name}")

    def inputs(self, names: Iterable[str]) -> dict[str, Row]:
        """Dataset rows by name; every unknown name is reported."""
        wanted = list(dict.fromkeys(str(n) for n in names))
        missing = [n for n in wanted if ("datasets", n) not in self._state]
        if missing:
            raise CatalogError(f"{len(missing)} input dataset(s) not found: {sorted(missing)}")
        return {n: self._state["datasets", n] for n in wanted}


def _now():
    import datetime as dt

    return dt.datetime.now()


_last_seq = [0]


def _seq() -> int:
    """Strictly increasing write sequence of this driver (nanoseconds since the epoch)."""
    s = max(time.time_ns(), _last_seq[0] + 1)
    _last_seq[0] = s
    return s
