"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (installed, never copied into the repository)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def release() -> None:
    """Give memory that a worker has freed back to the system.  Workers live on after a task, and the allocators
    of C and Arrow keep what was freed; with many stages one after the other that adds up."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


_RESIDENT: dict = {}


def resident(key, make: Callable):
    """A large object that a worker keeps from task to task (a model with its word table, an automaton).  A worker
    keeps one at a time: another operator's stage in the same worker takes its place."""
    if key not in _RESIDENT:
        drop_residents()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def drop_residents() -> None:
    _RESIDENT.clear()
    release()


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, with :func:`release` once they are over."""
    yield from batches
    release()


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder (``spark.checkpoint.dir``) and read back: its lineage is
    cut, and the loss of an executor afterwards costs nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark: SparkSession) -> None:
    """Prepare a session: Arrow batches of 2,000 rows, unless it has a number of its own, and local Python
    workers that import this package from where it lies.  On a cluster it is installed on
    the nodes or shipped with ``--py-files``; a folder that is not there does no harm."""
    if spark.conf.get(_BATCH_ROWS, "10000") == "10000":  # the default: whole texts make such batches large
        spark.conf.set(_BATCH_ROWS, "2000")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def stored_and_measured(df: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """:func:`stored` with the number of rows and a checksum of them, both gathered by the write itself."""
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("sum"))
    out = stored(rows, label)
    return out, seen.get["n"], int(seen.get["sum"] or 0)


class Memo:
    """Bounded lookup table of two generations: a full young generation becomes the old one, and what
    is still in use is copied forward.  Forgetting costs time only, never a different result.

    A generation holds at most ``size`` entries and about ``max_bytes`` bytes of keys and values (as counted by
    ``len``, and 150 for each entry), but for what the batch at hand brings; a key longer than ``longest`` is
    forgotten after its batch."""

    def __init__(self, size: int, max_bytes: int = 96 << 20, longest: int = 256):
        self.size, self.max_bytes, self.longest = size, max_bytes, longest
        self.young, self.old, self.bytes, self.once = {}, {}, 0, []

    def put(self, items: Iterable[tuple]) -> None:
        """Values for missing keys."""
        young, longest, total, n = self.young, self.longest, 0, len(self.young)
        for key, value in items:
            young[key] = value
            size = len(key)
            if size > longest:
                self.once.append(key)
            total += size + (len(value) if isinstance(value, (str, bytes)) else 0)
        self.bytes += total + 150 * (len(young) - n)

    def missing(self, rows: Iterable[Iterable]) -> list:
        """The distinct keys of all rows without a value; the others are in the young generation afterwards."""
        young, old, out, again = self.young, self.old, [], []
        for key in set().union(*rows).difference(young):
            value = old.get(key)
            if value is None:
                out.append(key)
            else:
                again.append((key, value))
        self.put(again)
        return out

    def trim(self) -> None:
        """To be called between batches, when no lookup is pending."""
        young = self.young
        for key in self.once:
            value = young.pop(key, None)
            if value is not None:
                self.bytes -= len(key) + (len(value) if isinstance(value, (str, bytes)) else 0) + 150
        self.once = []
        if len(young) > self.size or self.bytes > self.max_bytes:
            self.old, self.young, self.bytes = young, {}, 0


def slices(texts: list, limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` (None counts as empty) of about ``limit`` characters; a longer
    text makes a range of its own."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        size = len(text) if text is not None else 0
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if len(texts) > start:
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64), so that every bit of the result depends on all."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
