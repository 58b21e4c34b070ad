import os
import posixpath

import pytest
from pyspark.sql import functions as F

from quoteline.functions.paths import (
    PathNameError,
    base_name,
    base_name_col,
    dataset_name,
    dataset_name_col,
    identifier_col,
    identifier_of,
    join_path,
)

PATHS = [
    "/p/to/file.h5",
    "/path/to/dataset.h5",
    "/p/a-b.h5",
    "https://m.therou.example.com/en/474.html",
    "https://thther.example.org/en/685",
    "http://blog.ththan.example.net/en/369#top",
    "https://blog.tiontion.example.com/en/853/",
    "/x/.bashrc",
    "/x/archive.tar.gz",
    "/x/file.",
    "/x/..hidden.txt",
    "relative/name.parquet",
    "noslash.h5",
]


def test_identifier_of():
    assert identifier_of("/p/to/file.h5") == "file"
    assert dataset_name("file", "orders") == "file_ORDERS"
    with pytest.raises(PathNameError):
        identifier_of("/p/a-b.h5")
    with pytest.raises(PathNameError):
        identifier_of("noslash.h5")


def test_base_name_follows_splitext():
    for p in PATHS:
        expect = os.path.splitext(posixpath.basename(p.rstrip("/")))[0]
        assert base_name(p) == expect, p


def test_column_forms_equal_driver_forms(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    ident = identifier_col(F.col("path"))
    rows = df.select("path", ident.alias("i"), dataset_name_col(ident, "orders").alias("n"),
                     base_name_col(F.col("path")).alias("b")).collect()
    for r in rows:
        try:
            expect = identifier_of(r["path"])
        except PathNameError:
            expect = ""
        assert r["i"] == expect, r["path"]
        assert r["n"] == (f"{expect}_ORDERS" if expect else None)
        assert r["b"] == base_name(r["path"]), r["path"]


def test_join_path():
    assert join_path("swift://container.Test", "AB00", "AB00_ORDERS.parquet") == "swift://container.Test/AB00/AB00_ORDERS.parquet"
    assert join_path("/data/", "/x/") == "/data/x"
