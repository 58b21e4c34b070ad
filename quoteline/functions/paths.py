"""Names derived from file paths: dataset identifiers, base names, dataset names.

Each rule exists twice: as a driver-side helper for parameters (one path given by the user)
and as a Spark column expression for paths held in a DataFrame.  Both give the same result.
"""

from __future__ import annotations

import os
import posixpath
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the identifier of a source file is the word before its extension, after the
# last slash that is followed by ``word.word``; the match is anchored at the start only.
IDENTIFIER_PATTERN = r"^.+/(\w+)\.\w+"

# Fixed value: table names of an order-book source.
BOOK_TABLES = ("ORDERS", "CANCELS", "TRADES")

_IDENTIFIER_RE = re.compile(IDENTIFIER_PATTERN, re.ASCII)


class PathNameError(ValueError):
    """A path from which no dataset identifier can be derived."""


def identifier_of(path: str) -> str:
    """P6 on the driver: identifier of a source path, or :class:`PathNameError`."""
    m = _IDENTIFIER_RE.match(path)
    if not m:
        raise PathNameError(f"no identifier in {path!r}: expected .../<word>.<extension>")
    return m.group(1)


def dataset_name(identifier: str, table: str) -> str:
    """E7 on the driver: ``<identifier>_<TABLE>``."""
    return f"{identifier}_{table.upper()}"


def base_name(path: str) -> str:
    """E6 on the driver: file name without directory and without its last extension."""
    stem, _ = os.path.splitext(posixpath.basename(path.rstrip("/")))
    return stem


def join_path(root: str, *parts: str) -> str:
    """Join path parts with single slashes whether or not ``root`` ends in one."""
    out = root.rstrip("/")
    for part in parts:
        out = f"{out}/{part.strip('/')}"
    return out


# ---------------------------------------------------------------------------------------------
# Column forms
# ---------------------------------------------------------------------------------------------

def identifier_col(path: Column) -> Column:
    """P6 as a column; ``''`` where the path has no identifier (callers treat that as an error)."""
    return F.regexp_extract(path, IDENTIFIER_PATTERN, 1)


def dataset_name_col(identifier: Column, table: str) -> Column:
    """E7 as a column; null where the identifier is empty."""
    return F.when(identifier != F.lit(""), F.concat(identifier, F.lit("_" + table.upper())))


def base_name_col(path: Column) -> Column:
    """E6 as a column, following ``os.path.splitext(os.path.basename(...))``.

    Trailing slashes are dropped first.  The extension is the part from the last dot, unless
    every character before that dot is a dot (``.bashrc`` keeps its name).
    """
    leaf = F.regexp_extract(F.regexp_replace(path, r"/+$", ""), r"([^/]*)$", 1)
    stem = F.regexp_extract(leaf, r"^(\.*[^.].*)\.[^.]*$", 1)
    return F.when(stem != F.lit(""), stem).otherwise(leaf)
