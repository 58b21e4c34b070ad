import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools"), os.path.dirname(os.path.abspath(__file__))]

from llm_rows import AWKWARD  # noqa: E402
from quoteline.llm.common import importable  # noqa: E402

@pytest.fixture(scope="session")
def sp(spark):
    importable(spark)
    return spark


@pytest.fixture()
def awkward(sp):
    """The awkward rows, with columns whose names the operators use themselves."""
    rows = [(d, t, "en", "s", 0, i, 1, 2, 3) for i, (d, t) in enumerate(AWKWARD)]
    return sp.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, chunk int, "
                                    "n_lines int, node int, row_id int")


@pytest.fixture()
def nothing(sp):
    return sp.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")

