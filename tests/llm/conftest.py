import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    from reviewlab.llm.common import table
    return table(spark, SMALL, "documents")


@pytest.fixture
def frame(spark):
    """Documents with nulls, empty and white-space texts, copies, near copies, and columns named like internal ones."""
    base = " ".join(f"word{i}" for i in range(120))
    near = base.replace("word60 ", "other ")
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (4, None, None, None), (5, "", "en", "a"),
            (6, " \t\n", None, "b"), (7, "one two", "en", None), (8, "ONE Two", "de", "a"), (9, "x " * 80, "en", "a"),
            (10, "été ñandú " * 3, "fr", "b"), (11, " ".join(f"solo{i}" for i in range(2000)), "en", "a")]
    return spark.createDataFrame([(*r, 0, "k", 1) for r in rows],
                                 "doc_id long, text string, lang string, source string, n long, key string, score int")
