import os
import sys

import pytest

from feedloom.llm.common import ship_package


sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def texts(spark):
    """Rows (doc_id, text) with the awkward cases every operator must take, and a clashing column."""

    def make(rows):
        return spark.createDataFrame([(i, t, "src", 1.0, 7) for i, t in rows], "doc_id long, text string, source string, score double, n long")

    return make
