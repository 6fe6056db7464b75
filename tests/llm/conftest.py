import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(os.path.dirname(HERE))]

from llm_cases import EDGES  # noqa: E402


@pytest.fixture
def edges(spark):
    """Edge rows with columns whose names clash with the operators' own."""
    rows = [(i, t, "spans", i, "row", "en") for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, n long, row string, lang string")


@pytest.fixture
def nothing(edges):
    return edges.limit(0)
