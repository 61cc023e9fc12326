from __future__ import annotations

import pytest

EDGE_TEXTS = [None, "", " \n\t", "one", "one two", "A" * 450, "word " * 3000, "é ñ ß 日本 🙂 " * 30, "same text in two rows " * 12,
              "same text in two rows " * 12]


@pytest.fixture(scope="session")
def edge(spark):
    """Null ids and texts, empty and long texts, repeated rows, and a further column with the name of a result."""
    rows = [(i if i % 4 else None, text, "kept", 0.5) for i, text in enumerate(EDGE_TEXTS)]
    return spark.createDataFrame(rows + rows[-1:], "doc_id long, text string, n_tokens string, score double")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
