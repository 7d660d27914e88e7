"""Fixtures shared by these tests."""

import pytest


@pytest.fixture
def docs(spark):
    """Documents from texts; doc_id follows the position unless pairs are given."""

    def build(*texts):
        rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string")

    return build
