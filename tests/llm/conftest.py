from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).parent))
from cases import EDGE  # noqa: E402

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("n", T.LongType()), T.StructField("digest", T.StringType()),  # names that operators might use
])


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text) with extra columns."""
    return lambda rows: spark.createDataFrame([(i, t, None, 7, "x") for i, t in rows], DOCS)



@pytest.fixture(scope="session")
def edge(documents):
    return documents(EDGE)
