import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rows_for_tests import ODD, SCHEMA, rows_of  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows_of(ODD), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i, _, _ in ODD if i is not None] + [(None, 1, 1), (5, None, None), (999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
