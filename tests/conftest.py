import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kawara.session import session


@pytest.fixture(scope="session")
def spark():
    s = session(
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def make(spark):
    """DataFrame from rows and a DDL schema, so that nothing is inferred."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build
