"""Every registered query against its SQL, on the smallest data folder."""

import os

import pytest

import __spark_entry__ as entry
from kawara.plans import oracle
from kawara.plans.queries import REGISTRY
from tests import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle.SQL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, con, name):
    assert compare.compare(spark, con, name, SF_DIR) is None


def test_flagship_has_rows(spark):
    row = entry.entry(spark).first()
    assert row.at_risk + row.surveyed_safe + row.unknown == spark.read.parquet(f"{entry.SMOKE_DIR}/orders.parquet").count()
