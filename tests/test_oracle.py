"""Every query against its SQL, run by another engine on the same tables."""

import os

import pytest

from workload.compare import differences
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert differences(spark, name, SF_DIR) == ""
