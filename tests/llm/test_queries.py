import os

import pytest
from llm_helpers import same_as_sql

import __spark_entry__ as entry
from sowcast.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ORACLE)
def test_same_as_sql(spark, name):
    assert same_as_sql(QUERIES[name](spark, SF_DIR), ORACLE[name], SF_DIR)


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and ORACLE.items() <= entry.oracle_sql().items()
