"""Every named query against its DuckDB SQL on the small tables."""

import oracle_check
import pytest

from swapbook.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    good, note = oracle_check.compare(spark, con, FOLDER, name)
    assert good, note
