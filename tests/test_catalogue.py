import pytest
from compare import compare

import __spark_entry__ as entry
from fieldloom.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, name):
    assert compare(spark, SF, name, catalogue.QUERIES[name], catalogue.SQL[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
