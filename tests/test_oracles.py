import pytest

import __spark_entry__ as entry
from invoicebench.queries import QUERIES
from oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, name):
    assert compare(spark, SF, name, entry.queries()[name], entry.oracle_sql()[name]) is None
