"""Every registered query against its SQL on the smallest tables."""

import pytest

from catalogue import ORACLES, QUERIES
from compare import difference
from conftest import SMALL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    assert difference(spark, duck, SMALL, name) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
