"""Every checked query agrees with its SQL on the small tables."""

import pytest

from checks import ORACLES, QUERIES
from checks.compare import compare, duck


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    good, note = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf)
    assert good, note


def test_entry_lists_every_query():
    import __spark_entry__ as entry

    assert entry.queries().keys() == QUERIES.keys() | entry.LLM_QUERIES.keys()
    assert set(entry.oracle_sql()) <= set(entry.queries())
