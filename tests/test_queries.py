"""Every registered query against its oracle SQL."""

import pytest

import __spark_entry__ as contract
from marketlake.registry.core import ORACLES, QUERIES
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# The queries of the library; those that can be taken out have tests of their own.
KEYS = sorted(QUERIES)
# Rightly empty at this size.
EMPTY = {"mart_event_coherence", "deviation"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, con, key):
    diff = compare(spark, con, SF_DIR, contract.queries()[key], contract.oracle_sql()[key])
    assert diff is None or (key in EMPTY and diff == "no rows on either side")


def test_entry(spark):
    assert contract.entry(spark).count() > 0
