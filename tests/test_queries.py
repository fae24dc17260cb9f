"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import pytest

from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES
from loyalspan.operators.fit import AT_LIMIT, CONVERGED, FLAT

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the order tables")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_statement_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, db, name):
    same, detail = compare(spark, db, name, FOLDER)
    assert same, detail


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_fit_query(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert rows
    for row in rows:
        assert row["stop"] in (CONVERGED, AT_LIMIT, FLAT)
        if "at_bound" in row.asDict():
            # A parameter at its limit is exactly there, and none rests on the edge of the search.
            gone = row["value"] == 0 or math.isinf(row["value"])
            assert gone == (row["at_bound"] and row["parameter"] != "v")
            assert gone or row["value"] > 6.2e-6
            assert row["stop"] == FLAT or row["gradient"] < 1e-3
            assert row["stop"] != CONVERGED or not row["at_bound"]
