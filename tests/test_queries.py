"""Every registered query of the reference's operators against its SQL; those without SQL give rows."""

import pytest

from tests.compare import same
from tests.conftest import DATA
from tracewright.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    same(spark, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
