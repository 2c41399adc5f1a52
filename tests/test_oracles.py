"""Every registered query of the security operators against its SQL, or for its rows where SQL can't say it."""

import pytest

from sparkwarden.registry import ORACLES, QUERIES

from . import oracle
from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    assert oracle.difference(spark, duck, SF, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", ["dt1_abnormal_ports", "dt8_algorithmic_hosts", "dt9_new_domains", "dt23_parameter_anomalies", "dt26_leak_alerts", "so5_common_members"])
def test_finds_something(duck, name):
    """At both small sizes; the rows themselves are compared above."""
    for con in (duck, oracle.connect(SF.replace("0.001", "0.01"))):
        assert con.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchone()[0] > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
