import pytest
from oracle import ahead, compared

from framewright.plans import queries as core

SF = "sf0.001"
PLAIN = sorted(set(core.QUERIES) - set(core.ORACLES))


@pytest.fixture(scope="module")
def results(spark):
    return {**compared(spark, core.QUERIES, core.ORACLES, SF), **ahead(PLAIN, lambda n: core.QUERIES[n](spark, f"/root/testdata/{SF}").count())}


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_query_equals_sql(results, name):
    (ca, a), (cb, b) = results[name].result()
    assert ca == cb
    assert len(a) == len(b)
    assert a == b


@pytest.mark.parametrize("name", PLAIN)
def test_query_runs(results, name):
    assert results[name].result() > 0
