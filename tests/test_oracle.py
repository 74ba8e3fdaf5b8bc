"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the contract's shape and the smoke entry."""

import pytest

from conftest import SF_CHECK

import __spark_entry__ as E
import oracle_harness as H


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert {k for k in set(q) - set(o) if not (k.startswith("op") or k == "pipeline")} == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-3:] == ["prediction", "predictedLabel", "probability"]


@pytest.fixture(scope="module")
def con():
    return H.duck(SF_CHECK)


OWN = sorted(k for k in E.queries() if not (k.startswith("op") or k == "pipeline"))


@pytest.mark.parametrize("key", OWN)
def test_query_matches_oracle(spark, con, key):
    ok, msg = H.compare(spark, con, key, SF_CHECK)
    assert ok, msg
