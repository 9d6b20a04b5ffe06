"""Every registered query against its DuckDB oracle.

Runs at sf0.001 by default; set LEDGERLAKE_ORACLE_SF to another folder (e.g.
/root/testdata/sf0.01, the driver's scale) to repeat the gate there.
"""

import os

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare

QUERIES = E.queries()
ORACLES = E.oracle_sql()
ORACLE_SF = os.environ.get("LEDGERLAKE_ORACLE_SF", SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, name, QUERIES[name](spark, ORACLE_SF), ORACLES[name], ORACLE_SF)
    assert res["rows_match"] and res["schema_match"] and res["values_match"], res


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0 and df.columns


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 5
    assert "fraud_rate_pct" in df.columns
