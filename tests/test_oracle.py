"""Every registered query against its DuckDB SQL on the driver tables (small scale)."""

import importlib.util
import os

import pytest

from conftest import SF_SMALL

# RISKMART_ORACLE_SF=/root/testdata/sf0.01 runs the same checks at the driver's scale.
SF = os.environ.get("RISKMART_ORACLE_SF", SF_SMALL)

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


ENTRY = _entry()
QUERIES = ENTRY.queries()
ORACLE = ENTRY.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    from riskmart.plans.oracle import duckdb_connection
    return duckdb_connection(SF)


def test_every_query_has_an_oracle():
    from riskmart.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(QUERIES) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    from riskmart.plans.oracle import compare
    ok, msg = compare(QUERIES[name](spark, SF), duck, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[-2:] == ["crisis_score", "rank"]
