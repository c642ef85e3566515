"""Every registered query against its SQL, over the whole test tables."""

import pytest

import __spark_entry__ as contract
from checks import oracles, registry
from checks.compare import compare, connection
from tests.conftest import SF_DIR

SQL = oracles.oracle_sql()
ROWS_ONLY = {"discover_files", "embed_chunks", "vector_topk_ivf"}


@pytest.fixture(scope="module")
def db():
    return connection(SF_DIR)


@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_query(spark, db, key):
    outcome, _ = compare(spark, db, SF_DIR, key, SQL.get(key))
    assert outcome.startswith("equal" if key in SQL else "rows only"), outcome
    if key not in ("pending_deals_null",):
        assert not outcome.endswith(": 0"), outcome


def test_only_the_known_queries_lack_sql():
    assert set(registry.QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(registry.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["company_name", "engagement_month", "part", "all_messages"]
    assert df.count() > 0
