"""Every registered query against its DuckDB oracle on the smallest fixture."""

import pytest

import __spark_entry__ as E
from tidewater import catalog
from oracle_harness import compare, duck_connection

#: The library's own queries; those of the training-data operators are tested in tests/llm.
QUERIES = {name: fn for name, fn in E.queries().items() if name in catalog.REGISTRY}
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck_connection(sf_small)


def test_every_query_has_an_oracle_or_is_documented():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_small, con, name):
    res = compare(QUERIES[name](spark, sf_small), con, ORACLE[name])
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["Year", "Orders", "Revenue", "Profit"]
