"""Every registered query against its DuckDB oracle on the sf0.01 tables
(the same check the driver runs: names, types, row multiset)."""

import pytest

from conftest import SF_ORACLE

from panelspark import catalog
from panelspark.oracle.compare import compare

QUERIES = catalog.all_queries()


def test_registry_names_unique():
    names = [q.name for q in QUERIES]
    assert len(names) == len(set(names))


def test_every_query_has_an_oracle():
    assert all(q.sql for q in QUERIES)


@pytest.mark.parametrize("query", QUERIES, ids=[q.name for q in QUERIES])
def test_query_matches_oracle(spark, duck_oracle, query):
    result = compare(query.name, query.build(spark, SF_ORACLE), duck_oracle, query.oracle())
    assert result.ok, result.problems
