"""Every registered query with an oracle equals its DuckDB SQL exactly
(rows, column names, types, values; order-insensitive) on the small fixture."""

from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck_connection

from gridlake.plans.registry import all_queries

_QUERIES = all_queries()
_WITH_SQL = sorted(n for n, q in _QUERIES.items() if q.sql)


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", _WITH_SQL)
def test_query_matches_oracle(spark, duck, name):
    q = _QUERIES[name]
    result = compare(spark, duck, name, q.fn, q.sql, SF_SMALL)
    assert result["status"] == "ok", result


@pytest.mark.parametrize("name", sorted(n for n, q in _QUERIES.items() if not q.sql))
def test_query_without_oracle_runs(spark, name):
    assert _QUERIES[name].fn(spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
