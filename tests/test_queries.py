"""Registered queries against their DuckDB SQL, on whole tables."""

from __future__ import annotations

import pytest

from quillstack.plans import registry
from tests import oracle

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    if name in registry.ORACLES:
        assert oracle.difference(df, db, registry.ORACLES[name]) == ""
    else:
        assert df.limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 200
    assert set(entry.oracle_sql()) <= set(entry.queries())
