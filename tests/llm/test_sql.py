"""Queries with SQL against it on the smallest supplied tables, and the others' shape."""

import pytest

from checks.compare import connect, difference
from merchlake.llm import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, tables, name):
    assert difference(spark, tables, catalog.QUERIES[name], catalog.SQL[name], SF_DIR) is None


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert 100 < len(rows) < 300 and all(r.round_trip for r in rows)
