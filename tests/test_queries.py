"""Every named query against its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from sluiceway.plans.oracles import ORACLES
from sluiceway.plans.queries import BATCH_QUERIES
from sluiceway.plans.stream_queries import STREAM_QUERIES
from tests.compare import mismatch, reference

QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    assert mismatch(got, reference(ORACLES[name], sf)) is None


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["key", "window_start", "sum_value", "n"]
    assert rows.count() > 0
