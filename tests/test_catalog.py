"""Every registered query against its SQL; queries without SQL must return rows with a stable schema."""

import pytest
from conftest import SF_DIR
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_returns_rows(spark, name):
    df = queries()[name](spark, SF_DIR)
    rows = df.collect()
    assert rows
    for r in rows:
        for column in ("predicted_prob", "mean_probability"):
            if column in df.columns:
                assert 0 <= r[column] <= 1
    shares = [c for c in df.columns if c.startswith(("TOPIC_NEW_", "Topic_AN_"))]
    for r in rows if shares else []:
        total = sum(r[c] for c in shares)
        assert min(r[c] for c in shares) >= 0 and (abs(total - 1) < 1e-6 or total == 0)


def test_entry(spark):
    assert entry(spark).count() > 0
