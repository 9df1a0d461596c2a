"""Every query of the analytics engine against its SQL, on the smallest tables. The text operators
have tests of their own."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from checks.registry import ORACLES, QUERIES
from tests.conftest import SMALL

ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


def _text(value) -> str:
    return "<null>" if value is None else repr(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    assert len(set(columns)) == len(columns)
    ours = sorted(tuple(_text(row[c]) for c in columns) for row in frame.collect())

    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(tuple(_text(row[i]) for i in order) for row in result.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_give_rows(spark, name):
    frame = QUERIES[name](spark, SMALL)
    rows = frame.collect()
    assert rows
    if "score" in frame.columns:
        assert all(0.0 <= row["score"] <= 1.0 for row in rows)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry_gives_the_flagship_rollup(spark):
    frame = spark_entry.entry(spark)
    assert frame.columns[:2] == ["plan", "region"]
    assert frame.count() > 0
