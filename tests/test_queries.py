"""Answers of every query with SQL against the oracle engine, all non-empty: equal empty answers prove nothing."""

import pytest

from tallyframe.plans.library import library

BOOK = library()
KEYS = [k for k in BOOK if BOOK[k].sql]


def rows(found):
    return sorted(tuple("~" if v is None else repr(v) for v in r) for r in found)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, oracle, data, key):
    query = BOOK[key]
    df = query.run(spark, data)
    found = [tuple(r) for r in df.collect()]
    cursor = oracle.execute(query.oracle())
    assert df.columns == [c[0] for c in cursor.description]
    assert found
    assert rows(found) == rows(cursor.fetchall())


def test_every_survey_suite_is_there():
    count = lambda prefix: sum(k.startswith(prefix) for k in BOOK)
    assert (count("tpch."), count("tpcds."), count("tpcds14.")) == (22, 105, 104)
    assert (count("impala."), count("impala_orig."), count("simple."), count("big.")) == (22, 15, 9, 9)


def test_reference_parameters_plan(spark, data):
    """Every report also plans with its published parameters."""
    from tallyframe.sources.catalog import Catalog
    for key in ("tpcds.q13", "tpcds.q23a", "tpcds.q58", "tpch.q19", "tpcds.q64"):
        assert BOOK[key].answer(Catalog(spark, data, BOOK[key].suite)).columns == BOOK[key].shown()
