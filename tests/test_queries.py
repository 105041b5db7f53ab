"""Every registered query against its SQL, over whole tables."""

import os

import pytest
from compare import connect, mismatch

from starloom.queries import REGISTRY

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_matches_sql(spark, con, name):
    problem = mismatch(spark, con, FOLDER, REGISTRY[name])
    assert problem is None, problem


def test_comparison_notices_a_difference(spark, con):
    from dataclasses import replace

    q = REGISTRY["current_product_list"]
    assert mismatch(spark, con, FOLDER, replace(q, sql=q.sql + " and product_id <> 0"))


def test_any_ten(spark):
    rows = REGISTRY["limit_any"](spark, FOLDER).collect()
    assert len(rows) == 10 and all(r.fax is None for r in rows)


def test_entry_is_the_flagship(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[:2] == ["order_year", "category"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
