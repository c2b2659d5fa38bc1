"""Every registered query of the ledger against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entries
from check_oracles import compare, database
from workload.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(SMALL)


FOREIGN_TO_PLANS = ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    df = entries.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FOREIGN_TO_PLANS if word in plan]
    assert compare(df, connection, entries.oracle_sql()[name]) == ""


def test_entry_has_a_stable_schema(spark):
    df = entries.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["BATCH_ID", "JOURNAL_ID", "BRANCH_CODE"]
