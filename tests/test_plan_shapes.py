"""Physical plans: what is scanned, shuffled and broadcast; skewed keys."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.operators import movements as mov
from daybook.operators import parse
from daybook.operators import postings as post
from daybook.operators import validation as val
from daybook.operators.transfers import latest_income_expense
from daybook.session import broadcast_if_small
from daybook.sinks import lake
from daybook.sources.lake import read_lake
from workload import ledger_jobs as jobs

DAY = dt.date(2001, 1, 1)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def no_automatic_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_masters_are_broadcast_by_their_measured_size(small, no_automatic_broadcast):
    plan = physical(jobs.ledger_day(small).balances)
    assert plan.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in plan


def test_lines_are_summed_before_they_are_shuffled(small):
    plan = physical(mov.key_totals(small.lines()))
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning") > plan.index("HashAggregate")
    assert plan.count("Exchange hashpartitioning(GLCC") == 1


def test_balanced_postings_need_one_shuffle(spark):
    schema = ", ".join(
        f"{c} " + ("long" if c == "TRANSACTION_COUNT" else "decimal(25,4)" if "AMOUNT" in c else "string")
        for c in mov.POSTING_COLUMNS
    )
    plan = physical(post.balanced_postings(spark.createDataFrame([], schema).repartition(4)))
    assert plan.count("Exchange hashpartitioning") == 1


def test_parsing_is_one_projection(spark):
    lines = spark.createDataFrame([("x", "f")], "value string, FILE_NAME string")
    plan = optimized(parse.parse_fixed_width(lines, jobs.LEDGER_LAYOUT, keep=["FILE_NAME"]))
    assert plan.count("Project") == 1


def test_latest_slice_pushes_prefixes_and_prunes_dates(spark, small, tmp_path):
    path = str(tmp_path / "balances")
    lake.overwrite(small("balance_table"), path, ["BALANCE_DATE"])
    plan = physical(latest_income_expense(read_lake(spark, path)))
    assert "PushedFilters: [Or(StringStartsWith(CGL,7),StringStartsWith(CGL,8))]" in plan
    assert "PartitionFilters: [isnotnull(BALANCE_DATE" in plan and "subquery" in plan.lower()
    assert "BRANCH_CODE" in plan and "ReadSchema" in plan and ",BALANCE:" not in plan.split("ReadSchema")[1][:200]


def skewed(spark, n=60_000):
    """A third of all lines under one key."""
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997 + 2)
    return spark.range(n).select(
        F.lpad(key.cast("string"), 5, "0").alias("BRANCH_CODE"),
        F.lit("INR").alias("CURRENCY"),
        F.lit("1000000001").alias("CGL"),
        (F.col("id") % 1000 - 500).cast("decimal(25,4)").alias("AMT"),
    )


def test_hot_key_is_summed_whole(spark):
    totals = mov.key_totals(skewed(spark)).filter("GLCC = '00001INR1000000001'").first()
    expected = sum(Decimal(n % 1000 - 500) for n in range(0, 60_000, 3))
    assert totals["CREDIT_AMOUNT"] + totals["DEBIT_AMOUNT"] == expected
    assert totals["TRANSACTION_COUNT"] == 20_000


def test_master_beyond_the_limit_is_joined_without_broadcast(spark, no_automatic_broadcast):
    branches = spark.range(2, 900).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("BRANCH_CODE"))
    (plain,) = broadcast_if_small(branches, limit=100)
    (hinted,) = broadcast_if_small(branches)
    postings = mov.aggregate_movements(skewed(spark), "B")
    large, small_side = val.quarantine_branch(postings, plain), val.quarantine_branch(postings, hinted)
    assert "SortMergeJoin" in physical(large[0]) and "BroadcastHashJoin" in physical(small_side[0])
    for one, other in zip(large, small_side, strict=True):
        assert one.exceptAll(other).isEmpty() and one.count() == other.count() > 0


def test_amounts_are_decoded_once_on_the_way_to_the_balances(small):
    lines = optimized(small.lines()).count("translate(")
    assert optimized(jobs.ledger_day(small).balances).count("translate(") == lines > 0
    assert "Filter" not in optimized(mov.line_totals(small.lines())).split("Aggregate")[1].split("Project")[0]
