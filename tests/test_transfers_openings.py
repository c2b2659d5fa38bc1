"""Profit and loss transfer, and the opening of the next day."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.operators import openings as op
from daybook.operators import transfers as tr
from daybook.plans.next_day import run_next_day
from daybook.plans.transfer_day import pl_transfer, run_pl_transfer
from daybook.sources.lake import read_lake

DAY, YEAR_END = dt.date(2001, 1, 1), dt.date(2001, 3, 31)
BRANCHES = [("00001", 1), ("00002", 1), ("00003", 2), ("00010", 1), ("00020", 2), ("00030", 9)]
CIRCLES = [(1, "00010"), (2, "00020")]
PROFIT = [
    ("00001INR7000000001", 100),
    ("00001USD8000000001", -40),
    ("00002INR7000000001", -40),
    ("00003INR7000000001", 0),
    ("00010INR7000000001", 7),
    ("00030INR7000000001", 11),
    ("99999INR7000000001", 13),
]


@pytest.fixture(scope="module")
def inputs(spark):
    balances = spark.createDataFrame([(k, Decimal(v)) for k, v in PROFIT], "GLCC string, BALANCE decimal(25,4)")
    branches = spark.createDataFrame(BRANCHES, "CODE string, CIRCLE_CODE int")
    return balances, branches, spark.createDataFrame(CIRCLES, "CIRCLE_CODE int, BRANCH_CODE string")


def test_assignment_leaves_circle_branches_out(inputs):
    rows = {(r["BRANCH_CODE"], r["CIRCLE_CODE"]) for r in tr.circle_assignment(*inputs[1:]).collect()}
    assert rows == {("00001", "00010"), ("00002", "00010"), ("00003", "00020"), ("00030", None)}


def test_legs_cancel_out(inputs):
    legs = pl_transfer(*inputs, DAY, 5, 6).postings
    assert legs.count() == 12
    assert legs.filter("DEBIT_AMOUNT < 0 OR CREDIT_AMOUNT > 0").isEmpty()
    net = F.sum(F.col("DEBIT_AMOUNT") + F.col("CREDIT_AMOUNT")).alias("NET")
    for key in ("BRANCH_CODE", "CGL"):
        assert all(r["NET"] == 0 for r in legs.groupBy(key).agg(net).collect())
    first = {(r["BRANCH_CODE"], r["CGL"]): (r["DEBIT_AMOUNT"], r["CREDIT_AMOUNT"]) for r in legs.collect()}
    assert first[("00001", tr.PROFIT_CGL)] == (0, -60) and first[("00001", tr.TRANSFER_CGL)] == (60, 0)
    assert first[("00002", tr.PROFIT_CGL)] == (40, 0) and first[("00002", tr.TRANSFER_CGL)] == (0, -40)
    row = legs.first()
    assert (row["BATCH_ID"], row["JOURNAL_ID"], row["SOURCE_FLAG"], row["TRANSACTION_COUNT"]) == ("5", "6", "T", 1)
    assert {r["NARRATION"] for r in legs.collect()} == {"P and L Transfer - 00010", "P and L Transfer - 00020"}


def test_balances_and_report(spark, inputs, tmp_path):
    result = run_pl_transfer(*inputs, DAY, str(tmp_path))
    balances = {(r["BRANCH_CODE"], r["CGL"]): r["BALANCE"] for r in read_lake(spark, f"{tmp_path}/balances").collect()}
    assert balances[("00010", tr.PROFIT_CGL)] == 60 - 40 + 7 and balances[("00010", tr.TRANSFER_CGL)] == -20
    assert balances[("00001", tr.PROFIT_CGL)] == -60 and balances[("00020", tr.PROFIT_CGL)] == 0
    report = {r["BRANCH_CODE"]: (r["PROFIT_LOSS"], r["CIRCLE_BRANCH_CODE"]) for r in result.report.collect()}
    assert report["00001"] == (-60, "00010") and report["00010"] == (27, "00010")


def test_latest_date_only(spark):
    rows = [("00001", "INR", "7000000001", d, Decimal(n), Decimal(n)) for n, d in enumerate([DAY, YEAR_END], 1)]
    rows.append(("00001", "INR", "1000000001", YEAR_END, Decimal(5), Decimal(5)))
    schema = "BRANCH_CODE string, CURRENCY string, CGL string, BALANCE_DATE date, BALANCE decimal(25,4), INR_BALANCE decimal(25,4)"
    found = tr.latest_income_expense(spark.createDataFrame(rows, schema)).collect()
    assert [(r["GLCC"], r["BALANCE"], r["BALANCE_DATE"]) for r in found] == [("00001INR7000000001", 2, YEAR_END)]


CLOSING = [
    ("7000000001", "USD", "00001", 10, 832),
    ("7000000001", "INR", "00001", 5, 5),
    ("8000000001", "USD", "00001", 1, 83),
    ("8000000001", "USD", "00001", 1, 83),
    ("2110505001", "INR", "00010", 3, 3),
    ("2110505001", "INR", "00001", 4, 4),
    ("1000000001", "USD", "00001", 6, 499),
    ("1000000002", "INR", "00001", 9, 9),
]


@pytest.fixture(scope="module")
def closing(spark):
    rows = [(g, c, b, Decimal(x), Decimal(y)) for g, c, b, x, y in CLOSING]
    return spark.createDataFrame(
        rows, "CGL string, CURRENCY string, BRANCH_CODE string, BALANCE decimal(25,4), INR_BALANCE decimal(25,4)"
    )


@pytest.fixture(scope="module")
def masters(spark):
    forward = [(" 7000000001 ",), ("8000000001",), ("2110505001",), ("1000000001",)]
    return spark.createDataFrame(forward, "CGL string"), spark.createDataFrame([("00010",)], "BRANCH_CODE string")


def calendar(spark, *flags):
    return spark.createDataFrame([(f,) for f in flags], "ACTIVE_FLAG int")


def opened(df):
    return sorted((r["CGL"], r["CURRENCY"], r["BRANCH_CODE"], int(r["BALANCE"]), int(r["INR_BALANCE"])) for r in df.collect())


def test_ordinary_day_only_changes_the_date(spark, closing, masters):
    opening = op.open_next_day(closing, DAY, *masters, calendar(spark))
    assert {r["BALANCE_DATE"] for r in opening.collect()} == {dt.date(2001, 1, 2)}
    assert opened(opening) == sorted(CLOSING)


def test_year_end_rules(spark, closing, masters):
    opening = op.open_next_day(closing, YEAR_END, *masters, calendar(spark, 0, 1))
    assert opened(opening) == sorted(
        [
            ("7000000001", "USD", "00001", 10, 832),
            ("7000000001", "INR", "00001", -832, -832),
            ("8000000001", "USD", "00001", 1, 83),
            ("8000000001", "INR", "00001", -83, -83),
            ("2110505001", "INR", "00010", 3, 3),
            ("1000000001", "USD", "00001", 6, 499),
        ]
    )
    assert {r["BALANCE_DATE"] for r in opening.collect()} == {dt.date(2001, 4, 1)}


def test_inactive_year_opens_nothing(spark, closing, masters):
    opening = op.open_next_day(closing, YEAR_END, *masters, calendar(spark, 0))
    assert opening.isEmpty() and opening.columns == list(op.OPENING_COLUMNS)


def test_opening_is_written_once_per_date(spark, closing, masters, tmp_path):
    lake_table, table = str(tmp_path / "lake"), str(tmp_path / "table")
    for _ in range(2):
        run_next_day(closing, YEAR_END, *masters, calendar(spark, 1), lake_table, table)
    assert read_lake(spark, lake_table).count() == read_lake(spark, table).count() == 6
    assert dict(read_lake(spark, table).dtypes)["INR_BALANCE"] == "decimal(25,4)"
    run_next_day(closing, YEAR_END, *masters, calendar(spark, 0), lake_table, table)
    assert read_lake(spark, lake_table).isEmpty() and read_lake(spark, table).isEmpty()
