"""Movements, validation, balancing, balances and the ledger day."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.operators import balances as bal
from daybook.operators import movements as mov
from daybook.operators import postings as post
from daybook.operators import validation as val
from daybook.plans.ledger_day import LedgerDay, LedgerTables, ledger_balance, run_ledger_day
from daybook.sinks import lake
from daybook.sinks.steps import latest_status
from daybook.sources.lake import read_lake, read_slice
from daybook.sources.masters import load_masters

DAY = dt.date(2001, 1, 1)
LINES = "BRANCH_CODE string, CURRENCY string, CGL string, AMT decimal(25,4)"
CODES = st.tuples(
    st.sampled_from(["00001", "00002", "00009"]),
    st.sampled_from(["INR", "USD", "XXX"]),
    st.sampled_from(["1000000001", "5000000001", "7000000001", "9999999999", "5999999999"]),
    st.integers(-(10**12), 10**12).map(lambda n: Decimal(n).scaleb(-3)),
)


@pytest.fixture(scope="module")
def masters(spark):
    branches = spark.createDataFrame([("00001",), ("00002",), ("00002",)], "CODE string")
    rates = [("INR", Decimal(1)), ("USD", Decimal("83.25"))]
    currencies = spark.createDataFrame(rates, "CURRENCY_CODE string, CURRENCY_RATE decimal(10,4)")
    cgls = [("1000000001", "1"), ("5000000001", "1"), ("7000000001", "1"), ("9999999999", "0")]
    return load_masters(branches, currencies, spark.createDataFrame(cgls, "CGL_NUMBER string, STATUS string"))


def lines(spark, *rows):
    return spark.createDataFrame([(b, c, g, None if a is None else Decimal(a)) for b, c, g, a in rows], LINES)


def total(df):
    return df.agg(F.sum(post.net())).first()[0] or Decimal(0)


def test_sides_of_either_convention(spark):
    df = lines(spark, ("00001", "INR", "1000000001", 5), ("00001", "INR", "1000000001", -3), ("00001", "INR", "1", None))
    credit = {r["CGL"]: r for r in mov.aggregate_movements(df, "B").collect()}
    debit = {r["CGL"]: r for r in mov.aggregate_movements(df, "B", positive_side="DEBIT").collect()}
    row = credit["1000000001"]
    assert (row["CREDIT_AMOUNT"], row["DEBIT_AMOUNT"], row["TRANSACTION_COUNT"]) == (5, -3, 2)
    assert (debit["1000000001"]["DEBIT_AMOUNT"], debit["1000000001"]["CREDIT_AMOUNT"]) == (5, -3)
    assert (credit["1"]["CREDIT_AMOUNT"], credit["1"]["DEBIT_AMOUNT"], credit["1"]["TRANSACTION_COUNT"]) == (0, 0, 1)


def test_lines_without_a_key_form_one_counted_group_of_no_known_branch(spark, masters):
    df = lines(spark, (None, "INR", "1000000001", 5), ("00001", None, "1000000001", 7))
    postings = mov.aggregate_movements(df, "B")
    assert [(r["BRANCH_CODE"], r["TRANSACTION_COUNT"], r["CREDIT_AMOUNT"]) for r in postings.collect()] == [(None, 2, 12)]
    _, invalid = val.validate(postings, masters.branches, masters.currencies, masters.cgls, DAY)
    assert [r["REASON"] for r in invalid.collect()] == ["INVALID BRANCH"]


def test_file_types_are_dropped_whatever_their_case(spark):
    df = spark.createDataFrame([("GLIFPRI_1",), ("glifprb",), ("GLIF",), (None,)], "FILE_NAME string")
    assert [r[0] for r in mov.exclude_file_types(df).collect()] == ["GLIF"]


def test_older_rule_takes_the_currency_of_the_key(spark):
    rows = [("USD", "INR", "0000000000001000q", "00000000000020000")]
    df = spark.createDataFrame(rows, "CURRENCY string, CURRENCY_IND string, FOREIGN_AMOUNT string, AMOUNT string")
    assert mov.ledger_amounts(df).first()["AMT"] == 20
    assert mov.ledger_amounts(df, currency="CURRENCY").first()["AMT"] == Decimal("-10.001")


def test_bad_branch_wins_over_bad_currency_and_bad_account_is_moved(spark, masters):
    df = lines(
        spark,
        ("00009", "XXX", "1000000001", 1),
        ("00001", "XXX", "1000000001", 1),
        ("00001", "INR", "9999999999", 1),
        ("00001", "INR", "5999999999", 1),
        ("00002", "INR", "1000000001", 1),
    )
    postings = mov.aggregate_movements(df, "B")
    valid, invalid = val.validate(postings, masters.branches, masters.currencies, masters.cgls, DAY)
    assert {(r["BRANCH_CODE"], r["REASON"]) for r in invalid.collect()} == {
        ("00009", "INVALID BRANCH"),
        ("00001", "INVALID CURRENCY"),
    }
    assert sorted((r["CGL"], r["NARRATION"]) for r in valid.collect()) == [
        ("1000000001", "CBS txns"),
        ("1111111111", "CBS txns- INVALID-9999999999"),
        ("5000000000", "CBS txns- INVALID-5999999999"),
    ]


@settings(max_examples=6, deadline=None)
@given(st.lists(CODES, min_size=1, max_size=40))
def test_nothing_is_lost_and_every_bucket_balances(spark, masters, rows):
    df = lines(spark, *rows)
    postings = mov.aggregate_movements(df, "B")
    valid, invalid = val.validate(postings, masters.branches, masters.currencies, masters.cgls, DAY)
    assert valid.count() + invalid.count() == postings.count()
    assert total(valid) + total(invalid) == sum(r[3] for r in rows)

    consolidated = post.consolidate(valid)
    separate = consolidated.unionByName(post.balancing_entries(consolidated))
    together = post.balanced_postings(valid)
    names = sorted(separate.columns)

    def content(frame):
        return sorted(map(str, (tuple(r[n] for n in names) for r in frame.collect())))

    assert content(separate) == content(together)
    nets = post.bucket_net(together).select("NET").collect()
    assert all(r["NET"] == 0 for r in nets)


def test_balancing_entry_takes_the_opposite_side(spark, masters):
    df = lines(spark, ("00001", "INR", "1000000001", 5), ("00001", "INR", "5000000001", -4), ("00002", "INR", "7000000001", 0))
    entries = post.balancing_entries(post.consolidate(mov.aggregate_movements(df, "B"))).collect()
    found = {(r["CGL"], r["CREDIT_AMOUNT"], r["DEBIT_AMOUNT"], r["NARRATION"]) for r in entries}
    assert found == {("1111111111", 0, -5, "OUT OF BAL"), ("5000000000", 4, 0, "OUT OF BAL")}


def test_opening_by_run_state():
    assert bal.opening_source(DAY, 1) == ("lake", DAY)
    assert bal.opening_source(DAY, 2) == ("lake", dt.date(2000, 12, 31))
    assert bal.opening_source(dt.date(2001, 4, 1), 3) == ("year_end", dt.date(2001, 4, 1))


def test_carry_forward_adds_up(spark):
    schema = "glcc string, BALANCE decimal(25,4)"
    moves = spark.createDataFrame([("a", Decimal(1)), ("a", Decimal(2)), ("b", Decimal(5))], schema)
    opening = spark.createDataFrame([("a", Decimal(10)), ("c", Decimal(-1))], schema)
    closing = bal.carry_forward(moves, opening, DAY)
    assert {r["glcc"]: r["BALANCE"] for r in closing.collect()} == {"a": 13, "b": 5, "c": -1}
    assert bal.apply_month_end(closing, None, DAY) is closing


def test_conversion_rounds_half_up_and_defaults_to_one(spark, masters):
    keys = {"INR": "00001INR1000000001", "USD": "00001USD1000000001", "EUR": "00001EUR1000000001"}
    rows = [(keys["INR"], Decimal("1.005"), DAY), (keys["USD"], Decimal("-0.0401"), DAY), (keys["EUR"], Decimal("2"), DAY)]
    closing = spark.createDataFrame(rows, "glcc string, BALANCE decimal(25,4), BALANCE_DATE date")
    converted = bal.convert_currency(closing, masters.rates)
    assert {r["CURRENCY"]: r["INR_BALANCE"] for r in converted.collect()} == {
        "INR": Decimal("1.01"),
        "USD": Decimal("-3.34"),
        "EUR": Decimal("2.00"),
    }
    assert dict(converted.dtypes)["INR_BALANCE"] == "decimal(25,2)"


@pytest.fixture
def tables(tmp_path):
    return LedgerTables(*[str(tmp_path / n) for n in ("transactions", "invalid", "balances", "lake", "rejects", "markers", "steps")])


def journal_rows(spark):
    row = ("B0", "J0", "00001", "INR", "1000000001", "manual", Decimal(50), Decimal(0), 1, "J", DAY)
    return spark.createDataFrame(
        [row],
        "BATCH_ID string, JOURNAL_ID string, BRANCH_CODE string, CURRENCY string, CGL string, NARRATION string, "
        "CREDIT_AMOUNT decimal(25,4), DEBIT_AMOUNT decimal(25,4), TRANSACTION_COUNT long, SOURCE_FLAG string, "
        "TRANSACTION_DATE date",
    )


def test_a_day_can_be_rerun(spark, masters, tables, tmp_path):
    """Two runs leave the state of one; journals stay and count towards the balance."""
    lake.overwrite(journal_rows(spark), tables.transactions, ["TRANSACTION_DATE"])
    df = lines(spark, ("00001", "INR", "1000000001", 5), ("00001", "USD", "7000000001", -2), ("00009", "INR", "1000000001", 3))
    opening = spark.createDataFrame([("00001INR1000000001", Decimal(100))], "glcc string, BALANCE decimal(25,4)")
    states = []
    for run_no in (1, 2):
        stored = read_slice(spark, tables.transactions, "TRANSACTION_DATE", DAY)
        run = LedgerDay(DAY, run_no, batch_id="B1", journals=post.carried_journals(stored, DAY))
        run_ledger_day(spark, df, masters, opening, run, tables)
        states.append(
            [
                sorted(map(str, read_lake(spark, path).collect()))
                for path in (tables.transactions, tables.invalid, tables.balances, tables.lake_balances)
            ]
        )
        assert (tmp_path / "markers" / "20010101" / f"Gl_balance_successful_{run_no}_Manifest.txt").exists()
    assert states[0] == states[1]
    balances = {(r["CURRENCY"], r["CGL"]): r["BALANCE"] for r in read_lake(spark, tables.balances).collect()}
    assert balances[("INR", "1000000001")] == 155
    assert balances[("INR", "1111111111")] == -5
    flags = [r["SOURCE_FLAG"] for r in read_lake(spark, tables.transactions).collect()]
    assert sorted(flags) == ["C", "C", "C", "C", "J"]


def test_rules_of_the_caller_add_postings(spark, masters):
    def rule(narration):
        def rows(frame):
            base = frame if "CGL" in frame.columns else None
            key = ("00001", "INR", "7000000001", narration, Decimal(8), Decimal(0), 1, "P")
            schema = (
                "BRANCH_CODE string, CURRENCY string, CGL string, NARRATION string, CREDIT_AMOUNT decimal(25,4), "
                "DEBIT_AMOUNT decimal(25,4), TRANSACTION_COUNT long, SOURCE_FLAG string"
            )
            made = spark.createDataFrame([key], schema)
            assert base is None or base.columns
            return made.withColumn("BATCH_ID", F.lit("B1"))

        return rows

    df = lines(spark, ("00001", "INR", "1000000001", 5))
    opening = spark.createDataFrame([], "glcc string, BALANCE decimal(25,4)")
    rules = {"posting_rule": rule("extra"), "month_end_rule": rule("month end")}
    ordinary = ledger_balance(df, masters, opening, LedgerDay(DAY, batch_id="B1", journal_id="J7", **rules))
    assert ordinary.month_end is None
    assert {r["CGL"]: r["BALANCE"] for r in ordinary.balances.collect()}["7000000001"] == 8
    run = LedgerDay(dt.date(2001, 1, 31), batch_id="B1", journal_id="J7", **rules)
    result = ledger_balance(df, masters, opening, run)
    balances = {r["CGL"]: r["BALANCE"] for r in result.balances.collect()}
    assert balances == {"1000000001": 5, "1111111111": -5, "7000000001": 16}
    assert {r["JOURNAL_ID"] for r in result.transactions.collect()} == {None, "J7"}
    assert [r["JOURNAL_ID"] for r in result.month_end.collect()] == ["J7"]


def test_no_line_is_lost(spark, masters, tables):
    """Lines in are lines counted and lines rejected; a rerun replaces the rejects."""
    rows = lines(spark, *[("00001", "INR", "1000000001", n) for n in range(1, 6)])
    bad = F.col("AMT").isin(2, 4)
    rows = rows.withColumn("AMT", F.when(~bad, F.col("AMT")))
    opening = spark.createDataFrame([], "glcc string, BALANCE decimal(25,4)")
    for run_no in (1, 2):
        run_ledger_day(spark, rows, masters, opening, LedgerDay(DAY, run_no, batch_id="B1"), tables)
    posted = read_lake(spark, tables.transactions).filter("NARRATION <> 'OUT OF BAL'")
    counted = posted.agg(F.sum("TRANSACTION_COUNT")).first()[0]
    rejects = read_lake(spark, tables.rejects)
    assert counted == 3 and rejects.count() == 2 and counted + rejects.count() == rows.count()
    assert {r["REASON"] for r in rejects.collect()} == {"UNDECODABLE AMOUNT"}
    assert latest_status(spark.read.parquet(tables.step_log)).first()["STATUS"] == 2


def test_closing_equals_opening_plus_movements(small):
    """End to end on the given tables: what is not quarantined arrives in the balances, plus balancing entries of 0 net."""
    from workload import ledger_jobs as jobs

    result = jobs.ledger_day(small)
    opening = small("opening_balance").agg(F.sum("BALANCE")).first()[0]
    journals = total(post.carried_journals(small("posted_table"), jobs.DAY))
    closing = result.balances.agg(F.sum("BALANCE")).first()[0]
    assert closing == opening + journals + total(result.transactions)
    assert total(result.transactions) == 0
