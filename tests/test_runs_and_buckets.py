"""Tables that change together, merges of touched buckets, events of side-by-side jobs, failed steps, ranges of days."""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_files import ledger_line, write_gz

from daybook.operators import differences as diff
from daybook.operators import parse
from daybook.operators.rowcounts import row_count_status
from daybook.plans import difference_day, file_ingest
from daybook.sinks import buckets, control, runs, steps
from workload.ledger_jobs import ACCOUNT_LAYOUTS, LEDGER_LAYOUT

D1, D2 = dt.date(2001, 1, 1), dt.date(2001, 1, 2)


# ---- runs


def rows_of(spark, day, *values):
    return spark.createDataFrame([(v, day) for v in values], "V int, BALANCE_DATE date")


def seen(spark, root, table="t", day=None):
    rows = runs.read_committed(spark, root, table, "BALANCE_DATE", day)
    return None if rows is None else sorted((r["V"], r["BALANCE_DATE"]) for r in rows.collect())


def test_staged_rows_are_seen_after_the_commit_only(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert seen(spark, root) is None
    runs.stage(rows_of(spark, D1, 1, 2), root, "t", "BALANCE_DATE", D1, "R1")
    assert seen(spark, root) is None
    assert runs.commit(spark, root, D1, "R1", ["t"]) == 1
    runs.stage(rows_of(spark, D1, 3), root, "t", "BALANCE_DATE", D1, "R2")
    runs.stage(rows_of(spark, D2, 9), root, "t", "BALANCE_DATE", D2, "R2")
    assert seen(spark, root) == [(1, D1), (2, D1)]
    assert runs.commit(spark, root, D1, "R2", ["t"]) == 2 and runs.commit(spark, root, D2, "R2", ["t"]) == 1
    assert seen(spark, root) == [(3, D1), (9, D2)] and seen(spark, root, day=D2) == [(9, D2)]
    assert runs.clear_superseded(spark, root, "t", "BALANCE_DATE", D1) == ["R1"]
    assert seen(spark, root) == [(3, D1), (9, D2)]


def test_tables_that_a_run_does_not_name_keep_their_rows(spark, tmp_path):
    root = str(tmp_path / "runs")
    for name in ("t", "u"):
        runs.stage(rows_of(spark, D1, 1), root, name, "BALANCE_DATE", D1, "R1")
    runs.commit(spark, root, D1, "R1", ["t", "u"])
    runs.stage(rows_of(spark, D1).limit(0) if False else rows_of(spark, D1, 5).filter("V < 0"), root, "t", "BALANCE_DATE", D1, "R2")
    runs.commit(spark, root, D1, "R2", ["t"])
    assert seen(spark, root, "t") == [] and seen(spark, root, "u") == [(1, D1)]


def test_a_row_of_another_date_is_not_staged(spark, tmp_path):
    with pytest.raises(Exception, match="BALANCE_DATE is not"):
        runs.stage(rows_of(spark, D2, 1), str(tmp_path / "runs"), "t", "BALANCE_DATE", D1, "R1")


# ---- buckets


def files_of(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.startswith("part-")}


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "buckets")
    rows = spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("decimal(25,4)").alias("v"))
    buckets.write_buckets(rows, path, ["k"], "DAY", D1, 16)
    buckets.write_buckets(rows.limit(5), path, ["k"], "DAY", D2, 16)
    return path


CHANGES = [("k1", Decimal(7)), ("k2", None), ("new", Decimal(8)), ("k1x", None)]


def test_merge_leaves_untouched_files_alone(spark, table):
    before = files_of(table)
    source = spark.createDataFrame(CHANGES, "k string, v decimal(25,4)")
    touched = buckets.upsert_buckets(source, table, ["k"], ["v"], "DAY", D1, 16)
    assert 0 < len(touched) <= 4
    kept = {f for f in before if not any(f"DAY={D1}/bucket={n}/" in f for n in touched)}
    assert kept <= files_of(table) and len(kept) >= 12
    found = {r["k"]: r["v"] for r in buckets.read_buckets(spark, table, "DAY", D1).collect()}
    assert len(found) == 402 and found["k1"] == 7 and found["k2"] == 0 and found["new"] == 8 and found["k1x"] is None
    assert found["k3"] == 3 and buckets.read_buckets(spark, table, "DAY", D2).count() == 5


def test_small_and_large_sources_merge_alike(spark, table):
    target = buckets.read_buckets(spark, table, "DAY", D1).select("k", "v")
    source = spark.createDataFrame(CHANGES, "k string, v decimal(25,4)")
    small, large = (buckets.merged_buckets(target, source, ["k"], ["v"], limit) for limit in (1 << 20, 0))
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)


def test_the_slice_is_not_exchanged_for_a_small_source(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = buckets.read_buckets(spark, table, "DAY", D1).select("k", "v")
        source = spark.createDataFrame(CHANGES, "k string, v decimal(25,4)")
        plan = buckets.merged_buckets(target, source, ["k"], ["v"]).filter("v IS NOT NULL")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    kept = plan.split("Union")[1].split("SortMergeJoin")[0]
    assert "BroadcastHashJoin" in kept and "Exchange hashpartitioning" not in kept


def test_merge_into_nothing_and_of_nothing(spark, tmp_path):
    path = str(tmp_path / "fresh")
    source = spark.createDataFrame(CHANGES, "k string, v decimal(25,4)")
    assert buckets.upsert_buckets(source.limit(0), path, ["k"], ["v"], "DAY", D1, 4) == []
    assert buckets.read_buckets(spark, path, "DAY", D1) is None
    buckets.upsert_buckets(source, path, ["k"], ["v"], "DAY", D1, 4)
    assert buckets.read_buckets(spark, path, "DAY", D1).count() == 4


# ---- control rows and steps


def test_interleaved_jobs_keep_each_others_status(spark, tmp_path):
    events = str(tmp_path / "events")
    blank = "cast(null as bigint) DATA_LAKE_COUNT", "cast(null as string) DATA_LAKE_STATUS"
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "FILE_NAME string, HDFS_ROW_COUNT long").selectExpr("*", *blank)
    assert control.current_control(rows, events, D1).filter("DATA_LAKE_STATUS IS NOT NULL").isEmpty()
    counts = spark.createDataFrame([("a", 1), ("b", 2), ("c", 9)], "FILE_NAME string, ROW_COUNT long")
    one = row_count_status(rows.filter("FILE_NAME = 'a'"), counts.filter("FILE_NAME = 'a'"))
    two = row_count_status(rows.filter("FILE_NAME <> 'a'"), counts.filter("FILE_NAME <> 'a'"))
    control.append_status(two, events, D1, "J2")
    control.append_status(one, events, D1, "J1")
    control.append_status(one, events, D2, "J1")
    found = {r["FILE_NAME"]: (r["DATA_LAKE_COUNT"], r["DATA_LAKE_STATUS"]) for r in control.current_control(rows, events, D1).collect()}
    assert found == {"a": (1, "YES"), "b": (2, "YES"), "c": (None, None)}


def test_a_failing_step_is_logged_and_raises(spark, tmp_path):
    path = str(tmp_path / "log")
    with pytest.raises(KeyError), steps.logged_step(spark, path, "R", "bad"):
        raise KeyError("line one\nline two")
    with steps.logged_step(spark, path, "R", "good") as state:
        state.message, state.payload = "done", "{}"
    with steps.logged_step(spark, None, "R", "not logged"):
        pass
    rows = {(r["STEP"], r["STATUS"]): r for r in spark.read.parquet(path).collect()}
    assert set(rows) == {("bad", 1), ("bad", 3), ("good", 1), ("good", 2)}
    told = json.loads(rows["bad", 3]["PAYLOAD"])
    assert told["error"] == "KeyError" and "line two" in told["message"] and "\n" not in rows["bad", 3]["MESSAGE"]
    assert rows["good", 2]["MESSAGE"] == "done"


# ---- ingest


def test_every_line_is_stored_or_rejected(spark, tmp_path):
    folder = tmp_path / "in"
    good, bad_amount = ledger_line("12", "USD", "1000q", "5000"), ledger_line("13", "USD", "1000?", "5000")
    bad_date = good[:54] + "xxxxxx" + good[60:]
    write_gz(folder / "a" / "F_01012026_A_001.gz", [good, bad_amount, bad_date, "short", ""])
    announced = spark.createDataFrame([("F_01012026_A_001", 5)], "FILE_NAME string, HDFS_ROW_COUNT long")
    table, report = str(tmp_path / "table"), str(tmp_path / "reports")
    for _ in range(2):
        done = file_ingest.run_ledger_ingest(spark, announced, str(folder), LEDGER_LAYOUT, table, report, lower_stream=True, parse=parse.judged_ledger_rows)
    assert tuple(done.outcomes.first()) == ("F_01012026_A_001", 5, 1, 4)
    assert [(r["ACCOUNT"], r["AMOUNT"]) for r in done.rows.collect()] == [("12", Decimal("-10.001"))]
    assert set(done.rows.columns).isdisjoint(parse.JUDGED_COLUMNS)
    lost = {r["RAW_LINE"]: r["REASON"] for r in done.rejects.collect()}
    assert lost == {bad_amount: "FCY_AMT,AMOUNT", bad_date: "POST_DATE", "short": "AMOUNT", "": "AMOUNT"}
    assert done.status.first()["DATA_LAKE_STATUS"] == "YES"


def test_account_files_of_all_types(spark, tmp_path):
    folder, line = tmp_path / "in", "00000000000000012" + "0000000000012.50-" + "0000000000001.00+" + "0000012345" + "00000678"
    write_gz(folder / "a" / "INV_01012026_A_001.gz", [line, line.replace("12.50-", "12.5x-")])
    write_gz(folder / "b" / "GLCCGEN_01012026_B_001.gz", [line])
    names = [("INV_01012026_A_001", 2), ("GLCCGEN_01012026_B_001", 1), ("BOR_01012026_A_001", 1), ("ODD_01012026_A_001", 1)]
    announced = spark.createDataFrame(names, "FILE_NAME string, HDFS_ROW_COUNT long")
    events, log = str(tmp_path / "events"), str(tmp_path / "log")
    update = file_ingest.Control("", "", D1, log, "R", events)
    arguments = (str(folder), ACCOUNT_LAYOUTS, str(tmp_path / "t"), str(tmp_path / "r"))
    done = file_ingest.run_account_files(spark, announced, *arguments, update=update)
    assert {tuple(r) for r in done.outcomes.collect()} == {("INV", "INV_01012026_A_001", 2, 1, 1), ("GLCCGEN", "GLCCGEN_01012026_B_001", 1, 1, 0)}
    assert {(r["FILE_TYPE"], r["ACCOUNT"], r["BALANCE"], r["AMOUNT"]) for r in done.rows.collect()} == {
        ("INV", "12", Decimal("-12.5"), None), ("GLCCGEN", "NA", None, Decimal("-12.5")),
    }
    assert done.rejects.first()["REASON"] == "BALANCE"
    found = {r["FILE_TYPE"]: (r["ANNOUNCED"], r["FOUND"]) for r in file_ingest.type_presence(announced, done.outcomes, list(ACCOUNT_LAYOUTS)).collect()}
    assert found == {"INV": (1, 1), "BOR": (1, 0), "GLCCGEN": (1, 1), "GLCCCTA": (0, 0), "GLCCINV": (0, 0)}
    assert control.status_events(spark, events, D1).count() == 2
    only = announced.filter("FILE_NAME LIKE 'BOR%'")
    with pytest.raises(file_ingest.NothingToIngest):
        file_ingest.run_account_files(spark, only, *arguments, update=update)
    assert {r["STATUS"] for r in spark.read.parquet(log).collect()} == {1, 2, 3}
    assert done.rows.count() == 2


# ---- ranges of days


def test_a_range_of_days_equals_single_days(spark):
    days = [D1 + dt.timedelta(days=n) for n in range(5)]
    key = "00001INR100000000{}"
    differs = {0: "11111", 1: "11011", 2: "01010", 3: "00000", 4: "10001", 5: "11100"}
    rows = [(key.format(k), Decimal(10), Decimal(10 + k * int(c) + (n == 4) * int(c)), day) for k, flags in differs.items() for n, (c, day) in enumerate(zip(flags, days))]
    both = spark.createDataFrame(rows, "GLCC string, GL_BALANCE decimal(25,4), CBS_BALANCE decimal(25,4), BALANCE_DATE date")
    since = dt.date(2000, 12, 1)
    previous = spark.createDataFrame(
        [(key.format(1), Decimal(1), since), (key.format(3), Decimal(2), since), (key.format(4), Decimal(4), None)],
        "GLCC string, YESTERDAY_DIFFERENCE decimal(25,4), FIRST_ERROR_DATE date",
    )
    got = diff.classify_changes(diff.balance_differences_by_day(both, both), previous, D1)
    before, expected = previous, None
    for day in days:
        of_day = both.filter(F.col("BALANCE_DATE") == F.lit(day))
        today = diff.classify_change(diff.balance_difference(of_day, of_day), before, day)
        expected = today if expected is None else expected.unionByName(today)
        before = today.select(
            F.concat("branch_code", "currency", "cgl").alias("GLCC"), F.col("DIFFERENCE_AMOUNT").alias("YESTERDAY_DIFFERENCE"), "FIRST_ERROR_DATE"
        )
    columns = list(diff.DIFFERENCE_COLUMNS)
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(map(tuple, expected.select(columns).collect()), key=repr)
    compared = spark.createDataFrame([(f"100000000{k}",) for k in range(6)], "CGL string")
    assert difference_day.differences_of_days(both, both, previous, compared, days[1], days[2]).filter("RECON_RUN_DATE > '2001-01-03'").isEmpty()
