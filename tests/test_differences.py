"""Daily difference: comparison, classes, categories, summary."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest

from daybook.operators import differences as diff
from daybook.plans.difference_day import run_daily_difference
from daybook.sources.lake import read_lake

DAY = dt.date(2001, 1, 1)
KEY = "00001INR1000000001"


def side(spark, name, *rows):
    return spark.createDataFrame([(k, None if v is None else Decimal(v)) for k, v in rows], f"GLCC string, {name} decimal(25,4)")


def previous(spark, *rows):
    schema = "GLCC string, YESTERDAY_DIFFERENCE decimal(25,4), FIRST_ERROR_DATE date"
    return spark.createDataFrame([(k, None if v is None else Decimal(v), d) for k, v, d in rows], schema)


def test_one_sided_and_equal_keys(spark):
    gl = side(spark, "GL_BALANCE", ("a", 5), ("b", 3), ("c", 1), ("n", None))
    cbs = side(spark, "CBS_BALANCE", ("a", 5), ("b", 4), ("d", 2), ("n", None))
    rows = {r["GLCC"]: r["today_difference"] for r in diff.balance_difference(gl, cbs).collect()}
    assert rows == {"b": 1, "c": -1, "d": 2}


def test_swapped_sides_change_the_sign(spark, small):
    gl, cbs = small("gl_side"), small("cbs_side")
    forward = diff.balance_difference(gl, cbs).select("GLCC", "today_difference")
    swapped = diff.balance_difference(
        cbs.withColumnRenamed("CBS_BALANCE", "GL_BALANCE"), gl.withColumnRenamed("GL_BALANCE", "CBS_BALANCE")
    ).selectExpr("GLCC", "-today_difference AS today_difference")
    assert forward.exceptAll(swapped).isEmpty() and swapped.exceptAll(forward).isEmpty()
    assert not forward.isEmpty()


@pytest.mark.parametrize(
    "yesterday,expected",
    [
        (None, ("New Entry", Decimal("7"), DAY)),
        (7, ("Zero Difference", Decimal("0"), dt.date(2000, 12, 1))),
        (9, ("Difference Change", Decimal("-2"), dt.date(2000, 12, 1))),
    ],
)
def test_class_of_a_change(spark, yesterday, expected):
    gl, cbs = side(spark, "GL_BALANCE", (KEY, 0)), side(spark, "CBS_BALANCE", (KEY, 7))
    before = [] if yesterday is None else [(KEY, yesterday, dt.date(2000, 12, 1))]
    row = diff.classify_change(diff.balance_difference(gl, cbs), previous(spark, *before), DAY).first()
    assert (row["type"], row["DIFF_BW_YESTERDAY"], row["FIRST_ERROR_DATE"]) == expected
    assert (row["branch_code"], row["currency"], row["cgl"]) == ("00001", "INR", "1000000001")


HEADS = [
    ("01999", "INR", "1204000090", "CAO"),
    ("00001", "INR", "1204000090", "PROVISION"),
    ("00001", "INR", "1204000000", "CASH"),
    ("00001", "INR", "6200000000", "AUCA"),
    ("00001", "INR", "6363000000", "CTA 6363"),
    ("00001", "INR", "4363000000", "CTA 4363"),
    ("00001", "INR", "4000000000", "CTA"),
    ("00001", "INR", "6400000000", "CTA"),
    ("00001", "INR", "7000000000", "I/E"),
    ("00001", "INR", "8000000000", "I/E"),
    ("00001", "INR", "5000000000", "MEMO"),
    ("00001", "USD", "5000000000", "FC MEMO"),
    ("00001", "INR", "2148000000", "BGL"),
    ("00001", "USD", "2148000000", "FC"),
    ("00001", "INR", "2249000000", "INCA"),
    ("00001", "INR", "2111000000", "PPF"),
    ("00001", "INR", "2115000000", "PPF"),
    ("00001", "INR", "2060000000", "PPF"),
    ("03973", "INR", "1106505002", "LHO"),
    ("00001", "INR", "1106505002", "BCGA"),
    ("00001", "INR", "1000505003", "MIGRATION"),
    ("00001", "INR", "1100505001", "LHO"),
    ("00001", "INR", "1300000000", "LOAN"),
    ("00001", "USD", "1300000000", "FC"),
    ("00001", "INR", "3000000000", "DEPOSITS"),
    ("00001", "USD", "3000000000", "FC"),
    ("00001", None, "3000000000", "FC"),
]


def test_categories(spark):
    df = spark.createDataFrame([row[:3] for row in HEADS], "branch_code string, currency string, cgl string")
    found = {(r["branch_code"], r["currency"], r["cgl"]): r["HEAD"] for r in diff.head_category(df).collect()}
    assert found == {row[:3]: row[3] for row in HEADS}


def test_a_day_is_written_once_and_feeds_the_next(spark, tmp_path):
    gl = side(spark, "GL_BALANCE", (KEY, 1), ("00001INR3000000001", 1), ("00001INR9000000001", 1))
    cbs = side(spark, "CBS_BALANCE", (KEY, 2), ("00001INR3000000001", 4), ("00001INR9000000001", 5))
    cgls = spark.createDataFrame([("1000000001",), ("3000000001",)], "CGL string")
    table, lake_table = str(tmp_path / "table"), str(tmp_path / "lake")
    empty = previous(spark)
    for _ in range(2):
        result = run_daily_difference(gl, cbs, empty, cgls, DAY, table, lake_table)
    summary = json.loads(result.summary.first()["summary_json"])
    assert summary["RECON_RUN_DATE"] == "2001-01-01"
    assert summary["summary"] == [
        {"HEAD": "DEPOSITS", "Total_no_of_entries": 1, "new entry": 1},
        {"HEAD": "LOAN", "Total_no_of_entries": 1, "new entry": 1},
    ]
    assert read_lake(spark, table).count() == 2

    next_day = DAY + dt.timedelta(days=1)
    before = diff.previous_differences(read_lake(spark, lake_table), next_day)
    rows = run_daily_difference(gl, cbs, before, cgls, next_day, table, lake_table).differences.collect()
    assert {(r["type"], r["FIRST_ERROR_DATE"]) for r in rows} == {("Zero Difference", DAY)}
    assert read_lake(spark, table).count() == 4
