"""Text files, layouts and the ingest jobs, on files with real names."""

from __future__ import annotations

import datetime as dt
import gzip
from decimal import Decimal

import pytest

from daybook.functions.text import STRICT_FILE_PATTERN
from daybook.operators import parse
from daybook.operators.parse import Field
from daybook.plans.file_ingest import NothingToIngest, days_between, run_account_ingest, run_ledger_ingest
from daybook.sources import text_files as tf
from daybook.sources.lake import read_lake
from workload.ledger_jobs import ACCOUNT_LAYOUTS, LEDGER_LAYOUT


def write_gz(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.writelines(line + "\n" for line in lines)


def test_lines_know_their_file(spark, tmp_path):
    write_gz(tmp_path / "a" / "F_01012026_A_001.gz", ["x", "y"])
    write_gz(tmp_path / "b" / "F_01012026_B_001.gz", ["z"])
    paths = [str(p) for p in tmp_path.glob("*/*.gz")]
    rows = {(r["value"], r["FILE_NAME"]) for r in tf.read_lines(spark, paths).collect()}
    assert rows == {("x", "F_01012026_A_001"), ("y", "F_01012026_A_001"), ("z", "F_01012026_B_001")}
    assert tf.read_lines(spark, paths, partitions=5).rdd.getNumPartitions() == 5


def test_control_table_names_the_paths(spark):
    rows = [("F_01012026_A_001", "01-JAN-26", "GLIF", 2), ("odd", "01-JAN-26", "GLIF", 2), ("G_01012026_B", "x", "CBS", 1)]
    control = spark.createDataFrame(rows, "FILE_NAME string, ETL_DATE string, FILE_TYPE string, HDFS_ROW_COUNT long")
    of_day = tf.control_slice(control, "01-JAN-26", "GLIF")
    assert tf.path_list(tf.control_paths(of_day, "/in")) == ["/in/a/F_01012026_A_001.gz"]
    assert tf.path_list(tf.control_paths(of_day, "/in", lower_stream=False)) == ["/in/A/F_01012026_A_001.gz"]
    assert tf.path_list(tf.control_paths(control.filter("ETL_DATE = 'x'"), "/in", STRICT_FILE_PATTERN)) == []
    assert tf.control_slice(control, "x", "CBS", "G_").count() == 1
    assert tf.control_slice(control, "x", "CBS", "F_").count() == 0


def test_presence_splits_expected_paths(spark, tmp_path):
    write_gz(tmp_path / "a" / "one.gz", ["x"])
    for folder in (str(tmp_path), f"{tmp_path}/", f"file://{tmp_path}"):
        base = tf.qualified(spark, folder)
        expected = spark.createDataFrame([(f"{base}/a/one.gz",), (f"{base}/a/two.gz",)], "PATH string")
        found, missing = tf.split_by_presence(expected, tf.files_below(spark, folder))
        assert tf.path_list(found) == [f"{base}/a/one.gz"]
        assert tf.path_list(missing) == [f"{base}/a/two.gz"]


LINE_LAYOUT = (Field("BRANCH_CODE", 1, 4), Field("FCY_CODE", 4, 7), Field("FCY_AMT", 7, 10), Field("LCY_AMT", 10, 13),
               Field("POST_DATE", 13, 16), Field("TRANS_DATE", 16, 19), Field("POST_TIME", 19, 22), Field("ACCOUNT", 22, 25))


def test_ledger_ingest_of_any_form_of_folder(spark, tmp_path):
    """The day is read from a URI or with a slash at its end; when nothing is there the table stays as it is."""
    write_gz(tmp_path / "in" / "A" / "GLIFCOR_01012026_A_001.gz", ["001INR10q00200100100100100", "002USD20030p001001001002"])
    control = spark.createDataFrame(
        [("GLIFCOR_01012026_A_001", 2), ("GLIFCOR_01012026_B_001", 5)], "FILE_NAME string, HDFS_ROW_COUNT long"
    )
    table, report = str(tmp_path / "table"), str(tmp_path / "report")
    for folder in (f"file://{tmp_path}/in", f"{tmp_path}/in/", f"{tmp_path}/in"):
        result = run_ledger_ingest(spark, control, folder, LINE_LAYOUT, table, report)
        assert result.rows.count() == 2
        assert {r["FILE_NAME"]: r["DATA_LAKE_STATUS"] for r in result.status.collect()} == {
            "GLIFCOR_01012026_A_001": "YES", "GLIFCOR_01012026_B_001": None,
        }
    assert (tmp_path / "report" / "MissingPath_1_RowDiffCount_1_TotalRows_2.txt").exists()
    (tmp_path / "empty").mkdir()
    with pytest.raises(NothingToIngest):
        run_ledger_ingest(spark, control, f"{tmp_path}/empty", LINE_LAYOUT, table, report)
    assert spark.read.parquet(table).count() == 2


def test_globs_of_a_day(spark, tmp_path):
    for name in ("COR_01012026_A_001", "COR_01012026_A_01", "COR_02012026_A_001", "OTH_01012026_A", "OTH_01012026_1"):
        write_gz(tmp_path / f"{name}.gz", [name])
    globs = tf.day_globs(str(tmp_path), dt.date(2026, 1, 1), ["COR"], ["OTH"])
    assert sorted(r[0] for r in tf.read_lines(spark, globs).select("value").collect()) == [
        "COR_01012026_A_001",
        "OTH_01012026_A",
    ]


LAYOUT_ROWS = [
    {"COLUMNNAME": "CODE", "STARTVALUE": "1", "ENDVALUE": "4", "TOBEINCLUDED": "YES", "DATATYPE": "TEXT"},
    {"COLUMNNAME": "AMT", "STARTVALUE": "4", "ENDVALUE": "9", "TOBEINCLUDED": "yes", "DATATYPE": "AMOUNT"},
    {"COLUMNNAME": "SKIP", "STARTVALUE": "9", "ENDVALUE": "12", "TOBEINCLUDED": "no", "DATATYPE": "TEXT"},
]


def test_layout_rows_of_either_table(spark):
    fields = parse.layout_fields(LAYOUT_ROWS)
    assert [f.name for f in fields] == ["CODE", "AMT"]
    rows = spark.createDataFrame([("A", 1, 3, "Yes")], "COLUMN_NAME string, START_POSITION int, END_POSITION int, "
                                 "TO_BE_INCLUDED string").collect()
    assert parse.layout_fields(rows) == [parse.Field("A", 1, 3)]


@pytest.mark.parametrize(
    "line,expected",
    [
        ("abc1234q  x", ("abc", "1234q")),
        ("ab", ("ab", "")),
        ("", ("", "")),
        (" a   12  ", ("a", "12")),
        ("äöü9999p", ("äöü", "9999p")),
    ],
)
def test_fixed_width_lines(spark, line, expected):
    df = spark.createDataFrame([(line,)], "value string")
    assert tuple(parse.parse_fixed_width(df, parse.layout_fields(LAYOUT_ROWS)).first()) == expected


def test_unsigned_variant(spark):
    fields = parse.layout_fields(LAYOUT_ROWS)
    df = parse.parse_fixed_width(spark.createDataFrame([("abc1234q",)], "value string"), fields)
    assert tuple(parse.unsigned_amounts(df, fields).first()) == ("abc", "12341")


def ledger_line(account, currency, foreign, local):
    return f"{account:>017}{currency}{foreign:>017}{local:>017}04600004600145296789000011234567890"


def test_ledger_ingest_end_to_end(spark, tmp_path):
    folder = tmp_path / "in"
    write_gz(folder / "A" / "F_01012026_A_001.gz", [ledger_line("12", "USD", "1000q", "5000"), "short"])
    write_gz(folder / "B" / "F_01012026_B_001.gz", [ledger_line("0", "INR", "1", "500p")])
    counts = [("F_01012026_A_001", 2), ("F_01012026_B_001", 5), ("F_01012026_C_001", 1)]
    control = spark.createDataFrame(counts, "FILE_NAME string, HDFS_ROW_COUNT long")
    table, reports = str(tmp_path / "table"), tmp_path / "reports"
    result = run_ledger_ingest(spark, control, str(folder), LEDGER_LAYOUT, table, str(reports))

    rows = {r["ACCOUNT"]: r for r in read_lake(spark, table).collect()}
    assert rows["12"]["AMOUNT"] == Decimal("-10.001") and rows["12"]["LCY_AMT"] == Decimal("5")
    assert rows[""]["AMOUNT"] == Decimal("-5") and rows[""]["POST_TIME"] == "2025-12-10 12:34:56"
    assert rows["short"]["AMOUNT"] is None and rows["short"]["POST_DATE"] is None
    assert rows["12"]["TRANS_DATE"] == dt.date(2025, 12, 11)

    status = {r["FILE_NAME"]: r["DATA_LAKE_STATUS"] for r in result.status.collect()}
    assert status == {"F_01012026_A_001": "YES", "F_01012026_B_001": None, "F_01012026_C_001": None}
    report = spark.read.text(str(reports / "MissingPath_1_RowDiffCount_2_TotalRows_3.txt")).collect()
    assert len(report) == 3 and report[0][0].endswith("/C/F_01012026_C_001.gz")
    lines = {r[0] for r in spark.read.text(str(reports / "row_counts")).collect()}
    assert "FILE_NAME=F_01012026_C_001 | CONTROL_COUNT=1 | ACTUAL_COUNT=NULL | DIFFERENCE=NULL" in lines


def test_account_ingest_end_to_end(spark, tmp_path):
    folder = tmp_path / "in"
    line = "00000000000000012" + "0000000000012.50-" + "0000000000001.00+" + "0000012345" + "00000678"
    write_gz(folder / "a" / "INV_01012026_A_001.gz", [line])
    control = spark.createDataFrame([("INV_01012026_A_001",)], "FILE_NAME string")
    table = str(tmp_path / "inv")
    assert run_account_ingest(spark, control, str(folder), ACCOUNT_LAYOUTS["INV"], "INV", table)
    assert tuple(read_lake(spark, table).first()) == ("12", Decimal("-12.5"), Decimal("1"), "2345", "78")
    assert not run_account_ingest(spark, control, str(folder), ACCOUNT_LAYOUTS["BOR"], "BOR", table)


def test_summary_types_have_no_account_and_keep_components(spark):
    layout = [parse.Field("ACCOUNT", 1, 4), parse.Field("AMOUNT", 4, 8), parse.Field("CGL_COMP_1_DR", 8, 14)]
    df = spark.createDataFrame([("0121.5-123456",)], "value string")
    assert tuple(parse.account_rows(df, layout, "GLCCGEN").first()) == ("NA", Decimal("-1.5"), "123456")
    assert tuple(parse.account_rows(df, layout, "GLCCINV").first()) == ("12", Decimal("-1.5"), "123456")


def test_rejected_amounts(spark):
    df = spark.createDataFrame([("x", None), (None, None), ("1", Decimal(1))], "RAW string, AMT decimal(25,4)")
    assert [r["RAW"] for r in parse.rejected_amounts(df, "RAW", "AMT").collect()] == ["x"]


def test_days_of_a_catch_up_run():
    assert days_between(dt.date(2024, 2, 28), dt.date(2024, 3, 1)) == [
        dt.date(2024, 2, 28),
        dt.date(2024, 2, 29),
        dt.date(2024, 3, 1),
    ]
