"""Slices, reports, markers, step log, fallbacks."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from unittest.mock import MagicMock

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from daybook.session import broadcast_if_small, checkpointed, measured_bytes, new_folder, shared_folder
from daybook.sinks import jdbc as jdbc_sink
from daybook.sinks import lake, reports, steps
from daybook.sources import jdbc
from daybook.sources.lake import EMPTY_GL, empty_frame, first_available, latest_partition, read_lake, read_slice

D1, D2, D3 = dt.date(2001, 1, 1), dt.date(2001, 1, 2), dt.date(2001, 1, 3)
SCHEMA = "glcc string, closing_balance decimal(25,4), INR_BALANCE decimal(25,4), BALANCE_DATE date"


def frame(spark, *rows):
    return spark.createDataFrame([(k, None if v is None else Decimal(v), Decimal(v or 0), d) for k, v, d in rows], SCHEMA)


def content(spark, path):
    rows = read_lake(spark, path).select("glcc", "closing_balance", "BALANCE_DATE").collect()
    return sorted((r[0], None if r[1] is None else int(r[1]), r[2]) for r in rows)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    lake.overwrite(frame(spark, ("a", 1, D1), ("b", 2, D1), ("a", 3, D2)), path, ["BALANCE_DATE"])
    return path


def test_replace_leaves_other_dates(spark, table):
    assert lake.replace_slice(frame(spark, ("c", 9, D1)), table, "BALANCE_DATE", D1) == 1
    assert content(spark, table) == [("a", 3, D2), ("c", 9, D1)]


def test_replace_is_idempotent(spark, table):
    for _ in range(2):
        lake.replace_slice(frame(spark, ("c", 9, D3)), table, "BALANCE_DATE", D3)
    assert content(spark, table) == [("a", 1, D1), ("a", 3, D2), ("b", 2, D1), ("c", 9, D3)]


def test_replace_with_nothing_empties_the_date(spark, table):
    assert lake.replace_slice(frame(spark), table, "BALANCE_DATE", D1) == 0
    assert content(spark, table) == [("a", 3, D2)]
    assert read_slice(spark, table, "BALANCE_DATE", D1).isEmpty()


def test_a_row_of_another_date_fails_and_changes_nothing(spark, table):
    before = content(spark, table)
    with pytest.raises(Exception, match="BALANCE_DATE is not"):
        lake.replace_slice(frame(spark, ("c", 9, D1), ("d", 9, D2)), table, "BALANCE_DATE", D1)
    assert content(spark, table) == before


def test_a_slice_can_be_replaced_by_what_is_read_from_it(spark, table):
    rows = read_slice(spark, table, "BALANCE_DATE", D1).filter("glcc = 'b'")
    lake.replace_slice(rows, table, "BALANCE_DATE", D1)
    assert content(spark, table) == [("a", 3, D2), ("b", 2, D1)]


def test_delete_of_a_date(spark, table, tmp_path):
    lake.delete_slice(spark, table, "BALANCE_DATE", D1)
    lake.delete_slice(spark, table, "BALANCE_DATE", D3)
    lake.delete_slice(spark, str(tmp_path / "absent"), "BALANCE_DATE", D1)
    assert content(spark, table) == [("a", 3, D2)]


def test_upsert(spark, table):
    source = frame(spark, ("a", None, D1), ("b", 7, D1), ("c", None, D1))
    values = ["closing_balance", "INR_BALANCE"]
    lake.upsert_slice(source, table, ["glcc"], values, "BALANCE_DATE", D1)
    assert content(spark, table) == [("a", 0, D1), ("a", 3, D2), ("b", 7, D1), ("c", None, D1)]
    lake.upsert_slice(frame(spark, ("z", 4, D1)), table, ["glcc"], values, "BALANCE_DATE", D1)
    assert ("a", 0, D1) in content(spark, table) and ("z", 4, D1) in content(spark, table)


def test_upsert_creates_the_table(spark, tmp_path):
    path = str(tmp_path / "new")
    lake.upsert_slice(frame(spark, ("a", 1, D1)), path, ["glcc"], ["closing_balance", "INR_BALANCE"], "BALANCE_DATE", D1)
    assert content(spark, path) == [("a", 1, D1)]


def test_purge_keeps_journals_and_other_dates(spark, table, tmp_path):
    path = str(tmp_path / "transactions")
    rows = [(flag, day) for flag in ("C", "F", "P", "T", "V", "J", "R", None) for day in (D1, D2)]
    lake.overwrite(spark.createDataFrame(rows, "SOURCE_FLAG string, TRANSACTION_DATE date"), path, ["TRANSACTION_DATE"])
    lake.purge_rerun(spark, D1, path, {table: "BALANCE_DATE", str(tmp_path / "absent"): "BALANCE_DATE"})
    left = {(r[0], r[1]) for r in read_lake(spark, path).select("SOURCE_FLAG", "TRANSACTION_DATE").collect()}
    assert {flag for flag, day in left if day == D1} == {"J", "R", None}
    assert len([1 for _, day in left if day == D2]) == 8
    assert content(spark, table) == [("a", 3, D2)]


def test_overwrite_changes_the_schema_and_append_adds_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.overwrite_files(spark.range(3).withColumnRenamed("id", "a"), path, 2)
    lake.overwrite_files(spark.range(2).withColumnRenamed("id", "b"), path, 1)
    assert read_lake(spark, path).columns == ["b"]
    lake.append(spark.range(2).selectExpr("id as b", "'x' as c"), path)
    merged = read_lake(spark, path, merge_schema=True)
    assert sorted(merged.columns) == ["b", "c"] and merged.filter("c is null").count() == 2


def test_slices_are_pruned_on_read(spark, table):
    plan = read_slice(spark, table, "BALANCE_DATE", D2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(BALANCE_DATE" in plan


def test_first_available_source(spark, tmp_path):
    absent = ("lake", lambda: read_lake(spark, str(tmp_path / "absent")))
    present = ("table", lambda: spark.range(1))
    assert first_available(spark, [absent, present], EMPTY_GL)[1] == "table"
    rows, name = first_available(spark, [absent], EMPTY_GL)
    assert name == "empty" and rows.isEmpty() and rows.dtypes[1] == ("GL_BALANCE", "decimal(25,4)")


def test_no_source_is_an_error_unless_said_otherwise(spark, tmp_path):
    with pytest.raises(LookupError):
        first_available(spark, [("lake", lambda: read_lake(spark, str(tmp_path / "absent"))), ("table", lambda: None)])


def test_a_wrong_driver_surfaces(spark):
    for options in ({"driver": "no.such.Driver"}, {}):
        reader = spark.read.format("jdbc").options(url="jdbc:nosuch:thing", dbtable="t", **options)
        with pytest.raises(Exception, match="no.such.Driver|No suitable driver|suitable"):
            first_available(spark, [("database", reader.load)], EMPTY_GL)


def test_a_slice_of_another_shape_is_refused(spark, table):
    before = sorted(map(str, read_lake(spark, table).collect()))
    rows = read_slice(spark, table, "BALANCE_DATE", D1)
    name = next(c for c, kind in rows.dtypes if c != "BALANCE_DATE")
    with pytest.raises(ValueError, match="the new rows have"):
        lake.replace_slice(rows.withColumn(name, F.lit(True)), table, "BALANCE_DATE", D1)
    with pytest.raises(ValueError, match="no such column"):
        lake.replace_slice(rows.drop(name), table, "BALANCE_DATE", D1)
    assert sorted(map(str, read_lake(spark, table).collect())) == before


def test_latest_partition_comes_from_folder_names(spark, table, tmp_path):
    assert latest_partition(spark, table, "BALANCE_DATE") == max(r[0] for r in read_lake(spark, table).select("BALANCE_DATE").collect())
    assert latest_partition(spark, str(tmp_path / "absent"), "BALANCE_DATE") is None


def test_only_absent_sources_are_passed_over(spark, table):
    wrong_column = ("lake", lambda: read_slice(spark, table, "NO_SUCH_COLUMN", D1))
    with pytest.raises(AnalysisException):
        first_available(spark, [wrong_column], EMPTY_GL)
    with pytest.raises(AnalysisException):
        lake.delete_slice(spark, table, "NO_SUCH_COLUMN", D1)


def test_empty_frame_is_the_identity_of_a_union(spark):
    df = frame(spark, ("a", 1, D1))
    assert df.unionByName(empty_frame(spark, df.schema)).collect() == df.collect()


def test_reports(spark, tmp_path):
    lines = spark.createDataFrame([("one",), ("two",)], "REPORT_LINE string")
    reports.write_text(lines, str(tmp_path / "text"))
    assert len(list((tmp_path / "text").glob("part-*.txt"))) == 1
    reports.write_csv(spark.createDataFrame([("a", 1)], "K string, V int"), str(tmp_path / "csv"), files=1)
    (part,) = (tmp_path / "csv").glob("part-*.csv")
    assert part.read_text() == "K|V\na|1\n"
    marker = reports.write_marker(spark, str(tmp_path), D1, 2)
    assert marker.endswith("/20010101/Gl_balance_successful_2_Manifest.txt")
    assert spark.read.text(marker).first()[0] == "GL_balance successful"


def test_step_log(spark, tmp_path):
    path = str(tmp_path / "steps")
    steps.log_step(spark, path, "7", "read", steps.STARTED)
    steps.log_step(spark, path, "7", "read", steps.SUCCEEDED, "done", payload='{"rows": 1}')
    steps.log_step(spark, path, "7", "write", steps.FAILED, "no space")
    latest = {r["STEP"]: r["STATUS"] for r in steps.latest_status(spark.read.parquet(path)).collect()}
    assert latest == {"read": 2, "write": 3}


CONNECTION = {"url": "jdbc:x", "user": "u", "driver": "d"}


def test_database_reads_use_the_options_of_the_caller():
    """No database may run here, so the reader is a stand-in that records how it is called."""
    options = jdbc.query_options(CONNECTION, "select 1", jdbc.Parallel("id", 0, 10, 4))
    assert options["dbtable"] == "(select 1) t" and options["numPartitions"] == "4" and options["url"] == "jdbc:x"
    session = MagicMock()
    reader = session.read.format.return_value
    jdbc.read_query(session, CONNECTION, "select 1")
    session.read.format.assert_called_with("jdbc")
    assert reader.options.call_args.kwargs["dbtable"] == "(select 1) t"
    where = object()
    jdbc.read_table(session, CONNECTION, "T", ["A", "B"], where)
    assert reader.options.call_args.kwargs["dbtable"] == "T"
    rows = reader.options.return_value.load.return_value
    rows.filter.assert_called_with(where)
    rows.filter.return_value.select.assert_called_with("A", "B")


def test_database_writes_use_the_options_of_the_caller():
    df = MagicMock()
    writer = df.write.format.return_value.options.return_value.option.return_value.option.return_value
    jdbc_sink.append_table(df, CONNECTION, "T")
    df.write.format.return_value.options.assert_called_with(**CONNECTION)
    writer.mode.assert_called_with("append")
    jdbc_sink.overwrite_table(df, CONNECTION, "T")
    writer.mode.assert_called_with("overwrite")
    writer.mode.return_value.option.assert_called_with("truncate", "true")


def test_shared_folder_is_read_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_checkpoint_cuts_the_lineage(spark):
    df = checkpointed(spark.range(100).selectExpr("id % 7 as k").groupBy("k").count())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "parquet" in plan and "Aggregate" not in plan
    assert df.count() == 7


def test_only_measured_frames_are_broadcast(spark):
    small, large = spark.range(10).selectExpr("id as k"), spark.range(10_000).selectExpr("id as k")
    sizes = measured_bytes(small, large)
    assert sizes[0] < 1000 < sizes[1]
    marked, plain = broadcast_if_small(small, large, limit=1000)

    def hint(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hint(marked) and not hint(plain)
