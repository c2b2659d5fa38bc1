"""Queries for sources and sinks. Sinks write into a new folder below the shared one and read the result back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.text import STRICT_FILE_PATTERN
from daybook.operators import balances as bal
from daybook.operators import rowcounts as rc
from daybook.operators import transfers as tr
from daybook.session import new_folder
from daybook.sinks import lake, reports, steps
from daybook.sources import lake as lake_source
from daybook.sources import text_files as tf
from workload.fixtures import DAY, KEY, MONEY, POSTING, ZERO
from workload.registry import Inputs, query

EARLIER = DAY - dt.timedelta(days=1)


def stored(i: Inputs, name: str, column: str) -> str:
    """An input view written as a table partitioned by its date column."""
    path = new_folder(i.spark, name)
    lake.overwrite(i(name), path, [column])
    return path


def counted_lines(i: Inputs) -> DataFrame:
    return rc.file_row_counts(i("ledger_raw"))


@query("select value, FILE_NAME from ledger_text")
def text_multi_scan_src01(i: Inputs) -> DataFrame:
    path = new_folder(i.spark, "text")
    i("ledger_text").write.partitionBy("FILE_NAME").option("compression", "gzip").text(path)
    folders = [f"{path}/FILE_NAME={row[0]}" for row in i("ledger_text").select("FILE_NAME").distinct().collect()]
    lines = tf.read_lines(i.spark, folders)
    return lines.select("value", F.regexp_extract("SOURCE_PATH", "FILE_NAME=([^/]+)/", 1).alias("FILE_NAME"))


@query("""
    select FILE_NAME, lower(regexp_extract(FILE_NAME, '^(.*?)(\\d{8})_([a-zA-Z])_.*$', 3)) STREAM,
      concat('/in/01-01-2026/GLIF/', lower(regexp_extract(FILE_NAME, '^(.*?)(\\d{8})_([a-zA-Z])_.*$', 3)), '/',
        FILE_NAME, '.gz') PATH
    from control_file where regexp_matches(FILE_NAME, '^(.*?)(\\d{8})_([a-zA-Z])_.*$')""")
def control_paths_src03(i: Inputs) -> DataFrame:
    return tf.control_paths(i("control_file"), "/in/01-01-2026/GLIF", STRICT_FILE_PATTERN)


@query("""
    select distinct FILE_NAME, substring(FILE_NAME,18,1) STREAM,
      concat('/in/', substring(FILE_NAME,18,1), '/', FILE_NAME, '.gz') PATH from control_table""")
def control_paths_direct_src04(i: Inputs) -> DataFrame:
    control = i("control_table").withColumn("STREAM", F.substring("FILE_NAME", 18, 1))
    return tf.control_paths_direct(control, "/in")


@query("select glcc, closing_balance BALANCE from lake_balance where BALANCE_DATE = date '2001-01-01'")
def lake_slice_scan_src08(i: Inputs) -> DataFrame:
    table = lake_source.read_lake(i.spark, stored(i, "lake_balance", "BALANCE_DATE"))
    return bal.lake_opening(table, DAY)


@query("select * from o_profit_source")
def latest_slice_scan_src09(i: Inputs) -> DataFrame:
    path = stored(i, "balance_table", "BALANCE_DATE")
    latest = lake_source.latest_partition(i.spark, path, "BALANCE_DATE")
    return tr.latest_income_expense(lake_source.read_lake(i.spark, path), latest)


@query(f"""
    select glcc, closing_balance BALANCE, 'first' STATE from lake_balance where BALANCE_DATE = date '2001-01-01'
    union all select glcc, closing_balance, 'rerun' from lake_balance where BALANCE_DATE = date '2000-12-31'
    union all select {KEY}, BALANCE, 'year start' from year_end_balance where BALANCE_DATE = date '2001-04-01'""")
def opening_select_src11(i: Inputs) -> DataFrame:
    states = [("first", DAY, 1), ("rerun", DAY, 2), ("year start", dt.date(2001, 4, 1), 1)]
    parts = [
        bal.select_opening(i("lake_balance"), i("year_end_balance"), day, run).withColumn("STATE", F.lit(state))
        for state, day, run in states
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
    select distinct 'branch' MASTER, CODE CODE, cast(null as decimal(10,4)) RATE from branch_master
    union all select distinct 'currency', CURRENCY_CODE, null from currency_master
    union all select CURRENCY_CODE_KIND, CURRENCY_CODE, RATE from (
      select 'rate' CURRENCY_CODE_KIND, CURRENCY_CODE, max(CURRENCY_RATE) RATE from currency_master group by 1, 2) t
    union all select distinct 'cgl', CGL_NUMBER, null from cgl_master where STATUS = '1'""")
def load_masters_src12(i: Inputs) -> DataFrame:
    masters = i.masters()
    no_rate = F.lit(None).cast("decimal(10,4)").alias("RATE")

    def listed(kind: str, df: DataFrame, code: str, rate=no_rate) -> DataFrame:
        return df.select(F.lit(kind).alias("MASTER"), F.col(code).alias("CODE"), rate)

    return (
        listed("branch", masters.branches, "BRANCH_CODE")
        .unionByName(listed("currency", masters.currencies, "CURRENCY"))
        .unionByName(listed("rate", masters.rates, "CURRENCY_CODE", F.col("CURRENCY_RATE").alias("RATE")))
        .unionByName(listed("cgl", masters.cgls, "CGL"))
    )


@query("select glcc, BALANCE from opening_balance")
def empty_typed_src13(i: Inputs) -> DataFrame:
    return i("opening_balance").unionByName(lake_source.empty_frame(i.spark, lake_source.EMPTY_OPENING))


@query("select CGL, CURRENCY, BRANCH_CODE, BALANCE, INR_BALANCE from closing_balance")
def lake_overwrite_snk01(i: Inputs) -> DataFrame:
    path = new_folder(i.spark, "closing")
    lake.overwrite(i("gl_side"), path)
    lake.overwrite(i("closing_balance"), path)
    return lake_source.read_lake(i.spark, path)


@query("select glcc, BALANCE from opening_balance")
def lake_overwrite_schema_snk02(i: Inputs) -> DataFrame:
    path = new_folder(i.spark, "opening")
    lake.overwrite_files(i("closing_balance"), path, 100_000)
    lake.overwrite_files(i("opening_balance"), path, 100_000)
    return lake_source.read_lake(i.spark, path)


@query("select GLCC, GL_BALANCE BALANCE from gl_side union all select GLCC, CBS_BALANCE from cbs_side")
def lake_append_snk03(i: Inputs) -> DataFrame:
    path = new_folder(i.spark, "sides")
    lake.append(i("gl_side").select("GLCC", F.col("GL_BALANCE").alias("BALANCE")), path)
    lake.append(i("cbs_side").select("GLCC", F.col("CBS_BALANCE").alias("BALANCE")), path)
    return lake_source.read_lake(i.spark, path)


@query(f"""
    select GLCC, GL_BALANCE, cast(null as {MONEY}) CBS_BALANCE from gl_side
    union all select GLCC, cast(null as {MONEY}), CBS_BALANCE from cbs_side""")
def lake_append_merge_schema_snk04(i: Inputs) -> DataFrame:
    path = new_folder(i.spark, "merged")
    lake.append(i("gl_side"), path)
    lake.append(i("cbs_side"), path)
    return lake_source.read_lake(i.spark, path, merge_schema=True)


@query(f"""
    select glcc, closing_balance, INR_BALANCE, BALANCE_DATE from lake_balance where BALANCE_DATE = date '2000-12-31'
    union all select {KEY}, BALANCE, INR_BALANCE, date '2001-01-01' from closing_balance""")
def lake_replace_slice_snk05(i: Inputs) -> DataFrame:
    path = stored(i, "lake_balance", "BALANCE_DATE")
    closing = i("closing_balance").withColumn("BALANCE_DATE", F.lit(DAY))
    lake.replace_slice(bal.lake_balances(closing), path, "BALANCE_DATE", DAY)
    return lake_source.read_lake(i.spark, path)


@query("select * from lake_balance where BALANCE_DATE <> date '2001-01-01'")
def lake_delete_slice_snk06(i: Inputs) -> DataFrame:
    path = stored(i, "lake_balance", "BALANCE_DATE")
    lake.delete_slice(i.spark, path, "BALANCE_DATE", DAY)
    return lake_source.read_lake(i.spark, path)


@query(f"""
    select * from lake_balance where BALANCE_DATE = date '2000-12-31' union all
    select coalesce(s.GLCC, t.glcc) glcc,
      case when s.GLCC is not null and t.glcc is not null then coalesce(s.CBS_BALANCE, {ZERO})
        when s.GLCC is not null then s.CBS_BALANCE else t.closing_balance end closing_balance,
      case when s.GLCC is not null and t.glcc is not null then {ZERO}
        when s.GLCC is not null then cast(null as {MONEY}) else t.INR_BALANCE end INR_BALANCE,
      date '2001-01-01' BALANCE_DATE
    from (select * from lake_balance where BALANCE_DATE = date '2001-01-01') t
    full join cbs_side s on s.GLCC = t.glcc""")
def lake_upsert_snk07(i: Inputs) -> DataFrame:
    path = stored(i, "lake_balance", "BALANCE_DATE")
    source = i("cbs_side").select(
        F.col("GLCC").alias("glcc"),
        F.col("CBS_BALANCE").alias("closing_balance"),
        F.lit(None).cast(MONEY).alias("INR_BALANCE"),
        F.lit(DAY).alias("BALANCE_DATE"),
    )
    lake.upsert_slice(source, path, ["glcc"], ["closing_balance", "INR_BALANCE"], "BALANCE_DATE", DAY)
    return lake_source.read_lake(i.spark, path)


@query(f"""
    select 'transactions' KIND, {KEY} glcc, SOURCE_FLAG, TRANSACTION_DATE SLICE from posted_table
    where not (TRANSACTION_DATE = date '2001-01-01' and SOURCE_FLAG in ('C','F','P','T','V'))
    union all select 'balances', glcc, null, BALANCE_DATE from lake_balance
    where BALANCE_DATE <> date '2001-01-01'""")
def rerun_purge_snk10(i: Inputs) -> DataFrame:
    transactions = stored(i, "posted_table", "TRANSACTION_DATE")
    balances = stored(i, "lake_balance", "BALANCE_DATE")
    lake.purge_rerun(i.spark, DAY, transactions, {balances: "BALANCE_DATE"})
    posted = lake_source.read_lake(i.spark, transactions).select(
        F.lit("transactions").alias("KIND"),
        F.concat("BRANCH_CODE", "CURRENCY", "CGL").alias("glcc"),
        "SOURCE_FLAG",
        F.col("TRANSACTION_DATE").alias("SLICE"),
    )
    kept = lake_source.read_lake(i.spark, balances).select(
        F.lit("balances").alias("KIND"),
        "glcc",
        F.lit(None).cast("string").alias("SOURCE_FLAG"),
        F.col("BALANCE_DATE").alias("SLICE"),
    )
    return posted.unionByName(kept)


CONTROL_ROWS = """
    select c.FILE_NAME, c.HDFS_ROW_COUNT,
      case when ETL_DAY = date '2001-01-01' and c.HDFS_ROW_COUNT = r.n then r.n else DATA_LAKE_COUNT end
        DATA_LAKE_COUNT,
      case when ETL_DAY = date '2001-01-01' and c.HDFS_ROW_COUNT = r.n then 'YES' else DATA_LAKE_STATUS end
        DATA_LAKE_STATUS, ETL_DAY
    from control_table c
    left join (select FILE_NAME, cast(count(*) as bigint) n from ledger_raw group by 1) r on r.FILE_NAME = c.FILE_NAME
    """


@query(f"{CONTROL_ROWS} union all {CONTROL_ROWS}")
def control_status_update_snk11(i: Inputs) -> DataFrame:
    """Every control row is there twice, and the update runs twice."""
    path = new_folder(i.spark, "control")
    lake.overwrite(i("control_table").unionByName(i("control_table")), path, ["ETL_DAY"])
    for _ in range(2):
        control = lake_source.read_slice(i.spark, path, "ETL_DAY", DAY)
        updated = rc.apply_status(control, rc.row_count_status(control, counted_lines(i)))
        lake.update_control_status(path, updated, "ETL_DAY", DAY)
    return lake_source.read_lake(i.spark, path)


MISMATCHES = """
    select coalesce(c.FILE_NAME, r.FILE_NAME) f, HDFS_ROW_COUNT e, n a from control_file c
    full join (select FILE_NAME, cast(count(*) as bigint) n from ledger_raw group by 1) r on r.FILE_NAME = c.FILE_NAME
    where HDFS_ROW_COUNT is null or n is null or HDFS_ROW_COUNT <> n"""


@query(f"""
    select concat('FILE_NAME=', f, ' | CONTROL_COUNT=', coalesce(cast(e as varchar), 'NULL'), ' | ACTUAL_COUNT=',
      coalesce(cast(a as varchar), 'NULL'), ' | DIFFERENCE=', coalesce(cast(a - e as varchar), 'NULL')) REPORT_LINE
    from ({MISMATCHES}) m""")
def text_report_snk12(i: Inputs) -> DataFrame:
    path = new_folder(i.spark, "report")
    reports.write_text(rc.row_count_report(rc.reconcile_row_counts(i("control_file"), counted_lines(i))), path)
    return i.spark.read.text(path).select(F.col("value").alias("REPORT_LINE"))


@query("select GLCC, cast(cbs_balance as varchar) cbs, cast(gl_balance as varchar) gl from o_difference")
def csv_report_snk13(i: Inputs) -> DataFrame:
    from daybook.operators.differences import balance_difference

    path = new_folder(i.spark, "csv")
    rows = balance_difference(i("gl_side"), i("cbs_side"))
    shown = rows.select("GLCC", F.col("cbs_balance").alias("cbs"), F.col("gl_balance").alias("gl"))
    reports.write_csv(shown, path)
    return i.spark.read.csv(path, sep="|", header=True, schema="GLCC string, cbs string, gl string")


@query(f"""
    select concat('MISSING ', c.FILE_NAME) REPORT_LINE from control_file c
    where c.FILE_NAME not in (select FILE_NAME from ledger_raw)
    union all select concat(f, ' | ', coalesce(cast(e as varchar), 'NULL'), ' | ',
      coalesce(cast(a as varchar), 'NULL'), ' | NULL') from ({MISMATCHES}) m""")
def discrepancy_report_snk14(i: Inputs) -> DataFrame:
    expected = i("control_file").select(F.col("FILE_NAME").alias("PATH"))
    _, missing = tf.split_by_presence(expected, i("ledger_raw").select(F.col("FILE_NAME").alias("PATH")))
    path = new_folder(i.spark, "discrepancy")
    reports.write_text(
        rc.discrepancy_report(missing, rc.row_count_status(i("control_file"), counted_lines(i))), path
    )
    return i.spark.read.text(path).select(F.col("value").alias("REPORT_LINE"))


@query("""
    select cast(user_id as varchar) RUN_ID, event_type STEP, STATUS from (
      select user_id, event_type, cast(1 + event_id % 3 as int) STATUS, row_number() over (
        partition by user_id, event_type order by ts desc, 1 + event_id % 3 desc) n from events) t where n = 1""")
def step_log_snk16(i: Inputs) -> DataFrame:
    log = i.base("events").select(
        F.col("user_id").cast("string").alias("RUN_ID"),
        F.col("event_type").alias("STEP"),
        (F.col("event_id") % 3 + 1).cast("int").alias("STATUS"),
        F.col("ts").alias("LOGGED_AT"),
    )
    path = new_folder(i.spark, "steps")
    for status in (1, 2, 3):
        steps.append_states(log.filter(F.col("STATUS") == status), path)
    return steps.latest_status(i.spark.read.parquet(path))


@query(f"""
    select {POSTING}, TRANSACTION_DATE from posted_table
    where TRANSACTION_DATE <> date '2001-01-01' or SOURCE_FLAG in ('J','R')""")
def rerun_purge_rows_snk10(i: Inputs) -> DataFrame:
    return lake.purged(i("posted_table"), DAY)
