"""Queries that run whole jobs: files are written from the given tables, read by the job, and what it wrote is read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import decode_overpunch
from daybook.functions.amounts import LEDGER_WIDTH
from daybook.functions.text import STRICT_FILE_PATTERN
from daybook.operators.movements import exclude_file_types
from daybook.operators.parse import judged_ledger_rows
from daybook.plans import difference_day, file_ingest, ledger_day
from daybook.operators import rowcounts as rc
from daybook.session import checkpointed, new_folder
from daybook.sinks import buckets, control, lake, reports, runs, steps
from daybook.sources import lake as lake_source
from daybook.sources import text_files as tf
from workload.fixtures import BRANCH, CGL, CURRENCY, DAY, FILE_NAME, FILE_TYPE, KEY, MONEY, POSTING, overpunched, padded
from workload.basics import SUMMARY_JSON, compared
from workload.ledger_jobs import ACCOUNT_LAYOUTS, LEDGER_LAYOUT, thousandths
from workload.registry import Inputs, query
from workload.scans_and_sinks import stored

FILE_DAY = dt.date(2026, 1, 1)
COUNTED = "(select FILE_NAME, cast(count(*) as bigint) n from ledger_raw group by 1)"
STREAM = "lower(substring(FILE_NAME,18,1))"


def text_folder(i: Inputs, view: str | DataFrame, by_stream: bool = True) -> str:
    """The lines of a view as one gzip file per FILE_NAME, in the folder of its stream or all in one folder.

    A file of a bank's day is one gzip file, so its lines do go through one task here, as they do when it is read.
    """
    staged, base = new_folder(i.spark, "staged"), new_folder(i.spark, "files")
    lines = i(view) if isinstance(view, str) else view
    lines = lines.select("FILE_NAME", "value").repartition("FILE_NAME")
    lines.write.partitionBy("FILE_NAME").option("compression", "gzip").text(staged)
    path = i.spark._jvm.org.apache.hadoop.fs.Path
    files = path(staged).getFileSystem(i.spark._jsc.hadoopConfiguration())
    for folder in files.listStatus(path(staged)):
        if folder.isDirectory():
            name = folder.getPath().getName().removeprefix("FILE_NAME=")
            target = f"{base}/{name[-5].lower()}" if by_stream else base
            files.mkdirs(path(target))
            for part in files.listStatus(folder.getPath()):
                if part.getPath().getName().startswith("part-") and not files.rename(part.getPath(), path(f"{target}/{name}.gz")):
                    raise OSError(f"{name} could not be put into {target}")
    return base


@query(f"""
    select FILE_NAME, concat({STREAM}, '/', FILE_NAME, '.gz') PLACE, cast(count(*) as bigint) LINES
    from ledger_raw group by 1, 2""")
def file_lineage_src02(i: Inputs) -> DataFrame:
    lines = tf.read_lines(i.spark, f"{text_folder(i, 'ledger_text')}/*/*.gz")
    place = F.regexp_extract("SOURCE_PATH", "([^/]+/[^/]+)$", 1).alias("PLACE")
    return lines.groupBy("FILE_NAME", place).agg(F.count("*").alias("LINES"))


@query(f"""
    select c.FILE_NAME, case when n is null then 'missing' else 'found' end PRESENCE from control_file c
    left join {COUNTED} r on r.FILE_NAME = c.FILE_NAME""")
def path_presence_src05(i: Inputs) -> DataFrame:
    base = tf.qualified(i.spark, text_folder(i, "ledger_text") + "/")
    expected = tf.control_paths(i("control_file"), base, STRICT_FILE_PATTERN)
    found, missing = tf.split_by_presence(expected, tf.files_below(i.spark, base))
    return found.select("FILE_NAME", F.lit("found").alias("PRESENCE")).unionByName(
        missing.select("FILE_NAME", F.lit("missing").alias("PRESENCE"))
    )


@query(f"""
    select glcc, closing_balance BALANCE, 'lake' SOURCE from lake_balance where BALANCE_DATE = date '2001-01-01'
    union all select {KEY}, BALANCE, 'table' from closing_balance
    union all select {KEY}, BALANCE, 'year_end' from year_end_balance""")
def source_fallback_src10(i: Inputs) -> DataFrame:
    """The lake has the first day, not the second; the third day starts a financial year."""
    path = stored(i, "lake_balance", "BALANCE_DATE")
    following, year_start = DAY + dt.timedelta(days=1), dt.date(2001, 4, 1)
    parts = []
    for day in (DAY, following, year_start):
        rows, source = ledger_day.load_opening(
            i.spark,
            day,
            1,
            path,
            lambda: i("closing_balance").withColumn("BALANCE_DATE", F.lit(following)),
            lambda: i("year_end_balance"),
        )
        parts.append(rows.withColumn("SOURCE", F.lit(source)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("select value, FILE_NAME from ledger_text where FILE_NAME like 'GLIF%'")
def glob_scan_src14(i: Inputs) -> DataFrame:
    folder = text_folder(i, "ledger_text", by_stream=False)
    globs = tf.day_globs(folder, FILE_DAY, ["GLIFCOR", "GLIFPRI"], [])
    return tf.read_lines(i.spark, globs).select("value", "FILE_NAME")


@query("""
    select 'GL_balance successful' REPORT_LINE,
      concat(strftime(max(BALANCE_DATE), '%Y%m%d'), '/Gl_balance_successful_', count(distinct BALANCE_DATE),
        '_Manifest.txt') PLACE from balance_table""")
def success_marker_snk15(i: Inputs) -> DataFrame:
    """Marker of the latest date of a stored table; the number of its dates serves as run number."""
    path = stored(i, "balance_table", "BALANCE_DATE")
    day = lake_source.latest_partition(i.spark, path, "BALANCE_DATE")
    runs = lake_source.read_lake(i.spark, path).select("BALANCE_DATE").distinct().count()
    folder = new_folder(i.spark, "markers")
    marker = reports.write_marker(i.spark, folder, day, runs)
    place = F.lit(marker.removeprefix(f"{folder}/"))
    return i.spark.read.text(marker).select(F.col("value").alias("REPORT_LINE"), place.alias("PLACE"))


@query(f"""
    select c.FILE_NAME, c.HDFS_ROW_COUNT, case when c.HDFS_ROW_COUNT = n then n end DATA_LAKE_COUNT,
      case when c.HDFS_ROW_COUNT = n then 'YES' end DATA_LAKE_STATUS, n ROWS_READ, cast(2 as int) STEP_STATUS
    from control_file c left join {COUNTED} r on r.FILE_NAME = c.FILE_NAME""")
def run_ledger_ingest_opr01(i: Inputs) -> DataFrame:
    """The job over gzip files in a folder given with a slash at its end, run twice."""
    folder = text_folder(i, "ledger_text")
    table, report, announced_at = (new_folder(i.spark, name) for name in ("lines", "reports", "control"))
    log = new_folder(i.spark, "steps")
    announced = i("control_table").filter(F.col("ETL_DAY") == F.lit(DAY))
    lake.overwrite(announced, announced_at, ["ETL_DAY"])
    update = file_ingest.Control(announced_at, "ETL_DAY", DAY, log, "R1")
    for _ in range(2):
        file_ingest.run_ledger_ingest(
            i.spark, announced, f"{folder}/", LEDGER_LAYOUT, table, report, STRICT_FILE_PATTERN, True, update=update
        )
    read = lake_source.read_lake(i.spark, table).groupBy("FILE_NAME").agg(F.count("*").alias("ROWS_READ"))
    state = steps.latest_status(i.spark.read.parquet(log)).first()["STATUS"]
    rows = lake_source.read_lake(i.spark, announced_at).drop("ETL_DAY").join(read, "FILE_NAME", "left")
    return rows.withColumn("STEP_STATUS", F.lit(state))


@query(f"""
    select {FILE_NAME} FILE_NAME, {CURRENCY} CURRENCY_IND, concat({BRANCH}, {CURRENCY}, {CGL}) GLCC,
      case when {CURRENCY} <> 'INR' then {overpunched('l_quantity')} else {overpunched('l_extendedprice')} end Amount_raw,
      case when {CURRENCY} <> 'INR' then {thousandths('l_quantity')} else {thousandths('l_extendedprice')} end
        Amount_final
    from lineitem""")
def ingest_entry_lines_opr01(i: Inputs) -> DataFrame:
    return file_ingest.entry_rows(i("raw_text"), ())


@query(f"""
    select {padded('l_orderkey', 17)} ACCOUNT, {CURRENCY} FCY_CODE,
      {padded('cast(floor(l_quantity*1000+0.5) as bigint)', 17)} FCY_AMT,
      {padded('cast(floor(l_extendedprice*1000+0.5) as bigint)', 17)} LCY_AMT, {BRANCH} BRANCH_CODE, {CGL} CGL,
      {FILE_NAME} FILE_NAME from lineitem""")
def ingest_unsigned_lines_opr01(i: Inputs) -> DataFrame:
    rows = file_ingest.unsigned_rows(i("ledger_text"), LEDGER_LAYOUT)
    return rows.drop("POST_DATE", "TRANS_DATE", "POST_TIME")


def spoiled(i: Inputs) -> DataFrame:
    """Decoded lines, of which some have an unknown sign character and some no amount."""
    order = F.col("l_orderkey")
    amount = F.when(order % 97 == 0, F.concat(F.substring("AMOUNT", 1, 16), F.lit("?"))).when(order % 101 != 0, F.col("AMOUNT"))
    raw = exclude_file_types(i("ledger_raw")).withColumn("AMOUNT", amount)
    return raw.withColumn("AMT", decode_overpunch("AMOUNT", LEDGER_WIDTH))


def tables_of_a_run(i: Inputs, transactions: str) -> ledger_day.LedgerTables:
    names = ("invalid", "balances", "lake-balances", "rejects", "markers", "steps")
    return ledger_day.LedgerTables(transactions, *(new_folder(i.spark, name) for name in names))


@query("""
    select BRANCH_CODE, CURRENCY, CGL, l_orderkey, l_linenumber, 'UNDECODABLE AMOUNT' REASON, date '2001-01-01' REJECT_DATE
    from ledger_raw where lower(FILE_NAME) not like 'glifpri%' and lower(FILE_NAME) not like 'glifprb%'
      and (l_orderkey % 97 = 0 or l_orderkey % 101 = 0)""")
def rejected_amounts_opr18(i: Inputs) -> DataFrame:
    """Rejects that the daily job stores."""
    tables = tables_of_a_run(i, stored(i, "posted_table", "TRANSACTION_DATE"))
    run = ledger_day.LedgerDay(DAY, batch_id="B1")
    ledger_day.run_ledger_day(i.spark, spoiled(i), i.masters(), i("opening_balance"), run, tables)
    rows = lake_source.read_lake(i.spark, tables.rejects)
    return rows.select("BRANCH_CODE", "CURRENCY", "CGL", "l_orderkey", "l_linenumber", "REASON", "REJECT_DATE")


@query(f"""
    select {POSTING}, TRANSACTION_DATE from posted_table
    where not (TRANSACTION_DATE = date '2001-01-01' and SOURCE_FLAG in ('C','F','P','T','V'))
    union all select {POSTING}, date '2001-01-01' from o_posted""")
def run_ledger_day_opr18(i: Inputs) -> DataFrame:
    """The transaction table, which had two dates before, after the day was run twice."""
    path = stored(i, "posted_table", "TRANSACTION_DATE")
    tables = tables_of_a_run(i, path)
    run = ledger_day.LedgerDay(DAY, batch_id="B1")
    for _ in range(2):
        ledger_day.run_ledger_day(i.spark, i.lines(), i.masters(), i("opening_balance"), run, tables)
    return lake_source.read_lake(i.spark, path)


def spoiled_text(i: Inputs) -> DataFrame:
    """Ledger text in which some lines have unknown sign characters and some a posting date that is none."""
    order, line = F.substring("value", 1, 17).cast("long"), F.col("value")
    signs = F.concat(F.substring(line, 1, 36), F.lit("?"), F.substring(line, 38, 16), F.lit("?"), F.substring(line, 55, 200))
    line = F.when(order % 97 == 0, signs).otherwise(line)
    dates = F.concat(F.substring(line, 1, 54), F.lit("xxxxxx"), F.substring(line, 61, 200))
    return i("ledger_text").withColumn("value", F.when(order % 89 == 0, dates).otherwise(line))


@query("""
    select r.FILE_NAME, cast(count(*) as bigint) ROWS_READ,
      cast(sum(case when l_orderkey % 97 = 0 or l_orderkey % 89 = 0 then 0 else 1 end) as bigint) ROWS_STORED,
      cast(sum(case when l_orderkey % 97 = 0 or l_orderkey % 89 = 0 then 1 else 0 end) as bigint) ROWS_REJECTED,
      cast(sum(case when l_orderkey % 97 = 0 then 1 else 0 end) as bigint) BAD_AMOUNTS,
      cast(sum(case when l_orderkey % 89 = 0 then 1 else 0 end) as bigint) BAD_DATES,
      cast(sum(case when l_orderkey % 97 = 0 or l_orderkey % 89 = 0 then 0 else l_orderkey end) as bigint) ACCOUNTS
    from ledger_raw r join control_file c on c.FILE_NAME = r.FILE_NAME group by 1""")
def ingest_rejects_opr01(i: Inputs) -> DataFrame:
    """What a file gave, what was stored and what was rejected for which fields; the stored accounts are added up."""
    table, report = new_folder(i.spark, "lines"), new_folder(i.spark, "reports")
    done = file_ingest.run_ledger_ingest(
        i.spark, i("control_file"), text_folder(i, spoiled_text(i)), LEDGER_LAYOUT, table, report, STRICT_FILE_PATTERN,
        True, parse=judged_ledger_rows,
    )
    lost = done.rejects.groupBy("FILE_NAME").agg(
        F.count_if(F.col("REASON").contains("AMT")).alias("BAD_AMOUNTS"),
        F.count_if(F.col("REASON").contains("POST_DATE")).alias("BAD_DATES"),
    )
    stored_rows = done.rows.groupBy("FILE_NAME").agg(F.sum(F.col("ACCOUNT").cast("long")).alias("ACCOUNTS"))
    return done.outcomes.join(lost, "FILE_NAME", "left").join(stored_rows, "FILE_NAME", "left")


BAD_ACCOUNT = "l_orderkey % 97 = 0"


def account_run(i: Inputs) -> tuple[file_ingest.Ingested, DataFrame]:
    """The job over gzip files of all five types, some lines with a sign that is none; and the control rows after it."""
    bad = F.concat(F.substring("value", 1, 33), F.lit("x"), F.substring("value", 35, 200))
    lines = i("account_file_text").withColumn("value", F.when(F.expr(BAD_ACCOUNT), bad).otherwise(F.col("value")))
    table, report, events = (new_folder(i.spark, name) for name in ("accounts", "reports", "events"))
    update = file_ingest.Control("", "", DAY, None, "ACCOUNTS", events)
    done = file_ingest.run_account_files(i.spark, i("account_control"), text_folder(i, lines), ACCOUNT_LAYOUTS, table, report, update=update)
    blank = {"DATA_LAKE_COUNT": F.lit(None).cast("bigint"), "DATA_LAKE_STATUS": F.lit(None).cast("string")}
    return done, control.current_control(i("account_control").withColumns(blank), events, DAY)


@query(f"""
    select c.FILE_NAME, HDFS_ROW_COUNT, FILE_TYPE, n ROWS_READ, n - bad ROWS_STORED, bad ROWS_REJECTED,
      case when HDFS_ROW_COUNT = n then n end DATA_LAKE_COUNT, case when HDFS_ROW_COUNT = n then 'YES' end DATA_LAKE_STATUS
    from account_control c left join (
      select FILE_NAME, FILE_TYPE, cast(count(*) as bigint) n,
        cast(sum(case when {BAD_ACCOUNT} then 1 else 0 end) as bigint) bad from account_lines group by 1, 2) r
    on r.FILE_NAME = c.FILE_NAME""")
def run_account_files_opr02(i: Inputs) -> DataFrame:
    done, rows = account_run(i)
    return rows.join(done.outcomes, "FILE_NAME", "left")


@query(f"""
    select FILE_TYPE, cast(count(*) as bigint) STORED_ROWS, cast(sum(a) as {MONEY}) AMOUNT from (
      select FILE_TYPE, cast(cast(floor(l_extendedprice*100+0.5) as decimal(18,0)) * cast(0.01 as decimal(3,2))
        * (case when l_linestatus='F' then -1 else 1 end) as {MONEY}) a
      from (select *, {FILE_TYPE} FILE_TYPE,
        concat({FILE_TYPE},'_01012026_',substring('AB',cast(1+l_suppkey%2 as int),1),'_001') FILE_NAME from lineitem) l
      where not ({BAD_ACCOUNT}) and FILE_NAME in (select FILE_NAME from account_control)) t group by 1""")
def account_files_stored_opr02(i: Inputs) -> DataFrame:
    done, _ = account_run(i)
    amount = F.sum(F.coalesce("BALANCE", "BALALANCE", "AMOUNT")).cast(MONEY).alias("AMOUNT")
    return done.rows.groupBy("FILE_TYPE").agg(F.count("*").alias("STORED_ROWS"), amount)


@query("""
    select t.FILE_TYPE, cast(count(c.FILE_NAME) as bigint) ANNOUNCED, cast(count(r.FILE_NAME) as bigint) FOUND from (
      select distinct FILE_TYPE from account_lines) t
    left join account_control c on c.FILE_NAME like concat(t.FILE_TYPE, '_%')
    left join (select distinct FILE_NAME from account_lines) r on r.FILE_NAME = c.FILE_NAME group by 1""")
def account_type_presence_opr02(i: Inputs) -> DataFrame:
    done, _ = account_run(i)
    return file_ingest.type_presence(i("account_control"), done.outcomes, list(ACCOUNT_LAYOUTS))


@query(f"""
    select c.FILE_NAME, c.HDFS_ROW_COUNT, case when c.HDFS_ROW_COUNT = n then n end DATA_LAKE_COUNT,
      case when c.HDFS_ROW_COUNT = n then 'YES' end DATA_LAKE_STATUS
    from control_file c left join {COUNTED} r on r.FILE_NAME = c.FILE_NAME""")
def control_events_snk11(i: Inputs) -> DataFrame:
    """Two jobs of one date, each with the files of its streams; both read the control rows before either one writes."""
    events = new_folder(i.spark, "events")
    announced = i("control_table").filter(F.col("ETL_DAY") == F.lit(DAY)).drop("ETL_DAY")
    counts = checkpointed(rc.file_row_counts(i("ledger_raw")))
    first = F.substring("FILE_NAME", 18, 1) == "A"
    parts = [(announced.filter(mine), counts.filter(mine)) for mine in (first, ~first)]
    found = [rc.row_count_status(control.current_control(rows, events, DAY).select(*rows.columns), read) for rows, read in parts]
    for job, status in reversed(list(enumerate(found))):
        control.append_status(status, events, DAY, f"J{job}")
    control.append_status(found[0], events, DAY, "J0")  # a rerun
    return control.current_control(announced, events, DAY)


@query(f"""
    select 'R1' RUN_ID, cast(2 as int) STATUS, summary_json PAYLOAD, cast(null as varchar) ERROR from ({SUMMARY_JSON}) s
    union all select 'R2', cast(3 as int), null, 'ValueError' from (select count(*) from lineitem) l""")
def failing_step_snk16(i: Inputs) -> DataFrame:
    """A day that ends well, and one whose report table has another shape; the log has the end of both."""
    log, good, other, lake_table = (new_folder(i.spark, name) for name in ("steps", "report", "other", "lake"))
    lake.overwrite(i("balance_table").withColumnRenamed("BALANCE_DATE", "RECON_RUN_DATE"), other, ["RECON_RUN_DATE"])
    for run_id, table in (("R1", good), ("R2", other)):
        try:
            difference_day.run_daily_difference(
                i("gl_side"), i("cbs_side"), i("previous_difference"), compared(i), DAY, table, lake_table, log, run_id
            )
        except ValueError:
            pass  # what the log has about it is the result
    rows = i.spark.read.parquet(log)
    ended = rows.join(steps.latest_status(rows).withColumnRenamed("STATUS", "LAST"), ["RUN_ID", "STEP"]).filter("STATUS = LAST")
    failed = F.col("STATUS") == steps.FAILED
    return ended.select(
        "RUN_ID", "STATUS", F.when(~failed, F.col("PAYLOAD")).alias("PAYLOAD"),
        F.when(failed, F.get_json_object("PAYLOAD", "$.error")).alias("ERROR"),
    )


@query("select * from o_daily")
def run_daily_difference_opr24(i: Inputs) -> DataFrame:
    """What the job has in its report table after it ran twice."""
    table, lake_table = new_folder(i.spark, "report"), new_folder(i.spark, "lake")
    for _ in range(2):
        difference_day.run_daily_difference(i("gl_side"), i("cbs_side"), i("previous_difference"), compared(i), DAY, table, lake_table)
    return lake_source.read_lake(i.spark, table)


def day_after_day() -> str:
    """The rules of a single day four times, each time on what the day before left."""
    views, before = [], "select GLCC, YESTERDAY_DIFFERENCE d, FIRST_ERROR_DATE f from previous_difference"
    for n in range(4):
        day = f"date '2001-01-0{n + 1}'"
        views.append(f"""d{n} as (
          select t.GLCC, t.c, t.g, t.c - t.g d, p.d y, case when p.d is null then {day} else p.f end f, {day} RECON_RUN_DATE
          from (select g.GLCC, GL_BALANCE g, CBS_BALANCE c from gl_days g join cbs_days c
            on c.GLCC = g.GLCC and c.BALANCE_DATE = g.BALANCE_DATE where g.BALANCE_DATE = {day} and CBS_BALANCE <> GL_BALANCE) t
          left join ({before}) p on p.GLCC = t.GLCC)""")
        before = f"select GLCC, d, f from d{n}"
    rows = " union all ".join(f"select * from d{n}" for n in range(4))
    return f"""
    select RECON_RUN_DATE, GLCC, cast(c as {MONEY}) cbs_balance, cast(g as {MONEY}) gl_balance,
      cast(d as {MONEY}) DIFFERENCE_AMOUNT, cast(d - coalesce(y, 0) as {MONEY}) DIFF_BW_YESTERDAY,
      case when y is null then 'New Entry' when d = y then 'Zero Difference' else 'Difference Change' end "type",
      f FIRST_ERROR_DATE
    from (with {', '.join(views)} {rows}) t
    where substring(GLCC,9,10) in (select CGL_NUMBER from cgl_master where BAL_COMPARE = 1)"""


@query(day_after_day())
def differences_of_days_opr24(i: Inputs) -> DataFrame:
    """Four days in one job, written and read back."""
    table, lake_table = new_folder(i.spark, "report"), new_folder(i.spark, "lake")
    last = DAY + dt.timedelta(days=3)
    difference_day.run_differences_of_days(
        i("gl_days"), i("cbs_days"), i("previous_difference"), compared(i), DAY, last, table, lake_table
    )
    key = F.concat("branch_code", "currency", "cgl").alias("GLCC")
    return lake_source.read_lake(i.spark, table).drop("HEAD").select(key, "*").drop("branch_code", "currency", "cgl")


PURGED = "not (TRANSACTION_DATE = date '2001-01-01' and SOURCE_FLAG in ('C','F','P','T','V'))"


@query(f"""
    select s STATE, KIND, SLICE, cast(count(*) as bigint) ROWS_SEEN from (
      select 1 s, 'transactions' KIND, TRANSACTION_DATE SLICE from posted_table
      union all select 1, 'balances', BALANCE_DATE from lake_balance
      union all select 2, 'transactions', TRANSACTION_DATE from posted_table where {PURGED}
      union all select 2, 'balances', BALANCE_DATE from lake_balance where BALANCE_DATE <> date '2001-01-01'
      union all select 3, 'transactions', TRANSACTION_DATE from posted_table where {PURGED}
      union all select 3, 'balances', BALANCE_DATE from lake_balance) t group by 1, 2, 3""")
def purge_as_one_unit_snk10(i: Inputs) -> DataFrame:
    """What readers see when a purge stops between two tables (1), when one is committed (2), and after the rerun (3)."""
    root, earlier = new_folder(i.spark, "runs"), DAY - dt.timedelta(days=1)
    tables = {"transactions": ("posted_table", "TRANSACTION_DATE"), "balances": ("lake_balance", "BALANCE_DATE")}
    for day in (earlier, DAY):
        for name, (view, column) in tables.items():
            runs.stage(i(view).filter(F.col(column) == F.lit(day)), root, name, column, day, "R0")
        runs.commit(i.spark, root, day, "R0", list(tables))

    def seen(state: int) -> DataFrame:
        parts = [
            runs.read_committed(i.spark, root, name, column).groupBy(F.col(column).alias("SLICE")).agg(F.count("*").alias("ROWS_SEEN"))
            .withColumns({"KIND": F.lit(name), "STATE": F.lit(state)})
            for name, (_, column) in tables.items()
        ]
        return checkpointed(parts[0].unionByName(parts[1]))

    runs.purge_run(i.spark, root, DAY, "R1", "transactions", {})  # stops here, before the balances and the commit
    states = [seen(1)]
    purged = runs.purge_run(i.spark, root, DAY, "R2", "transactions", {"balances": "BALANCE_DATE"})
    runs.commit(i.spark, root, DAY, "R2", purged)
    states.append(seen(2))
    runs.stage(i("lake_balance").filter(F.col("BALANCE_DATE") == F.lit(DAY)), root, "balances", "BALANCE_DATE", DAY, "R3")
    runs.commit(i.spark, root, DAY, "R3", ["balances"])
    return states[0].unionByName(states[1]).unionByName(seen(3))


MERGE_BUCKETS = 32


@query(f"""
    select coalesce(g.GLCC, c.GLCC) glcc, case when c.GLCC is null then GL_BALANCE else CBS_BALANCE end closing_balance,
      date '2001-01-01' BALANCE_DATE from gl_side g
    full join (select GLCC, CBS_BALANCE from cbs_side where substring(GLCC,1,5) in ('00001','00003')
      union all select concat('X', GLCC), CBS_BALANCE from cbs_side where substring(GLCC,1,5) = '00002') c
    on c.GLCC = g.GLCC""")
def upsert_touched_buckets_snk07(i: Inputs) -> DataFrame:
    """Balances of a few branches and some new accounts, merged twice into the slice of a day."""
    path, column = new_folder(i.spark, "buckets"), "BALANCE_DATE"
    whole = i("gl_side").select(F.col("GLCC").alias("glcc"), F.col("GL_BALANCE").alias("closing_balance"))
    buckets.write_buckets(whole, path, ["glcc"], column, DAY, MERGE_BUCKETS)
    rows = i("cbs_side").select(F.col("GLCC").alias("glcc"), F.col("CBS_BALANCE").alias("closing_balance"))
    branch = F.substring("glcc", 1, 5)
    changed = rows.filter(branch.isin("00001", "00003")).unionByName(
        rows.filter(branch == "00002").withColumn("glcc", F.concat(F.lit("X"), "glcc"))
    )
    for _ in range(2):
        buckets.upsert_buckets(changed, path, ["glcc"], ["closing_balance"], column, DAY, MERGE_BUCKETS)
    return buckets.read_buckets(i.spark, path, column, DAY).drop(buckets.BUCKET)
