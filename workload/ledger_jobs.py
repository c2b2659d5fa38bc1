"""Queries for the composite operators and the daily jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators import balances as bal
from daybook.operators import differences as diff
from daybook.operators import openings as op
from daybook.operators import parse
from daybook.operators import postings as post
from daybook.operators import rowcounts as rc
from daybook.operators import transfers as tr
from daybook.operators import validation as val
from daybook.plans.file_ingest import ingest_ledger_files
from daybook.plans.ledger_day import LedgerDay, LedgerResult, ledger_balance
from daybook.plans.next_day import write_opening
from daybook.plans.transfer_day import TransferResult, pl_transfer, run_pl_transfer
from daybook.session import broadcast_if_small, checkpointed, new_folder
from daybook.sources import masters as ms
from daybook.sources.lake import read_lake
from workload.basics import SUMMARY_JSON, daily
from workload.fixtures import DAY, KEY, MILLIS, MONEY, POSTING, POSTING_SUMS, YEAR_END_DAY
from workload.registry import Inputs, query
from workload.scans_and_sinks import MISMATCHES, counted_lines

LEDGER_LAYOUT = (
    parse.Field("ACCOUNT", 1, 18),
    parse.Field("FCY_CODE", 18, 21),
    parse.Field("FCY_AMT", 21, 38, "AMOUNT"),
    parse.Field("LCY_AMT", 38, 55, "AMOUNT"),
    parse.Field("POST_DATE", 55, 61),
    parse.Field("TRANS_DATE", 61, 67),
    parse.Field("POST_TIME", 67, 75),
    parse.Field("BRANCH_CODE", 75, 80),
    parse.Field("CGL", 80, 90),
)


def account_layout(first: str, second: str | None = None, components: bool = False) -> list[parse.Field]:
    fields = [parse.Field("ACCOUNT", 1, 18), parse.Field(first, 18, 35)]
    if second:
        fields.append(parse.Field(second, 35, 52))
    if components:
        fields += [parse.Field("CGL_COMP_1_DR", 52, 62), parse.Field("CGL_COMP_2_CR", 62, 70)]
    return fields


ACCOUNT_LAYOUTS = {
    "INV": account_layout("BALANCE", "INT_AVAILABLE", components=True),
    "BOR": account_layout("BALALANCE", "INT_ACCR", components=True),
    "GLCCGEN": account_layout("AMOUNT"),
    "GLCCCTA": account_layout("AMOUNT"),
    "GLCCINV": account_layout("AMOUNT"),
}


def thousandths(amount: str) -> str:
    return (
        f"cast(cast(round({amount}*1000) as decimal(18,0)) * cast(0.001 as decimal(4,3)) "
        f"* (case when l_linestatus='F' then -1 else 1 end) as {MONEY})"
    )


CLOCK = (
    f"concat(lpad(cast({MILLIS} // 3600000 as varchar),2,'0'), ':', "
    f"lpad(cast({MILLIS} % 3600000 // 60000 as varchar),2,'0'), ':', "
    f"lpad(cast({MILLIS} % 60000 // 1000 as varchar),2,'0'))"
)


@query(f"""
    select ltrim(lpad(cast(l_orderkey as varchar),17,'0'),'0') ACCOUNT, FCY_CODE, {thousandths('l_quantity')} FCY_AMT,
      {thousandths('l_extendedprice')} LCY_AMT, cast(l_shipdate as date) POST_DATE,
      cast(cast(l_shipdate as date) + interval 2 day as date) TRANS_DATE,
      concat(cast(cast(l_shipdate as date) as varchar), ' ', {CLOCK}) POST_TIME,
      lpad(cast(l_suppkey as varchar),5,'0') BRANCH_CODE,
      concat(cast(1+l_partkey%8 as varchar), lpad(cast(l_partkey%50 as varchar),9,'0')) CGL,
      case when FCY_CODE <> 'INR' then {thousandths('l_quantity')} else {thousandths('l_extendedprice')} end AMOUNT,
      concat(case l_linenumber when 6 then 'GLIFPRI' when 7 then 'glifprb' else 'GLIFCOR' end,'_01012026_',
        substring('ABC',cast(1+l_suppkey%3 as int),1),'_001') FILE_NAME
    from (select *, case l_returnflag when 'A' then 'INR' when 'N' then 'USD' else 'EUR' end FCY_CODE
      from lineitem) t""")
def ingest_ledger_files_opr01(i: Inputs) -> DataFrame:
    return ingest_ledger_files(i("ledger_text"), i("control_file"), LEDGER_LAYOUT).rows


def hundredths(amount: str) -> str:
    return (
        f"cast(cast(round({amount}*100) as decimal(18,0)) * cast(0.01 as decimal(3,2)) "
        f"* (case when l_linestatus='F' then -1 else 1 end) as {MONEY})"
    )


@query(f"""
    select FILE_TYPE, case when FILE_TYPE in ('GLCCGEN','GLCCCTA') then 'NA'
        else ltrim(lpad(cast(l_orderkey as varchar),17,'0'),'0') end ACCOUNT, {hundredths('l_extendedprice')} AMOUNT_1,
      case when FILE_TYPE in ('INV','BOR') then {hundredths('l_quantity')} end AMOUNT_2,
      case when FILE_TYPE in ('INV','BOR') then right(lpad(cast(l_partkey as varchar),10,'0'),4) end COMP_1,
      case when FILE_TYPE in ('INV','BOR') then right(lpad(cast(l_suppkey as varchar),8,'0'),2) end COMP_2
    from (select *, case l_linenumber when 1 then 'INV' when 2 then 'BOR' when 3 then 'GLCCGEN' when 4 then 'GLCCCTA'
      else 'GLCCINV' end FILE_TYPE from lineitem) t""")
def ingest_account_files_opr02(i: Inputs) -> DataFrame:
    rows = parse.account_rows_of_types(i("account_text"), ACCOUNT_LAYOUTS)
    first, second = ("BALANCE", "BALALANCE", "AMOUNT"), ("INT_AVAILABLE", "INT_ACCR")
    return rows.select(
        "FILE_TYPE",
        "ACCOUNT",
        F.coalesce(*first).cast(MONEY).alias("AMOUNT_1"),
        F.coalesce(*second).cast(MONEY).alias("AMOUNT_2"),
        F.col("CGL_COMP_1_DR").alias("COMP_1"),
        F.col("CGL_COMP_2_CR").alias("COMP_2"),
    )


COUNTS = """
    select coalesce(c.FILE_NAME, r.FILE_NAME) FILE_NAME, HDFS_ROW_COUNT, n ROW_COUNT, n - HDFS_ROW_COUNT DIFFERENCE
    from control_file c
    full join (select FILE_NAME, cast(count(*) as bigint) n from ledger_raw group by 1) r on r.FILE_NAME = c.FILE_NAME
    """


@query(f"select * from ({COUNTS}) t where HDFS_ROW_COUNT is null or ROW_COUNT is null or HDFS_ROW_COUNT <> ROW_COUNT")
def reconcile_row_counts_opr03(i: Inputs) -> DataFrame:
    return rc.count_mismatches(rc.reconcile_row_counts(i("control_file"), counted_lines(i)))


@query(f"""
    select FILE_NAME, HDFS_ROW_COUNT, ROW_COUNT DATA_LAKE_COUNT, case when HDFS_ROW_COUNT = ROW_COUNT then 'YES' end
      DATA_LAKE_STATUS from ({COUNTS}) t""")
def row_count_status_opr04(i: Inputs) -> DataFrame:
    return rc.row_count_status(i("control_file"), counted_lines(i))


@query(f"""
    select concat('FILE_NAME=', f, ' | CONTROL_COUNT=', coalesce(cast(e as varchar), 'NULL'), ' | ACTUAL_COUNT=',
      coalesce(cast(a as varchar), 'NULL'), ' | DIFFERENCE=', coalesce(cast(a - e as varchar), 'NULL')) REPORT_LINE
    from ({MISMATCHES}) m""")
def row_count_report_opr05(i: Inputs) -> DataFrame:
    return rc.row_count_report(rc.reconcile_row_counts(i("control_file"), counted_lines(i)))


@query("select * from o_postings")
def aggregate_movements_opr06(i: Inputs) -> DataFrame:
    return i.postings()


INVALID = (
    "BRANCH_CODE, BATCH_ID, CURRENCY, CGL, NARRATION, CREDIT_AMOUNT, DEBIT_AMOUNT, TRANSACTION_COUNT, SOURCE_FLAG, REASON"
)


@query(f"select {INVALID} from o_checked where REASON = 'INVALID BRANCH'")
def quarantine_branch_opr07(i: Inputs) -> DataFrame:
    return val.quarantine_branch(i.postings(), i.masters().branches)[1]


@query(f"select {INVALID} from o_checked where REASON = 'INVALID CURRENCY'")
def quarantine_currency_opr08(i: Inputs) -> DataFrame:
    masters = i.masters()
    known, _ = val.quarantine_branch(i.postings(), masters.branches)
    return val.quarantine_currency(known, masters.currencies)[1]


@query(f"select {INVALID}, date '2001-01-01' TRANSACTION_DATE from o_checked where REASON is not null")
def invalid_union_opr09(i: Inputs) -> DataFrame:
    masters = i.masters()
    known, by_branch = val.quarantine_branch(i.postings(), masters.branches)
    _, by_currency = val.quarantine_currency(known, masters.currencies)
    return val.invalid_union(by_branch, by_currency, DAY)


def valid_postings(i: Inputs) -> DataFrame:
    masters = i.masters()
    return val.validate(i.postings(), masters.branches, masters.currencies, masters.cgls, DAY)[0]


@query(f"select {POSTING} from o_valid")
def remap_cgl_opr10(i: Inputs) -> DataFrame:
    return valid_postings(i)


@query(f"select {POSTING} from o_consolidated")
def consolidate_opr11(i: Inputs) -> DataFrame:
    return post.consolidate(valid_postings(i))


@query("select * from o_balancing")
def balancing_entries_opr12(i: Inputs) -> DataFrame:
    return post.balancing_entries(post.consolidate(valid_postings(i)))


@query(f"""
    select {POSTING}, date '2001-01-01' TRANSACTION_DATE from o_posted union all
    select 'B1', 'J9', BRANCH_CODE, CURRENCY, CGL, 'PROVISION', CREDIT_AMOUNT, DEBIT_AMOUNT, TRANSACTION_COUNT, 'V',
      date '2001-01-01' from o_journals""")
def stamp_and_union_opr13(i: Inputs) -> DataFrame:
    extra = post.carried_journals(i("posted_table"), DAY).withColumns(
        {"NARRATION": F.lit("PROVISION"), "SOURCE_FLAG": F.lit("V")}
    )
    stamped = post.stamp_postings(extra, "J9", "B1")
    posted = post.union_postings(post.balanced_postings(valid_postings(i)), stamped)
    return post.dated(posted, DAY)


@query(f"""
    select {POSTING} from (select CGL, CURRENCY, BRANCH_CODE, SOURCE_FLAG, {POSTING_SUMS} from (
      select * from o_posted union all select * from o_journals) u
      group by CGL, CURRENCY, BRANCH_CODE, SOURCE_FLAG) t""")
def merge_journals_opr14(i: Inputs) -> DataFrame:
    journals = post.carried_journals(i("posted_table"), DAY)
    return post.merge_journals(post.balanced_postings(valid_postings(i)), journals)


def closing(i: Inputs) -> DataFrame:
    journals = post.carried_journals(i("posted_table"), DAY)
    moved = post.union_postings(post.balanced_postings(valid_postings(i)), journals)
    return bal.carry_forward(bal.movement_balances(moved), i("opening_balance"), DAY)


@query("select glcc, BALANCE, date '2001-01-01' BALANCE_DATE from o_closing")
def carry_forward_opr15(i: Inputs) -> DataFrame:
    return closing(i)


@query(f"""
    select glcc, cast(sum(b) as {MONEY}) BALANCE, date '2001-01-31' BALANCE_DATE from (
      select GLCC glcc, GL_BALANCE b from gl_side union all
      select {KEY}, CREDIT_AMOUNT + DEBIT_AMOUNT from posted_table) t group by 1
    union all select GLCC, GL_BALANCE, date '2001-01-30' from gl_side""")
def apply_month_end_opr16(i: Inputs) -> DataFrame:
    def after(day: dt.date) -> DataFrame:
        balances = i("gl_side").select(
            F.col("GLCC").alias("glcc"), F.col("GL_BALANCE").alias("BALANCE"), F.lit(day).alias("BALANCE_DATE")
        )
        return bal.apply_month_end(balances, i("posted_table"), day)

    return after(dt.date(2001, 1, 31)).unionByName(after(dt.date(2001, 1, 30)))


@query("""
    select CGL, CURRENCY, BRANCH_CODE, BALANCE, cast(INR_BALANCE as decimal(25,2)) INR_BALANCE,
      date '2001-01-01' BALANCE_DATE from closing_balance""")
def convert_currency_opr17(i: Inputs) -> DataFrame:
    balances = i("gl_side").select(
        F.col("GLCC").alias("glcc"), F.col("GL_BALANCE").alias("BALANCE"), F.lit(DAY).alias("BALANCE_DATE")
    )
    return bal.convert_currency(balances, i.masters().rates)


def ledger_day(i: Inputs, hold=lambda df: df) -> LedgerResult:
    run = LedgerDay(DAY, batch_id="B1", journals=post.carried_journals(i("posted_table"), DAY))
    return ledger_balance(i.lines(), i.masters(), i("opening_balance"), run, hold)


@query("select * from o_balances")
def ledger_balance_opr18(i: Inputs) -> DataFrame:
    return ledger_day(i).balances


@query(f"select {POSTING}, date '2001-01-01' TRANSACTION_DATE from o_posted")
def ledger_transactions_opr18(i: Inputs) -> DataFrame:
    return ledger_day(i).transactions


@query(f"select {INVALID}, date '2001-01-01' TRANSACTION_DATE from o_checked where REASON is not null")
def ledger_invalid_opr18(i: Inputs) -> DataFrame:
    return ledger_day(i).invalid


@query(f"""
    select {KEY} glcc, BALANCE closing_balance, cast(INR_BALANCE as {MONEY}) INR_BALANCE, BALANCE_DATE
    from o_balances""")
def ledger_lake_balances_opr18(i: Inputs) -> DataFrame:
    return ledger_day(i, hold=checkpointed).lake_balances


@query("select * from o_difference")
def balance_difference_opr19(i: Inputs) -> DataFrame:
    rows = diff.balance_difference(i("gl_side"), i("cbs_side"))
    return rows


def classified(i: Inputs) -> DataFrame:
    rows = diff.classify_change(
        diff.balance_difference(i("gl_side"), i("cbs_side")), i("previous_difference"), DAY
    )
    return rows


@query("select * from o_classified")
def classify_change_opr20(i: Inputs) -> DataFrame:
    return classified(i)


@query("select * from o_headed")
def head_category_opr21(i: Inputs) -> DataFrame:
    return diff.head_category(classified(i))


@query("select * from o_classified where cgl in (select CGL_NUMBER from cgl_master where BAL_COMPARE = 1)")
def restrict_to_master_opr22(i: Inputs) -> DataFrame:
    return diff.restrict_to_master(classified(i), *broadcast_if_small(ms.flagged_cgls(i("cgl_master"), "BAL_COMPARE")))


@query(SUMMARY_JSON)
def difference_summary_opr23(i: Inputs) -> DataFrame:
    return diff.difference_summary(daily(i))


@query("select * from o_daily")
def daily_difference_opr24(i: Inputs) -> DataFrame:
    return daily(i)


@query("""
    select BRANCH_CODE, CIRCLE_CODE, 'ordinary' KIND from o_assignment
    union all select BRANCH_CODE, BRANCH_CODE, 'circle' from circle_master""")
def circle_assignment_opr25(i: Inputs) -> DataFrame:
    ordinary = tr.circle_assignment(i("branch_master"), broadcast_if_small(i("circle_master"))[0])
    own = i("circle_master").select("BRANCH_CODE", F.col("BRANCH_CODE").alias("CIRCLE_CODE"))
    return ordinary.withColumn("KIND", F.lit("ordinary")).unionByName(own.withColumn("KIND", F.lit("circle")))


def transfer(i: Inputs) -> TransferResult:
    profit = tr.latest_income_expense(i("balance_table"))
    branches, circles = broadcast_if_small(i("branch_master"), i("circle_master"))
    return pl_transfer(profit, branches, circles, DAY, "B1", "J1")


@query("select * from o_legs")
def transfer_postings_opr26(i: Inputs) -> DataFrame:
    return transfer(i).postings


@query("select * from o_transfer_balance")
def transfer_balances_opr27(i: Inputs) -> DataFrame:
    return transfer(i).balances


REPORT = """
    select BALANCE_DATE TRANSFER_DATE, BALANCE PROFIT_LOSS, m.CIRCLE_CODE CIRCLE_BRANCH_CODE, t.BRANCH_CODE
    from o_transfer_balance t left join (select CODE, b.BRANCH_CODE CIRCLE_CODE from branch_master a
      left join circle_master b on a.CIRCLE_CODE = b.CIRCLE_CODE) m on m.CODE = t.BRANCH_CODE
    where CGL = '2110505001'"""


@query(REPORT)
def transfer_report_opr28(i: Inputs) -> DataFrame:
    return transfer(i).report


@query(REPORT)
def pl_transfer_opr29(i: Inputs) -> DataFrame:
    profit = tr.latest_income_expense(i("balance_table"))
    small = broadcast_if_small(i("branch_master"), i("circle_master"))
    path = new_folder(i.spark, "transfer")
    for _ in range(2):
        run_pl_transfer(profit, *small, DAY, path, "B1", "J1")
    return read_lake(i.spark, f"{path}/report")


@query("""
    select CGL, CURRENCY, BRANCH_CODE, date '2001-01-02' BALANCE_DATE, BALANCE, INR_BALANCE from closing_balance""")
def open_next_day_opr30(i: Inputs) -> DataFrame:
    return opening_after(i, DAY)


def opening_after(i: Inputs, day: dt.date, calendar: str = "calendar") -> DataFrame:
    forward, circles = broadcast_if_small(
        ms.flagged_cgls(i("cgl_master"), "BAL_FWD"), ms.circle_keys(i("circle_master"))
    )
    return op.open_next_day(i("closing_balance"), day, forward, circles, i(calendar))


@query("select * from o_year_end_open")
def year_end_forward_opr31(i: Inputs) -> DataFrame:
    return opening_after(i, YEAR_END_DAY)


@query("""
    select 'active' GATE, cast(count(*) as bigint) ROWS_OPENED from o_year_end_open
    where exists (select 1 from calendar where ACTIVE_FLAG = 1)
    union all select 'inactive', cast(count(*) as bigint) from o_year_end_open
    where exists (select 1 from calendar where ACTIVE_FLAG = 1 and FIN_YEAR >= 2001)""")
def year_end_gate_opr32(i: Inputs) -> DataFrame:
    forward, circles = broadcast_if_small(
        ms.flagged_cgls(i("cgl_master"), "BAL_FWD"), ms.circle_keys(i("circle_master"))
    )
    later = i("calendar").filter(F.col("FIN_YEAR") >= 2001)

    def opened(gate: str, calendar: DataFrame) -> DataFrame:
        rows = op.open_next_day(i("closing_balance"), YEAR_END_DAY, forward, circles, calendar)
        return rows.agg(F.count(F.lit(1)).alias("ROWS_OPENED")).select(F.lit(gate).alias("GATE"), "ROWS_OPENED")

    return opened("active", i("calendar")).unionByName(opened("inactive", later))


@query(f"""
    select {KEY} glcc, BALANCE closing_balance, INR_BALANCE, BALANCE_DATE from o_year_end_open
    union all select {KEY}, BALANCE, INR_BALANCE, date '2001-01-02' from closing_balance""")
def write_opening_opr33(i: Inputs) -> DataFrame:
    lake_path, table_path = new_folder(i.spark, "lake"), new_folder(i.spark, "table")
    write_opening(opening_after(i, DAY), DAY, lake_path, table_path)
    for _ in range(2):
        write_opening(opening_after(i, YEAR_END_DAY), YEAR_END_DAY, lake_path, table_path)
    return read_lake(i.spark, lake_path)


