"""Queries for projections, joins, aggregations, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook import functions as fn
from daybook.functions.text import STRICT_FILE_PATTERN
from daybook.operators import balances as bal
from daybook.operators import differences as diff
from daybook.operators import lookups as lk
from daybook.operators import movements as mov
from daybook.operators import parse
from daybook.operators import postings as post
from daybook.operators import rowcounts as rc
from daybook.operators import transfers as tr
from daybook.operators import validation as val
from daybook.session import broadcast_if_small
from daybook.sources import masters as ms
from daybook.sources import text_files as tf
from workload.fixtures import DAY, KEY, MILLIS, MONEY, POSTING, POSTING_SUMS
from workload.registry import Inputs, query

KEY_LAYOUT = parse.layout_fields(
    {"COLUMN_NAME": name, "START_POSITION": start, "END_POSITION": end, "TO_BE_INCLUDED": include}
    for name, start, end, include in (
        ("BRANCH_CODE", 1, 6, "yes"),
        ("CURRENCY", 6, 9, "yes"),
        ("CGL", 9, 19, "yes"),
        ("AMOUNT", 19, 36, "yes"),
        ("POST_DATE", 36, 42, "yes"),
        ("POST_TIME", 42, 50, "YES"),
        ("FILLER", 50, 60, "no"),
    )
)


def decoded(name: str) -> str:
    """The decoded amount in SQL."""
    return (
        f"cast(cast(translate({name},'pqrstuvwxy','0123456789') as bigint) * (case when {name} similar to '.*[p-y]' "
        f"then -1 else 1 end) as decimal(18,0)) * cast(0.001 as decimal(4,3))"
    )


SERIAL_TEXT = "lpad(cast(date_diff('day', date '1899-12-31', POST_DATE) as varchar),6,'0')"


@query(f"""
    select BRANCH_CODE, CURRENCY, CGL, AMOUNT, {SERIAL_TEXT} POST_DATE, lpad(cast({MILLIS} as varchar),8,'0') POST_TIME
    from ledger_raw""")
def fixed_width_parse_prj01(i: Inputs) -> DataFrame:
    return parse.parse_fixed_width(i("key_text"), KEY_LAYOUT)


@query("""
    select CGL_NUMBER, STATUS, BAL_COMPARE, BAL_FWD from cgl_master where STATUS = '1'""")
def include_flag_prj02(i: Inputs) -> DataFrame:
    flag = F.when(F.col("STATUS") == "1", F.when(F.col("BAL_FWD") == 1, "yes").otherwise("Yes ")).otherwise("no")
    return parse.included(i("cgl_master").withColumn("TO_BE_INCLUDED", flag)).drop("TO_BE_INCLUDED")


@query("""
    select BRANCH_CODE, CGL, case when CURRENCY_IND <> 'INR' then FOREIGN_AMOUNT else AMOUNT end AMOUNT_RAW
    from ledger_entry""")
def effective_amount_prj03(i: Inputs) -> DataFrame:
    amount = fn.effective_amount("CURRENCY_IND", "FOREIGN_AMOUNT", "AMOUNT")
    return i("ledger_entry").select("BRANCH_CODE", "CGL", amount.alias("AMOUNT_RAW"))


@query("""
    select FILE_NAME, l_orderkey from ledger_raw
    where lower(FILE_NAME) not like 'glifpri%' and lower(FILE_NAME) not like 'glifprb%'""")
def exclude_file_types_prj04(i: Inputs) -> DataFrame:
    return mov.exclude_file_types(i("ledger_raw")).select("FILE_NAME", "l_orderkey")


@query(f"select {KEY} GLCC, BRANCH_CODE, CURRENCY, CGL from ledger_raw")
def glcc_compose_split_prj05(i: Inputs) -> DataFrame:
    keyed = i("ledger_raw").select(fn.compose_glcc().alias("GLCC"))
    return keyed.withColumns(fn.split_glcc("GLCC"))


@query("select *, date '2001-01-01' TRANSACTION_DATE from o_postings")
def constant_columns_prj06(i: Inputs) -> DataFrame:
    return post.dated(i.postings(), DAY)


@query(f"""
    select l_orderkey, cast(case when AMT > 0 then AMT else 0 end as {MONEY}) CREDIT_AMOUNT,
      cast(case when AMT < 0 then AMT else 0 end as {MONEY}) DEBIT_AMOUNT from ledger
    where lower(FILE_NAME) not like 'glifpri%' and lower(FILE_NAME) not like 'glifprb%'""")
def split_signed_prj07(i: Inputs) -> DataFrame:
    return mov.split_signed(i.lines()).select("l_orderkey", "CREDIT_AMOUNT", "DEBIT_AMOUNT")


@query(f"select {POSTING} from posted_table")
def select_by_list_prj08(i: Inputs) -> DataFrame:
    return i("posted_table").select(*mov.POSTING_COLUMNS)


@query("select BATCH_ID, ltrim(JOURNAL_ID, '0') JOURNAL_ID, SOURCE_FLAG from posted_table")
def conditional_by_presence_prj09(i: Inputs) -> DataFrame:
    changes = {"JOURNAL_ID": fn.strip_zeros("JOURNAL_ID"), "ACCOUNT": fn.strip_zeros("ACCOUNT")}
    return parse.replace_present(i("posted_table").select("BATCH_ID", "JOURNAL_ID", "SOURCE_FLAG"), changes)


@query("select BRANCH_CODE, CURRENCY, CGL, cast(null as varchar) JOURNAL_ID, 'B1' BATCH_ID from o_postings")
def null_literal_prj10(i: Inputs) -> DataFrame:
    totals = mov.as_postings(mov.key_totals(i.lines()), "B1")
    return totals.select("BRANCH_CODE", "CURRENCY", "CGL", "JOURNAL_ID", "BATCH_ID")


@query("""
    select CGL, CURRENCY, BRANCH_CODE, case when CGL like '5%' then 'memo' when CGL like '7%' or CGL like '8%'
      then 'income or expense' else 'other' end KIND from closing_balance""")
def regex_prefix_filter_prj11(i: Inputs) -> DataFrame:
    memo = F.startswith(F.col("CGL"), F.lit(val.MEMO_PREFIX))
    kind = F.when(memo, "memo").when(tr.is_income_expense(), "income or expense")
    return i("closing_balance").select("CGL", "CURRENCY", "BRANCH_CODE", kind.otherwise("other").alias("KIND"))


@query("select * from o_journals")
def membership_prj12(i: Inputs) -> DataFrame:
    return post.carried_journals(i("posted_table"), DAY)


@query("""
    select coalesce(c.FILE_NAME, r.FILE_NAME) FILE_NAME, HDFS_ROW_COUNT, n DATA_LAKE_COUNT,
      cast(null as varchar) DATA_LAKE_STATUS from control_file c
    full join (select FILE_NAME, cast(count(*) as bigint) n from ledger_raw group by 1) r on r.FILE_NAME = c.FILE_NAME
    where n is null or HDFS_ROW_COUNT is null or n <> HDFS_ROW_COUNT""")
def null_test_prj13(i: Inputs) -> DataFrame:
    return rc.unmatched_files(rc.row_count_status(i("control_file"), rc.file_row_counts(i("ledger_raw"))))


@query("select * from o_difference")
def nonzero_filter_prj14(i: Inputs) -> DataFrame:
    rows = diff.balance_difference(i("gl_side"), i("cbs_side"))
    return rows


@query(f"""
    select FILE_NAME, {KEY} GLCC, CURRENCY CURRENCY_IND, AMOUNT, FOREIGN_AMOUNT,
      case when CURRENCY <> 'INR' then FOREIGN_AMOUNT else AMOUNT end AMOUNT_RAW from ledger_entry""")
def fixed_position_project_prj15(i: Inputs) -> DataFrame:
    return parse.parse_raw_ledger(i("raw_text"), keep=["FILE_NAME"])


@query("select p.*, case when CODE is not null then 1 end KNOWN_BRANCH from o_postings p "
       "left join (select distinct CODE from branch_master) b on CODE = BRANCH_CODE")
def master_validation_left_jon01(i: Inputs) -> DataFrame:
    return lk.flag_known(i.postings(), i.masters().branches, "BRANCH_CODE", "KNOWN_BRANCH")


@query("""
    select CGL, c.CURRENCY, BRANCH_CODE, BALANCE, INR_BALANCE, m.CURRENCY_RATE from closing_balance c
    left join currency_master m on m.CURRENCY_CODE = c.CURRENCY""")
def rate_lookup_left_jon02(i: Inputs) -> DataFrame:
    return lk.with_rate(i("closing_balance"), i.masters().rates)


@query('select * from o_classified')
def previous_state_left_jon03(i: Inputs) -> DataFrame:
    today = diff.balance_difference(i("gl_side"), i("cbs_side"))
    rows = diff.classify_change(today, i("previous_difference"), DAY)
    return rows


@query("""
    select coalesce(c.FILE_NAME, r.FILE_NAME) FILE_NAME, HDFS_ROW_COUNT, n ROW_COUNT from control_file c
    full join (select FILE_NAME, cast(count(*) as bigint) n from ledger_raw group by 1) r on r.FILE_NAME = c.FILE_NAME
    """)
def count_full_outer_jon04(i: Inputs) -> DataFrame:
    return rc.compare_counts(i("control_file"), rc.file_row_counts(i("ledger_raw")))


def profit_totals(i: Inputs) -> DataFrame:
    return tr.branch_totals(tr.latest_income_expense(i("balance_table")))


@query("select BRANCH_CODE, CIRCLE_CODE, BALANCE from o_circle_profit")
def inner_by_not_null_jon05(i: Inputs) -> DataFrame:
    circles = i("circle_master").select("BRANCH_CODE", "CIRCLE_CODE")
    return tr.branch_profit(profit_totals(i), circles)


@query("""
    select CGL, CURRENCY, BRANCH_CODE, BALANCE from closing_balance
    where trim(CGL) in (select trim(CGL_NUMBER) from cgl_master where BAL_FWD = 1)""")
def trimmed_key_inner_jon06(i: Inputs) -> DataFrame:
    padded = i("cgl_master").withColumn("CGL_NUMBER", F.concat(F.lit(" "), "CGL_NUMBER", F.lit("  ")))
    (cgls,) = broadcast_if_small(ms.flagged_cgls(padded, "BAL_FWD"))
    kept = lk.keep_known_trimmed(i("closing_balance"), cgls, "CGL", "CGL")
    return kept.select("CGL", "CURRENCY", "BRANCH_CODE", "BALANCE")


@query("""
    select BRANCH_CODE, CGL, CURRENCY, BALANCE from closing_balance
    where BRANCH_CODE in (select BRANCH_CODE from circle_master)""")
def using_inner_jon07(i: Inputs) -> DataFrame:
    (circles,) = broadcast_if_small(i("circle_master").select("BRANCH_CODE"))
    return lk.keep_known(i("closing_balance"), circles, "BRANCH_CODE").select("BRANCH_CODE", "CGL", "CURRENCY", "BALANCE")


@query("""
    select CODE, CIRCLE_CODE from branch_master a
    where not exists (select 1 from circle_master b where b.BRANCH_CODE = a.CODE)""")
def not_exists_anti_jon08(i: Inputs) -> DataFrame:
    branches = i("branch_master")
    (circles,) = broadcast_if_small(i("circle_master").select(F.col("BRANCH_CODE").alias("CODE")))
    return lk.keep_unknown(branches, circles, "CODE").select("CODE", "CIRCLE_CODE")


@query("""
    select CODE BRANCH_CODE, b.BRANCH_CODE CIRCLE_CODE from branch_master a
    left join circle_master b on a.CIRCLE_CODE = b.CIRCLE_CODE""")
def left_outer_circle_jon09(i: Inputs) -> DataFrame:
    return tr.branch_circles(i("branch_master"), *broadcast_if_small(i("circle_master")))


@query("""
    select BALANCE_DATE TRANSFER_DATE, BALANCE PROFIT_LOSS, m.CIRCLE_CODE CIRCLE_BRANCH_CODE, t.BRANCH_CODE
    from o_transfer_balance t left join (select CODE, b.BRANCH_CODE CIRCLE_CODE from branch_master a
      left join circle_master b on a.CIRCLE_CODE = b.CIRCLE_CODE) m on m.CODE = t.BRANCH_CODE
    where CGL = '2110505001'""")
def report_left_jon10(i: Inputs) -> DataFrame:
    from daybook.plans.transfer_day import pl_transfer

    profit = tr.latest_income_expense(i("balance_table"))
    return pl_transfer(profit, i("branch_master"), i("circle_master"), DAY, "B1", "J1").report


@query("""
    select FILE_NAME, HDFS_ROW_COUNT from control_file
    where substring(FILE_NAME,1,7) in (select FILE_PATTERN from file_types where FREQUENCY like '%D%')""")
def file_type_filter_jon11(i: Inputs) -> DataFrame:
    prefix = F.regexp_extract("FILE_NAME", r"^(.*?)_(\d{8})_([a-zA-Z])_.*$", 1)
    return lk.files_of_frequency(i("control_file"), i("file_types"), "D", prefix)


@query(f"""
    select {KEY} GLCC, CREDIT_AMOUNT, DEBIT_AMOUNT, TRANSACTION_COUNT from o_postings""")
def key_totals_agg01(i: Inputs) -> DataFrame:
    return mov.key_totals(i.lines())


@query(f"""
    select {POSTING} from (select CGL, CURRENCY, BRANCH_CODE, SOURCE_FLAG, {POSTING_SUMS} from posted_table
      group by CGL, CURRENCY, BRANCH_CODE, SOURCE_FLAG) t""")
def consolidate_postings_agg02(i: Inputs) -> DataFrame:
    return post.consolidate(i("posted_table"))


@query("select * from o_bucket")
def bucket_net_agg03(i: Inputs) -> DataFrame:
    masters = i.masters()
    valid, _ = val.validate(i.postings(), masters.branches, masters.currencies, masters.cgls, DAY)
    return post.bucket_net(valid)


@query(f"""
    select glcc, cast(sum(b) as {MONEY}) BALANCE, date '2001-01-01' BALANCE_DATE from (
      select {KEY} glcc, CREDIT_AMOUNT+DEBIT_AMOUNT b from o_postings union all
      select glcc, BALANCE from opening_balance) t group by glcc""")
def balance_sum_agg04(i: Inputs) -> DataFrame:
    return bal.carry_forward(bal.movement_balances(i.postings()), i("opening_balance"), DAY)


@query(f"""
    select GLCC, cast(sum(c) as {MONEY}) cbs_balance, cast(sum(g) as {MONEY}) gl_balance from (
      select GLCC, CBS_BALANCE c, 0 g from cbs_side union all select GLCC, 0, GL_BALANCE from gl_side) t group by 1""")
def signed_union_compare_agg05(i: Inputs) -> DataFrame:
    return diff.signed_union(i("gl_side"), i("cbs_side"))


@query("select FILE_NAME, cast(count(*) as bigint) ROW_COUNT from ledger_raw group by 1")
def file_row_count_agg06(i: Inputs) -> DataFrame:
    return rc.file_row_counts(i("ledger_raw"))


@query("select BRANCH_CODE, CIRCLE_CODE, BALANCE from o_profit")
def branch_pl_sum_agg07(i: Inputs) -> DataFrame:
    assignment = tr.circle_assignment(i("branch_master"), i("circle_master"))
    return tr.branch_profit(profit_totals(i), assignment)


HEAD_COUNTS = """
    select RECON_RUN_DATE, HEAD, cast(count(*) as bigint) "Total_no_of_entries",
      cast(sum(case when "type" = 'New Entry' then 1 else 0 end) as bigint) "new entry" from o_daily group by 1, 2"""


def compared(i: Inputs) -> DataFrame:
    """Accounts that take part in the daily comparison."""
    return broadcast_if_small(ms.flagged_cgls(i("cgl_master"), "BAL_COMPARE"))[0]


def daily(i: Inputs) -> DataFrame:
    from daybook.plans.difference_day import daily_difference

    rows = daily_difference(i("gl_side"), i("cbs_side"), i("previous_difference"), compared(i), DAY)
    return rows


@query(HEAD_COUNTS)
def conditional_count_agg08(i: Inputs) -> DataFrame:
    return diff.head_counts(daily(i))


SUMMARY_JSON = f"""
    select concat('{{"RECON_RUN_DATE":"', cast(RECON_RUN_DATE as varchar), '","summary":[',
      string_agg(concat('{{"HEAD":"', HEAD, '","Total_no_of_entries":', cast("Total_no_of_entries" as varchar),
        ',"new entry":', cast("new entry" as varchar), '}}'), ',' order by HEAD), ']}}') summary_json
    from ({HEAD_COUNTS}) c group by RECON_RUN_DATE"""


@query(SUMMARY_JSON)
def nested_collect_agg09(i: Inputs) -> DataFrame:
    return diff.difference_summary(daily(i))


@query("select max(BALANCE_DATE) BALANCE_DATE from balance_table")
def global_max_agg10(i: Inputs) -> DataFrame:
    return i("balance_table").filter(F.col("BALANCE_DATE") == tr.latest_date(i("balance_table"))).select("BALANCE_DATE").distinct()


@query("select cast(count(*) as bigint) ROWS_READ from ledger_raw")
def row_count_agg11(i: Inputs) -> DataFrame:
    return rc.total_rows(rc.file_row_counts(i("ledger_raw")))


@query("select * from o_postings union all select * from o_journals")
def union_by_name_set01(i: Inputs) -> DataFrame:
    return post.union_postings(i.postings(), post.carried_journals(i("posted_table"), DAY))


@query("select glcc, BALANCE from opening_balance union all select GLCC, GL_BALANCE from gl_side")
def union_positional_set02(i: Inputs) -> DataFrame:
    return bal.united(i("opening_balance"), i("gl_side"))


@query("""
    select distinct FILE_NAME, substring(FILE_NAME,18,1) STREAM, concat('/in/', substring(FILE_NAME,18,1), '/',
      FILE_NAME, '.gz') PATH from ledger_raw""")
def distinct_rows_set03(i: Inputs) -> DataFrame:
    named = i("ledger_raw").select("FILE_NAME", F.substring("FILE_NAME", 18, 1).alias("STREAM"))
    return tf.control_paths_direct(named, "/in")


@query(f"select l_orderkey, cast({decoded('AMOUNT')} as {MONEY}) AMT from ledger_raw")
def decode_overpunch_fixed_scl01(i: Inputs) -> DataFrame:
    return i("ledger_raw").select("l_orderkey", fn.decode_overpunch("AMOUNT", 17).cast(MONEY).alias("AMT"))


@query(f"""
    select l_orderkey, cast({decoded('A')} as {MONEY}) AMT from (
      select l_orderkey, case when ltrim(AMOUNT,'0') = '' then '0' else ltrim(AMOUNT,'0') end A from ledger_raw) t""")
def decode_overpunch_var_scl02(i: Inputs) -> DataFrame:
    short = F.ltrim(F.col("AMOUNT"), F.lit("0"))
    short = F.when(short == "", "0").otherwise(short)
    return i("ledger_raw").select("l_orderkey", fn.decode_overpunch(short).cast(MONEY).alias("AMT"))


@query("select l_orderkey, translate(AMOUNT,'pqrstuvwxy','0123456789') AMOUNT from ledger_raw")
def overpunch_to_digits_scl03(i: Inputs) -> DataFrame:
    return i("ledger_raw").select("l_orderkey", fn.overpunch_to_digits("AMOUNT").alias("AMOUNT"))


@query(f"""
    select l_orderkey, cast(cast(round(l_extendedprice*100) as decimal(18,0)) * cast(0.01 as decimal(3,2))
      * (case when l_linestatus='F' then -1 else 1 end) as {MONEY}) AMT from lineitem""")
def decode_trailing_sign_scl04(i: Inputs) -> DataFrame:
    amount = fn.decode_trailing_sign(F.substring("value", 18, 17))
    return i("account_text").select(
        F.substring("value", 1, 17).cast("bigint").alias("l_orderkey"), amount.alias("AMT")
    )


@query("select FILE_NAME, POST_DATE from ledger_raw")
def serial_day_scl05(i: Inputs) -> DataFrame:
    return i("key_text").select("FILE_NAME", fn.serial_day(F.substring("value", 36, 6)).alias("POST_DATE"))


@query(f"""
    select FILE_NAME, concat(lpad(cast(ms // 3600000 as varchar),2,'0'), ':',
      lpad(cast(ms % 3600000 // 60000 as varchar),2,'0'), ':',
      lpad(cast(ms % 60000 // 1000 as varchar),2,'0')) CLOCK
    from (select FILE_NAME, {MILLIS} ms from ledger_raw) t""")
def millis_to_clock_scl06(i: Inputs) -> DataFrame:
    return i("key_text").select("FILE_NAME", fn.clock_from_millis(F.substring("value", 42, 8)).alias("CLOCK"))


@query("select ltrim(lpad(cast(l_orderkey as varchar),17,'0'),'0') ACCOUNT from lineitem")
def strip_leading_zeros_scl07(i: Inputs) -> DataFrame:
    return i("account_text").select(fn.strip_zeros(F.substring("value", 1, 17)).alias("ACCOUNT"))


@query("select right(CGL,4) LAST_4, right(CGL,2) LAST_2 from ledger_raw")
def code_tail_scl08(i: Inputs) -> DataFrame:
    return i("ledger_raw").select(fn.tail("CGL", 4).alias("LAST_4"), fn.tail("CGL", 2).alias("LAST_2"))


@query("""
    select case when l_linenumber in (3, 4) then 'NA' else ltrim(lpad(cast(l_orderkey as varchar),17,'0'),'0') end
      ACCOUNT from lineitem""")
def constant_override_scl09(i: Inputs) -> DataFrame:
    layouts = {name: [parse.Field("ACCOUNT", 1, 18)] for name in parse.SIGNED_COLUMNS}
    return parse.account_rows_of_types(i("account_text"), layouts).select("ACCOUNT")


@query("""
    select regexp_extract(FILE_NAME,'^(.*?)(\\d{8})_([a-zA-Z])_.*$',1) PREFIX,
      regexp_extract(FILE_NAME,'^(.*?)(\\d{8})_([a-zA-Z])_.*$',2) FILE_DAY,
      regexp_extract(FILE_NAME,'^(.*?)(\\d{8})_([a-zA-Z])_.*$',3) STREAM, l_orderkey from ledger_raw""")
def pattern_stream_scl10(i: Inputs) -> DataFrame:
    parts = {"PREFIX": "prefix", "FILE_DAY": "date", "STREAM": "stream"}
    columns = [fn.file_name_part("FILE_NAME", part, STRICT_FILE_PATTERN).alias(name) for name, part in parts.items()]
    return i("ledger_raw").select(*columns, "l_orderkey")
