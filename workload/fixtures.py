"""Ledger inputs derived from the given tables.

Every view is SQL that Spark and DuckDB read alike. Views build on each other; ``with_views`` puts those that a query
needs in front of it as common table expressions.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

DAY = dt.date(2001, 1, 1)
YEAR_END_DAY = dt.date(2001, 3, 31)
BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Days since 1899-12-31, which the two dialects spell differently.
SERIAL = {
    "spark": "datediff(cast(l_shipdate as date), date '1899-12-31')",
    "duckdb": "date_diff('day', date '1899-12-31', cast(l_shipdate as date))",
}


def text(number: str) -> str:
    return f"cast({number} as varchar(20))"


def padded(number: str, width: int) -> str:
    return f"lpad({text(number)},{width},'0')"


def overpunched(amount: str) -> str:
    """17 characters in thousandths; lines of status F are negative."""
    digits = padded(f"cast(floor({amount}*1000+0.5) as bigint)", 17)
    last = f"substring({digits},17,1)"
    marked = f"case when l_linestatus='F' then translate({last},'0123456789','pqrstuvwxy') else {last} end"
    return f"concat(substring({digits},1,16),{marked})"


def signed_text(amount: str) -> str:
    """17 characters with two decimals and a trailing sign; lines of status F are negative."""
    digits = padded(f"cast(floor({amount}*100+0.5) as bigint)", 15)
    sign = "case when l_linestatus='F' then '-' else '+' end"
    return f"concat(substring({digits},1,13),'.',substring({digits},14,2),{sign})"


BRANCH = padded("l_suppkey", 5)
CURRENCY = "case l_returnflag when 'A' then 'INR' when 'N' then 'USD' else 'EUR' end"
CGL = f"concat({text('1+l_partkey%8')},{padded('l_partkey%50', 9)})"
FILE_NAME = (
    "concat(case l_linenumber when 6 then 'GLIFPRI' when 7 then 'glifprb' else 'GLIFCOR' end,'_01012026_',"
    "substring('ABC',cast(1+l_suppkey%3 as int),1),'_001')"
)
FILE_TYPE = (
    "case l_linenumber when 1 then 'INV' when 2 then 'BOR' when 3 then 'GLCCGEN' when 4 then 'GLCCCTA' "
    "else 'GLCCINV' end"
)
MILLIS = "cast((l_orderkey*7919000+l_linenumber*1000)%86400000 as bigint)"
RATE = "case when CURRENCY='USD' then cast(83.2500 as decimal(10,4)) else cast(1 as decimal(10,4)) end"
ZERO = "cast(0 as decimal(25,4))"
MONEY = "decimal(25,4)"

VIEWS = {
    # Lines as the ledger job reads them: encoded amount, key parts, file name.
    "ledger_raw": f"""
        select {BRANCH} BRANCH_CODE, {CURRENCY} CURRENCY, {CGL} CGL, {overpunched('l_extendedprice')} AMOUNT,
          {FILE_NAME} FILE_NAME, l_orderkey, l_linenumber, cast(l_shipdate as date) POST_DATE from lineitem""",
    # The same with a foreign amount and a currency indicator of its own.
    "ledger_entry": f"""
        select {BRANCH} BRANCH_CODE, {CURRENCY} CURRENCY, {CGL} CGL, {overpunched('l_extendedprice')} AMOUNT,
          {overpunched('l_quantity')} FOREIGN_AMOUNT,
          case when l_tax > 0.06 then 'INR' else {CURRENCY} end CURRENCY_IND, {FILE_NAME} FILE_NAME from lineitem""",
    # Fixed-width lines of the key layout.
    "key_text": f"""
        select concat({BRANCH},{CURRENCY},{CGL},{overpunched('l_extendedprice')},{padded('{serial}', 6)},
          {padded(MILLIS, 8)},'  filler  ') value, {FILE_NAME} FILE_NAME from lineitem""",
    # Fixed-width lines at the positions of a raw ledger line.
    "raw_text": f"""
        select concat(lpad('',47,'#'),{CURRENCY},{BRANCH},{CURRENCY},{CGL},lpad('',47,'#'),
          {overpunched('l_extendedprice')},{overpunched('l_quantity')}) value, {FILE_NAME} FILE_NAME from lineitem""",
    # Fixed-width lines of the full ledger layout.
    "ledger_text": f"""
        select concat({padded('l_orderkey', 17)},{CURRENCY},{overpunched('l_quantity')},
          {overpunched('l_extendedprice')},{padded('{serial}', 6)},{padded('{serial}+2', 6)},{padded(MILLIS, 8)},
          {BRANCH},{CGL}) value, {FILE_NAME} FILE_NAME from lineitem""",
    # Fixed-width lines of the account files.
    "account_text": f"""
        select concat({padded('l_orderkey', 17)},{signed_text('l_extendedprice')},{signed_text('l_quantity')},
          {padded('l_partkey', 10)},{padded('l_suppkey', 8)}) value, {FILE_TYPE} FILE_TYPE from lineitem""",
    # The same lines by file: one file a type and stream, the type's name in front.
    "account_lines": f"""
        select l_orderkey, {FILE_TYPE} FILE_TYPE,
          concat({FILE_TYPE},'_01012026_',substring('AB',cast(1+l_suppkey%2 as int),1),'_001') FILE_NAME from lineitem""",
    "account_file_text": f"""
        select concat({padded('l_orderkey', 17)},{signed_text('l_extendedprice')},{signed_text('l_quantity')},
          {padded('l_partkey', 10)},{padded('l_suppkey', 8)}) value, l_orderkey,
          concat({FILE_TYPE},'_01012026_',substring('AB',cast(1+l_suppkey%2 as int),1),'_001') FILE_NAME from lineitem""",
    # One file is short by one, one is not there, one is there but not announced, one is of a type nobody knows.
    "account_control": """
        select FILE_NAME, cast(count(*) + (case when FILE_NAME='INV_01012026_B_001' then 1 else 0 end) as bigint)
          HDFS_ROW_COUNT from account_lines where FILE_NAME <> 'GLCCGEN_01012026_A_001' group by FILE_NAME
        union all select concat(min(FILE_TYPE),'_01012026_Z_001'), cast(10 as bigint) from account_lines
        union all select concat('X',min(FILE_NAME)), cast(10 as bigint) from account_lines""",
    "branch_master": """
        select lpad(cast(s_suppkey as varchar(20)),5,'0') CODE, s_nationkey % 5 CIRCLE_CODE from supplier
        where s_suppkey % 17 <> 0""",
    "circle_master": """
        select cast(n_regionkey as int) CIRCLE_CODE, lpad(cast(min(n_nationkey) as varchar(20)),5,'0') BRANCH_CODE
        from nation group by n_regionkey""",
    # Two currencies; a rate for EUR is missing on purpose. The rows hang on the nations only to be read from a table.
    "currency_master": """
        select distinct case when n_nationkey % 2 = 0 then 'INR' else 'USD' end CURRENCY_CODE,
          case when n_nationkey % 2 = 0 then cast(1 as decimal(10,4)) else cast(83.2500 as decimal(10,4)) end
          CURRENCY_RATE from nation""",
    "cgl_master": """
        select distinct concat(cast(1+p_partkey%8 as varchar(20)), lpad(cast(p_partkey%50 as varchar(20)),9,'0'))
          CGL_NUMBER, case when p_partkey%200%11=0 then '0' else '1' end STATUS,
          case when p_partkey%200%7=0 then 0 else 1 end BAL_FWD,
          case when p_partkey%200%5=0 then 0 else 1 end BAL_COMPARE from part""",
    # An active year for every order year but the last.
    "calendar": """
        select year(o_orderdate) FIN_YEAR, case when year(o_orderdate) < 2001 then 1 else 0 end ACTIVE_FLAG
        from orders group by 1, 2""",
    # File types with the frequencies at which they are due.
    "file_types": """
        select distinct substring(FILE_NAME,1,7) FILE_PATTERN,
          case substring(FILE_NAME,1,7) when 'GLIFPRI' then 'M,Y' else 'D' end FREQUENCY from ledger_raw""",
    # Decoded lines, by the decoder of the checking side.
    "ledger": """
        select BRANCH_CODE, CURRENCY, CGL, POST_DATE, FILE_NAME, l_orderkey,
          cast(cast(translate(AMOUNT,'pqrstuvwxy','0123456789') as bigint)
           * (case when substring(AMOUNT,17,1) in ('p','q','r','s','t','u','v','w','x','y') then -1 else 1 end)
           as decimal(18,0)) * cast(0.001 as decimal(4,3)) AMT from ledger_raw""",
    # One file is short by one, one is missing from the read side, one extra is not expected.
    "control_file": """
        select FILE_NAME,
          cast(count(*) + (case when FILE_NAME='GLIFCOR_01012026_B_001' then 1 else 0 end) as bigint) HDFS_ROW_COUNT
        from ledger_raw where FILE_NAME <> 'glifprb_01012026_C_001' group by FILE_NAME
        union all select concat(substring(min(FILE_NAME),1,17),'Z_001'), cast(10 as bigint) from ledger_raw""",
    # The control table of two dates, with the status columns.
    "control_table": """
        select FILE_NAME, HDFS_ROW_COUNT, date '2001-01-01' ETL_DAY, cast(null as bigint) DATA_LAKE_COUNT,
          cast(null as varchar(20)) DATA_LAKE_STATUS from control_file
        union all select FILE_NAME, HDFS_ROW_COUNT, date '2000-12-31', HDFS_ROW_COUNT, 'YES' from control_file""",
    "opening_balance": f"""
        select concat(BRANCH_CODE,CURRENCY,CGL) glcc, cast(sum(AMT) as {MONEY}) BALANCE
        from ledger where POST_DATE < date '2001-01-01' group by 1""",
    "gl_side": f"""
        select concat(BRANCH_CODE,CURRENCY,CGL) GLCC, cast(sum(AMT) as {MONEY}) GL_BALANCE from ledger group by 1""",
    "cbs_side": f"""
        select concat(BRANCH_CODE,CURRENCY,CGL) GLCC, cast(sum(AMT) as {MONEY}) CBS_BALANCE
        from ledger where l_orderkey % 13 <> 0 group by 1""",
    # Balances of four days in a row; some accounts differ on some of the days, some are mended and differ again.
    "gl_days": f"""
        select concat(BRANCH_CODE,CURRENCY,CGL) GLCC, cast(sum(AMT) as {MONEY}) GL_BALANCE, BALANCE_DATE
        from ledger cross join (
          select date '2001-01-01' BALANCE_DATE union all select date '2001-01-02' union all select date '2001-01-03'
          union all select date '2001-01-04') d
        group by 1, 3""",
    "cbs_days": f"""
        select concat(BRANCH_CODE,CURRENCY,CGL) GLCC, BALANCE_DATE,
          cast(sum(case when l_orderkey % 13 <> n and l_orderkey % 7 <> least(n, 2) then AMT else 0 end) as {MONEY}) CBS_BALANCE
        from ledger cross join (
          select date '2001-01-01' BALANCE_DATE, 0 n union all select date '2001-01-02', 1
          union all select date '2001-01-03', 2 union all select date '2001-01-04', 3) d
        group by 1, 2""",
    "previous_difference": f"""
        select GLCC, cast(c - g as {MONEY}) YESTERDAY_DIFFERENCE, date '2000-12-31' FIRST_ERROR_DATE from (
          select concat(BRANCH_CODE,CURRENCY,CGL) GLCC, sum(AMT) g,
            coalesce(sum(case when l_orderkey % 13 <> 0 then AMT end), 0) c
          from ledger where POST_DATE < date '2000-01-01' group by 1) t
        where c <> g""",
    "closing_balance": f"""
        select CGL, CURRENCY, BRANCH_CODE, cast(sum(AMT) as {MONEY}) BALANCE,
          cast(round(sum(AMT)*max({RATE}),2) as {MONEY}) INR_BALANCE from ledger group by 1,2,3""",
    # Balances of two dates in the shape of the database table.
    "balance_table": f"""
        select CGL, CURRENCY, BRANCH_CODE,
          case when POST_DATE < date '1999-01-01' then date '2000-12-31' else date '2001-01-01' end BALANCE_DATE,
          cast(sum(AMT) as {MONEY}) BALANCE, cast(round(sum(AMT)*max({RATE}),2) as {MONEY}) INR_BALANCE
        from ledger group by 1,2,3,4""",
    # The same in the shape of the lake table.
    "lake_balance": """
        select concat(BRANCH_CODE,CURRENCY,CGL) glcc, BALANCE closing_balance, INR_BALANCE, BALANCE_DATE
        from balance_table""",
    "year_end_balance": f"""
        select CGL, CURRENCY, BRANCH_CODE, date '2001-04-01' BALANCE_DATE, cast(-BALANCE as {MONEY}) BALANCE,
          INR_BALANCE from closing_balance""",
    # Posted transactions of two dates with all kinds of source flags.
    "posted_table": f"""
        select 'B7' BATCH_ID, cast(o_orderkey as varchar(20)) JOURNAL_ID,
          lpad(cast(o_custkey % 97 as varchar(20)),5,'0') BRANCH_CODE,
          case o_orderstatus when 'F' then 'INR' when 'O' then 'USD' else 'EUR' end CURRENCY,
          concat(cast(1+o_custkey%8 as varchar(20)), lpad(cast(o_custkey%50 as varchar(20)),9,'0')) CGL,
          o_orderpriority NARRATION,
          cast(case when o_orderkey % 2 = 0 then o_totalprice else 0 end as {MONEY}) CREDIT_AMOUNT,
          cast(case when o_orderkey % 2 = 0 then 0 else -o_totalprice end as {MONEY}) DEBIT_AMOUNT,
          cast(1 as bigint) TRANSACTION_COUNT,
          case o_orderpriority when '1-URGENT' then 'J' when '2-HIGH' then 'R' when '3-MEDIUM' then 'C'
            when '5-LOW' then 'F' else 'T' end SOURCE_FLAG,
          case when o_orderdate < timestamp '1998-01-01 00:00:00' then date '2000-12-31' else date '2001-01-01' end
            TRANSACTION_DATE
        from orders""",
}

# Steps of the ledger job in SQL. Only the checking side uses them.
KEY = "concat(BRANCH_CODE,CURRENCY,CGL)"
POSTING_SUMS = (
    f"cast(sum(CREDIT_AMOUNT) as {MONEY}) CREDIT_AMOUNT, cast(sum(DEBIT_AMOUNT) as {MONEY}) DEBIT_AMOUNT, "
    "cast(sum(TRANSACTION_COUNT) as bigint) TRANSACTION_COUNT, min(NARRATION) NARRATION, min(BATCH_ID) BATCH_ID, "
    "min(JOURNAL_ID) JOURNAL_ID"
)
BUCKET = "case when CGL like '5%' then '5000000000' else '1111111111' end"
POSTING = (
    "BATCH_ID, JOURNAL_ID, BRANCH_CODE, CURRENCY, CGL, NARRATION, CREDIT_AMOUNT, DEBIT_AMOUNT, TRANSACTION_COUNT, "
    "SOURCE_FLAG"
)
ORACLE_VIEWS = {
    "o_postings": f"""
        select 'B1' BATCH_ID, cast(null as varchar) JOURNAL_ID, BRANCH_CODE, CURRENCY, CGL, 'CBS txns' NARRATION,
          cast(sum(case when AMT > 0 then AMT else 0 end) as {MONEY}) CREDIT_AMOUNT,
          cast(sum(case when AMT < 0 then AMT else 0 end) as {MONEY}) DEBIT_AMOUNT,
          cast(count(*) as bigint) TRANSACTION_COUNT, 'C' SOURCE_FLAG
        from ledger where lower(FILE_NAME) not like 'glifpri%' and lower(FILE_NAME) not like 'glifprb%'
        group by BRANCH_CODE, CURRENCY, CGL""",
    "o_checked": """
        select p.*, case when b.CODE is null then 'INVALID BRANCH' when c.CURRENCY_CODE is null
            then 'INVALID CURRENCY' end REASON, m.CGL_NUMBER
        from o_postings p left join (select distinct CODE from branch_master) b on b.CODE = p.BRANCH_CODE
        left join (select distinct CURRENCY_CODE from currency_master) c on c.CURRENCY_CODE = p.CURRENCY
        left join (select distinct CGL_NUMBER from cgl_master where STATUS='1') m on m.CGL_NUMBER = p.CGL""",
    "o_valid": """
        select BATCH_ID, JOURNAL_ID, BRANCH_CODE, CURRENCY,
          case when CGL_NUMBER is not null then CGL when CGL like '5%' then '5000000000' else '1111111111' end CGL,
          case when CGL_NUMBER is not null then NARRATION else concat(NARRATION,'- INVALID-',CGL) end NARRATION,
          CREDIT_AMOUNT, DEBIT_AMOUNT, TRANSACTION_COUNT, SOURCE_FLAG from o_checked where REASON is null""",
    "o_consolidated": f"""
        select CGL, CURRENCY, BRANCH_CODE, SOURCE_FLAG, {POSTING_SUMS} from o_valid
        group by CGL, CURRENCY, BRANCH_CODE, SOURCE_FLAG""",
    "o_bucket": f"""
        select BRANCH_CODE, CURRENCY, {BUCKET} CGL, SOURCE_FLAG, {POSTING_SUMS},
          cast(sum(CREDIT_AMOUNT)+sum(DEBIT_AMOUNT) as {MONEY}) NET
        from o_consolidated group by BRANCH_CODE, CURRENCY, {BUCKET}, SOURCE_FLAG""",
    "o_balancing": f"""
        select BATCH_ID, JOURNAL_ID, BRANCH_CODE, CURRENCY, CGL, 'OUT OF BAL' NARRATION,
          cast(case when NET < 0 then -NET else 0 end as {MONEY}) CREDIT_AMOUNT,
          cast(case when NET > 0 then -NET else 0 end as {MONEY}) DEBIT_AMOUNT, TRANSACTION_COUNT, SOURCE_FLAG
        from o_bucket where NET <> 0""",
    "o_posted": f"select {POSTING} from o_consolidated union all select {POSTING} from o_balancing",
    "o_journals": f"""
        select {POSTING} from posted_table where TRANSACTION_DATE = date '2001-01-01' and SOURCE_FLAG in ('J','R')""",
    "o_closing": f"""
        select glcc, cast(sum(BALANCE) as {MONEY}) BALANCE from (
          select {KEY} glcc, CREDIT_AMOUNT+DEBIT_AMOUNT BALANCE from o_posted union all
          select {KEY}, CREDIT_AMOUNT+DEBIT_AMOUNT from o_journals union all
          select glcc, BALANCE from opening_balance) t group by glcc""",
    "o_balances": f"""
        select substring(glcc,9,10) CGL, substring(glcc,6,3) CURRENCY, substring(glcc,1,5) BRANCH_CODE, BALANCE,
          cast(round(BALANCE * case when substring(glcc,6,3)='INR' then 1 else coalesce(CURRENCY_RATE,1) end, 2)
            as decimal(25,2)) INR_BALANCE, date '2001-01-01' BALANCE_DATE
        from o_closing left join currency_master on CURRENCY_CODE = substring(glcc,6,3)""",
    "o_difference": f"""
        select GLCC, cast(sum(c) as {MONEY}) cbs_balance, cast(sum(g) as {MONEY}) gl_balance,
          cast(sum(c)-sum(g) as {MONEY}) today_difference from (
          select GLCC, {ZERO} c, GL_BALANCE g from gl_side union all select GLCC, CBS_BALANCE, {ZERO} from cbs_side) t
        group by GLCC having sum(c)-sum(g) <> 0""",
    "o_classified": f"""
        select date '2001-01-01' RECON_RUN_DATE, substring(d.GLCC,1,5) branch_code, substring(d.GLCC,6,3) currency,
          substring(d.GLCC,9,10) cgl, gl_balance, cbs_balance, today_difference DIFFERENCE_AMOUNT,
          cast(today_difference - coalesce(YESTERDAY_DIFFERENCE, 0) as {MONEY}) DIFF_BW_YESTERDAY,
          case when YESTERDAY_DIFFERENCE is null then 'New Entry'
            when today_difference = YESTERDAY_DIFFERENCE then 'Zero Difference' else 'Difference Change' end "type",
          case when YESTERDAY_DIFFERENCE is null then date '2001-01-01' else FIRST_ERROR_DATE end FIRST_ERROR_DATE
        from o_difference d left join previous_difference p on p.GLCC = d.GLCC""",
    "o_headed": """
        select *, case when branch_code='01999' then 'CAO' when substring(cgl,9,1)='9' then 'PROVISION'
          when cgl like '1204%' then 'CASH' when cgl like '62%' then 'AUCA' when cgl like '6363%' then 'CTA 6363'
          when cgl like '4%' then case when cgl like '4363%' then 'CTA 4363' else 'CTA' end
          when cgl like '6%' then 'CTA' when cgl like '7%' or cgl like '8%' then 'I/E'
          when cgl like '5%' then case when currency='INR' then 'MEMO' else 'FC MEMO' end
          when cgl like '2148%' then case when currency='INR' then 'BGL' else 'FC' end
          when cgl like '2249%' then 'INCA'
          when cgl like '2111%' or cgl like '2115%' or cgl like '2060%' then 'PPF'
          when cgl='1106505002' then case when branch_code in
            ('03973','03974','03975','03976','04030','04425','04454','06939') then 'LHO' else 'BCGA' end
          when cgl='1000505003' then 'MIGRATION' when cgl='1100505001' then 'LHO'
          when cgl like '1%' then case when currency='INR' then 'LOAN' else 'FC' end
          when currency='INR' then 'DEPOSITS' else 'FC' end HEAD from o_classified""",
    "o_daily": """
        select * from o_headed where cgl in (select CGL_NUMBER from cgl_master where BAL_COMPARE = 1)""",
    "o_profit_source": """
        select concat(BRANCH_CODE,CURRENCY,CGL) GLCC, INR_BALANCE BALANCE, BALANCE_DATE from balance_table
        where BALANCE_DATE = (select max(BALANCE_DATE) from balance_table) and (CGL like '7%' or CGL like '8%')""",
    "o_assignment": """
        select b.CODE BRANCH_CODE, c.BRANCH_CODE CIRCLE_CODE from branch_master b
        left join circle_master c on c.CIRCLE_CODE = b.CIRCLE_CODE
        where not exists (select 1 from circle_master x where x.BRANCH_CODE = b.CODE)""",
    "o_profit": f"""
        select a.BRANCH_CODE, a.CIRCLE_CODE, cast(sum(BALANCE) as {MONEY}) BALANCE from o_profit_source p
        join o_assignment a on a.BRANCH_CODE = substring(p.GLCC,1,5) where a.CIRCLE_CODE is not null group by 1, 2""",
    "o_circle_profit": f"""
        select c.BRANCH_CODE, c.CIRCLE_CODE, cast(sum(BALANCE) as {MONEY}) BALANCE from o_profit_source p
        join circle_master c on c.BRANCH_CODE = substring(p.GLCC,1,5) group by 1, 2""",
    "o_legs": f"""
        select CIRCLE_CODE, 'B1' BATCH_ID, cast(1 as bigint) TRANSACTION_COUNT, leg_branch BRANCH_CODE,
          'INR' CURRENCY, leg_cgl CGL, cast(greatest(net,0) as {MONEY}) DEBIT_AMOUNT,
          cast(least(net,0) as {MONEY}) CREDIT_AMOUNT, date '2001-01-01' TRANSACTION_DATE, 'T' SOURCE_FLAG,
          'J1' JOURNAL_ID, concat('P and L Transfer - ',CIRCLE_CODE) NARRATION from (
          select CIRCLE_CODE, BRANCH_CODE leg_branch, '2110505001' leg_cgl, -BALANCE net from o_profit union all
          select CIRCLE_CODE, BRANCH_CODE, '1106505001', BALANCE from o_profit union all
          select CIRCLE_CODE, CIRCLE_CODE, '1106505001', -BALANCE from o_profit union all
          select CIRCLE_CODE, CIRCLE_CODE, '2110505001', BALANCE from o_profit) t""",
    "o_transfer_balance": f"""
        select CGL, BRANCH_CODE, 'INR' CURRENCY, cast(sum(b) as {MONEY}) BALANCE, date '2001-01-01' BALANCE_DATE,
          cast(sum(b) as {MONEY}) INR_BALANCE from (
          select CGL, BRANCH_CODE, DEBIT_AMOUNT+CREDIT_AMOUNT b from o_legs union all
          select '2110505001', BRANCH_CODE, BALANCE from o_circle_profit) t group by 1, 2""",
    "o_year_end": f"""
        select CGL, CURRENCY, BRANCH_CODE, date '2001-04-01' BALANCE_DATE, BALANCE, INR_BALANCE from closing_balance
        where trim(CGL) in (select trim(CGL_NUMBER) from cgl_master where BAL_FWD = 1)""",
    "o_year_end_foreign": """
        select distinct * from o_year_end where (CGL like '7%' or CGL like '8%') and trim(CURRENCY) <> 'INR'""",
    "o_year_end_open": f"""
        select * from o_year_end_foreign union all
        select CGL, 'INR', BRANCH_CODE, BALANCE_DATE, cast(-INR_BALANCE as {MONEY}), cast(-INR_BALANCE as {MONEY})
          from o_year_end_foreign union all
        select * from o_year_end where CGL='2110505001' and BRANCH_CODE in (select BRANCH_CODE from circle_master)
        union all select * from o_year_end where not (CGL like '7%' or CGL like '8%') and CGL <> '2110505001'""",
}


def _needed(body: str, views: dict[str, str]) -> list[str]:
    """Views that a statement refers to, directly or through other views, in the order of their definition."""
    wanted: set[str] = set()
    open_texts = [body]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        for name in views.keys() & words - wanted:
            wanted.add(name)
            open_texts.append(views[name])
    return [name for name in views if name in wanted]


def with_views(body: str, dialect: str = "duckdb", tables: dict[str, str] | None = None) -> str:
    """A statement preceded by the views it needs; ``tables`` adds definitions of the base tables."""
    views = {**(tables or {}), **VIEWS, **ORACLE_VIEWS}
    parts = [f"{name} as ({views[name].strip()})" for name in _needed(body, views)]
    statement = "with " + ",\n".join(parts) + "\n" + body.strip() if parts else body.strip()
    return statement.replace("{serial}", SERIAL[dialect])


@lru_cache
def base_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table, resolved once per session."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@lru_cache
def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input view as a lazy frame over the parquet tables of a directory."""
    sql = with_views(f"select * from {name}", "spark", {t: f"select * from {{{t}}}" for t in BASE_TABLES})
    used = {t: base_table(spark, sf_dir, t) for t in BASE_TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)
