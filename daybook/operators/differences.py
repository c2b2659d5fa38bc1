"""Daily difference between two balance sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import MONEY, compose_glcc, split_glcc
from daybook.operators.lookups import keep_known

# Branches with a category of their own for one account.
LOCAL_OFFICE_BRANCHES = ("03973", "03974", "03975", "03976", "04030", "04425", "04454", "06939")

# Category rules in order, the first that holds decides.
# (condition, category in home currency, category in foreign currency)
HEAD_RULES = (
    ("branch_code = '01999'", "CAO", "CAO"),
    ("substring(cgl, 9, 1) = '9'", "PROVISION", "PROVISION"),
    ("cgl LIKE '1204%'", "CASH", "CASH"),
    ("cgl LIKE '62%'", "AUCA", "AUCA"),
    ("cgl LIKE '6363%'", "CTA 6363", "CTA 6363"),
    ("cgl LIKE '4363%'", "CTA 4363", "CTA 4363"),
    ("cgl LIKE '4%'", "CTA", "CTA"),
    ("cgl LIKE '6%'", "CTA", "CTA"),
    ("cgl LIKE '7%'", "I/E", "I/E"),
    ("cgl LIKE '8%'", "I/E", "I/E"),
    ("cgl LIKE '5%'", "MEMO", "FC MEMO"),
    ("cgl LIKE '2148%'", "BGL", "FC"),
    ("cgl LIKE '2249%'", "INCA", "INCA"),
    ("cgl LIKE '2111%'", "PPF", "PPF"),
    ("cgl LIKE '2115%'", "PPF", "PPF"),
    ("cgl LIKE '2060%'", "PPF", "PPF"),
    (f"cgl = '1106505002' AND branch_code IN {LOCAL_OFFICE_BRANCHES}", "LHO", "LHO"),
    ("cgl = '1106505002'", "BCGA", "BCGA"),
    ("cgl = '1000505003'", "MIGRATION", "MIGRATION"),
    ("cgl = '1100505001'", "LHO", "LHO"),
    ("cgl LIKE '1%'", "LOAN", "FC"),
    ("true", "DEPOSITS", "FC"),
)

# Classes of change and column order of the result.
NEW_ENTRY = "New Entry"
UNCHANGED = "Zero Difference"
CHANGED = "Difference Change"
DIFFERENCE_COLUMNS = (
    "RECON_RUN_DATE",
    "branch_code",
    "currency",
    "cgl",
    "gl_balance",
    "cbs_balance",
    "DIFFERENCE_AMOUNT",
    "DIFF_BW_YESTERDAY",
    "type",
    "FIRST_ERROR_DATE",
)


def signed_union(gl: DataFrame, cbs: DataFrame) -> DataFrame:
    """Totals of both sides per key. A union with zeros takes the place of an outer join: one shuffle, summed first."""
    zero = F.lit(0).cast(MONEY)
    ours = gl.select("GLCC", zero.alias("cbs_balance"), F.col("GL_BALANCE").cast(MONEY).alias("gl_balance"))
    theirs = cbs.select("GLCC", F.col("CBS_BALANCE").cast(MONEY).alias("cbs_balance"), zero.alias("gl_balance"))
    return (
        ours.unionByName(theirs)
        .groupBy("GLCC")
        .agg(*[F.sum(side).cast(MONEY).alias(side) for side in ("cbs_balance", "gl_balance")])
    )


def balance_difference(gl: DataFrame, cbs: DataFrame) -> DataFrame:
    """Keys on which the two sources disagree, with today's difference."""
    difference = (F.col("cbs_balance") - F.col("gl_balance")).cast(MONEY)
    compared = signed_union(gl, cbs).withColumn("today_difference", difference)
    return compared.filter(F.col("today_difference") != 0)


def classify_change(today: DataFrame, previous: DataFrame, day: dt.date) -> DataFrame:
    """Compare each difference with yesterday's and carry the date on which it first appeared."""
    known = F.col("YESTERDAY_DIFFERENCE").isNotNull()
    same = F.col("today_difference") == F.col("YESTERDAY_DIFFERENCE")
    change = F.col("today_difference") - F.coalesce(F.col("YESTERDAY_DIFFERENCE"), F.lit(0).cast(MONEY))
    joined = today.join(previous.select("GLCC", "YESTERDAY_DIFFERENCE", "FIRST_ERROR_DATE"), "GLCC", "left")
    parts = {name.lower(): part for name, part in split_glcc("GLCC").items()}
    return joined.withColumns(
        {
            **parts,
            "RECON_RUN_DATE": F.lit(day),
            "DIFFERENCE_AMOUNT": F.col("today_difference"),
            "DIFF_BW_YESTERDAY": change.cast(MONEY),
            "type": F.when(~known, NEW_ENTRY).when(same, UNCHANGED).otherwise(CHANGED),
            "FIRST_ERROR_DATE": F.when(known, F.col("FIRST_ERROR_DATE")).otherwise(F.lit(day)),
        }
    ).select(*DIFFERENCE_COLUMNS)


def balance_differences_by_day(gl: DataFrame, cbs: DataFrame, date: str = "BALANCE_DATE") -> DataFrame:
    """``GLCC, RECON_RUN_DATE`` on which the two sources disagree, for all dates at once."""
    zero = F.lit(0).cast(MONEY)
    keys = ("GLCC", F.col(date).alias("RECON_RUN_DATE"))
    ours = gl.select(*keys, zero.alias("cbs_balance"), F.col("GL_BALANCE").cast(MONEY).alias("gl_balance"))
    theirs = cbs.select(*keys, F.col("CBS_BALANCE").cast(MONEY).alias("cbs_balance"), zero.alias("gl_balance"))
    sums = ours.unionByName(theirs).groupBy("GLCC", "RECON_RUN_DATE").agg(
        *[F.sum(side).cast(MONEY).alias(side) for side in ("cbs_balance", "gl_balance")]
    )
    difference = (F.col("cbs_balance") - F.col("gl_balance")).cast(MONEY)
    return sums.withColumn("today_difference", difference).filter(F.col("today_difference") != 0)


def classify_changes(differences: DataFrame, previous: DataFrame, first: dt.date) -> DataFrame:
    """What :func:`classify_change` gives day after day, for all days from ``first`` on in one pass.

    The differences of an account on days that follow each other are an island, and the first day of an island is the
    first-error date of all of them. ``previous`` is the day before ``first``: an island that begins there has the date
    that it brings along. An account has one row a day at most, so no window holds more rows than there are days.
    """
    none = F.lit(None).cast(MONEY)
    before = previous.filter(F.col("YESTERDAY_DIFFERENCE").isNotNull()).select(
        "GLCC",
        F.lit(first - dt.timedelta(days=1)).alias("RECON_RUN_DATE"),
        *[none.alias(side) for side in ("cbs_balance", "gl_balance")],
        F.col("YESTERDAY_DIFFERENCE").cast(MONEY).alias("today_difference"),
        F.col("FIRST_ERROR_DATE").alias("_since"),
    )
    rows = differences.withColumn("_since", F.col("RECON_RUN_DATE")).unionByName(before)
    days = Window.partitionBy("GLCC").orderBy("RECON_RUN_DATE")
    goes_on = F.coalesce(F.date_diff("RECON_RUN_DATE", F.lag("RECON_RUN_DATE").over(days)) == 1, F.lit(False))
    marked = rows.withColumns({"_known": goes_on, "_yesterday": F.when(goes_on, F.lag("today_difference").over(days))})
    island = F.last(F.when(~F.col("_known"), F.struct("_since")), ignorenulls=True).over(days)
    dated = marked.withColumn("FIRST_ERROR_DATE", island.getField("_since")).filter(F.col("RECON_RUN_DATE") >= F.lit(first))
    change = F.col("today_difference") - F.coalesce(F.col("_yesterday"), F.lit(0).cast(MONEY))
    same = F.col("today_difference") == F.col("_yesterday")
    parts = {name.lower(): part for name, part in split_glcc("GLCC").items()}
    return dated.withColumns(
        {
            **parts,
            "DIFFERENCE_AMOUNT": F.col("today_difference"),
            "DIFF_BW_YESTERDAY": change.cast(MONEY),
            "type": F.when(~F.col("_known"), NEW_ENTRY).when(same, UNCHANGED).otherwise(CHANGED),
        }
    ).select(*DIFFERENCE_COLUMNS)


def head_category(df: DataFrame, rules: Sequence[tuple[str, str, str]] = HEAD_RULES, home: str = "INR") -> DataFrame:
    """Add HEAD, the category of the first rule that holds; the rules fold into one CASE expression."""
    at_home = F.col("currency") == home
    head = None
    for condition, domestic, foreign in rules:
        holds = F.expr(condition)
        category = F.lit(domestic) if domestic == foreign else F.when(at_home, domestic).otherwise(foreign)
        head = F.when(holds, category) if head is None else head.when(holds, category)
    return df.withColumn("HEAD", head)


def restrict_to_master(differences: DataFrame, compared_cgls: DataFrame) -> DataFrame:
    """Keep the accounts that the master marks for comparison."""
    columns = differences.columns
    return keep_known(differences, compared_cgls.select(F.col("CGL").alias("cgl")), "cgl").select(*columns)


def head_counts(differences: DataFrame) -> DataFrame:
    """Entries and new entries per category."""
    return differences.groupBy("RECON_RUN_DATE", "HEAD").agg(
        F.count(F.lit(1)).alias("Total_no_of_entries"),
        F.count_if(F.col("type") == NEW_ENTRY).alias("new entry"),
    )


def difference_summary(differences: DataFrame) -> DataFrame:
    """One JSON text per date. What is collected is one struct per category, and the categories are a fixed list."""
    entry = F.struct("HEAD", "Total_no_of_entries", "new entry")
    per_day = head_counts(differences).groupBy("RECON_RUN_DATE").agg(
        F.sort_array(F.collect_list(entry)).alias("summary")
    )
    return per_day.select(F.to_json(F.struct("RECON_RUN_DATE", "summary")).alias("summary_json"))


def lake_differences(differences: DataFrame) -> DataFrame:
    """Differences in the shape of the lake table, which also keeps the first-error date for the next day."""
    return differences.select(
        F.col("RECON_RUN_DATE").alias("RECON_DATE"),
        compose_glcc().alias("GLCC"),
        F.col("DIFFERENCE_AMOUNT").cast(MONEY).alias("DIFFERENCE_AMOUNT"),
        "FIRST_ERROR_DATE",
    )


def previous_differences(lake: DataFrame, day: dt.date) -> DataFrame:
    """Differences of the day before ``day`` from the lake table; only that partition is read."""
    rows = lake.filter(F.col("RECON_DATE") == F.lit(day - dt.timedelta(days=1)))
    return rows.select(
        "GLCC", F.col("DIFFERENCE_AMOUNT").cast(MONEY).alias("YESTERDAY_DIFFERENCE"), "FIRST_ERROR_DATE"
    )
