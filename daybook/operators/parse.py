"""Metadata-driven parsing of fixed-width lines."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import (
    MONEY,
    clock_from_millis,
    decode_overpunch,
    decode_trailing_sign,
    effective_amount,
    overpunch_to_digits,
    serial_day,
    strip_zeros,
    tail,
)

# Column names of the two metadata tables.
LAYOUT_COLUMNS = {
    "name": ("COLUMNNAME", "COLUMN_NAME"),
    "start": ("STARTVALUE", "START_POSITION"),
    "end": ("ENDVALUE", "END_POSITION"),
    "include": ("TOBEINCLUDED", "TO_BE_INCLUDED"),
    "kind": ("DATATYPE",),
}

# Signed columns of the account files, by file type.
SIGNED_COLUMNS = {
    "INV": (
        "BALANCE",
        "INT_AVAILABLE",
        "INT_ADJUSTMENT",
        "OD_DR_INT_AVAIL",
        "DR_INT_ADJUSTMENT",
        "OD_PENALTY_INT_ACCR",
        "OD_PENALTY_INT_ADJ",
        "OD_DR_INT_INCR",
        "INT_INCR",
    ),
    "BOR": (
        "BALALANCE",
        "LOAN_TERM",
        "APP_AMT",
        "ADV_VAL",
        "COLLECTION_AMT",
        "INT_ACCR",
        "BPI_ACCR",
        "CI_ACCR",
        "INT_ADJUSTMENT",
        "ARR_INT_ACCR",
        "ARR_INT_ADJUSTMENT",
    ),
    "GLCCGEN": ("AMOUNT",),
    "GLCCCTA": ("AMOUNT",),
    "GLCCINV": ("AMOUNT",),
}
# How many characters of the component codes are kept, and the types without an account.
COMPONENT_TAILS = {"CGL_COMP_1_DR": 4, "CGL_COMP_1_CR": 4, "CGL_COMP_2_DR": 2, "CGL_COMP_2_CR": 2}
TYPES_WITHOUT_ACCOUNT = ("GLCCCTA", "GLCCGEN")
SUMMARY_TYPE_PREFIX = "GLCC"
NO_ACCOUNT = "NA"
UNDECODABLE = "UNDECODABLE AMOUNT"
# What becomes of a line of a file, and the fields that can fail.
STORED, REJECTED = "stored", "rejected"
JUDGED_COLUMNS = ("REASON", "RAW_LINE", "OUTCOME")
DECODED_COLUMNS = ("FCY_AMT", "LCY_AMT", "POST_DATE", "TRANS_DATE")


class Field(NamedTuple):
    """One column of a layout: 1-based start, exclusive end."""

    name: str
    start: int
    end: int
    kind: str | None = None


# The known positions of a raw ledger line.
RAW_LEDGER_LAYOUT = (
    Field("CURRENCY_IND", 48, 51),
    Field("GLCC", 51, 69),
    Field("AMOUNT", 116, 133),
    Field("FOREIGN_AMOUNT", 133, 150),
)


def layout_fields(rows: Iterable) -> list[Field]:
    """Included fields of a layout given as metadata rows (Row or dict), under either set of column names."""
    fields = []
    for row in rows:
        record = row.asDict() if hasattr(row, "asDict") else dict(row)
        record = {key.upper(): value for key, value in record.items()}
        found = {part: next((record[n] for n in names if n in record), None) for part, names in LAYOUT_COLUMNS.items()}
        if str(found["include"]).strip().lower() == "yes":
            fields.append(Field(found["name"], int(found["start"]), int(found["end"]), found["kind"]))
    return fields


def included(metadata: DataFrame) -> DataFrame:
    """Metadata rows marked for inclusion, whatever their case."""
    flag = next(n for n in LAYOUT_COLUMNS["include"] if n in metadata.columns)
    return metadata.filter(F.lower(F.trim(F.col(flag))) == "yes")


def parse_fixed_width(
    lines: DataFrame, layout: Sequence[Field], value: str = "value", keep: Sequence[str | Column] = ()
) -> DataFrame:
    """Cut every line into trimmed string columns, all in one projection; short lines give empty strings."""
    cuts = [F.trim(F.substring(F.col(value), f.start, f.end - f.start)).alias(f.name) for f in layout]
    return lines.select(*keep, *cuts)


def parse_raw_ledger(lines: DataFrame, keep: Sequence[str | Column] = ()) -> DataFrame:
    """Parse raw ledger lines at their fixed positions and keep the amount that counts, still encoded."""
    parsed = parse_fixed_width(lines, RAW_LEDGER_LAYOUT, keep=keep)
    return parsed.withColumn("AMOUNT_RAW", effective_amount("CURRENCY_IND", "FOREIGN_AMOUNT", "AMOUNT"))


def replace_present(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace those columns that the frame has, in one projection; leave out the others."""
    present = {name: change for name, change in changes.items() if name in df.columns}
    return df.withColumns(present) if present else df


def ledger_rows(lines: DataFrame, layout: Sequence[Field], file_name: str = "FILE_NAME") -> DataFrame:
    """Typed ledger rows: dates from serial days, clock time, bare account, decoded foreign and local amounts."""
    typed = _typed_ledger(parse_fixed_width(lines, layout, keep=[file_name]))
    return typed.select(*[f.name for f in layout], "AMOUNT", file_name)


def judged_ledger_rows(lines: DataFrame, layout: Sequence[Field], file_name: str = "FILE_NAME") -> DataFrame:
    """Typed ledger rows with OUTCOME, REASON and RAW_LINE.

    A line is rejected when a field that has text can't be decoded, or when no amount counts. REASON names the fields and
    RAW_LINE is the line as it came; stored rows have neither. An empty field is no fault of its own.
    """
    raw = [F.trim(F.substring("value", f.start, f.end - f.start)).alias(f"_raw_{f.name}") for f in layout if f.name in DECODED_COLUMNS]
    typed = _typed_ledger(parse_fixed_width(lines, layout, keep=[file_name, F.col("value").alias("_line"), *raw]))
    lost = [F.when((F.col(f"_raw_{n}") != "") & F.col(n).isNull(), n) for n in DECODED_COLUMNS if f"_raw_{n}" in typed.columns]
    judged = _judged(typed, F.concat_ws(",", *lost, F.when(F.col("AMOUNT").isNull(), "AMOUNT")))
    return judged.select(*[f.name for f in layout], "AMOUNT", file_name, *JUDGED_COLUMNS)


def _judged(rows: DataFrame, faults: Column) -> DataFrame:
    """Rows with what became of them; ``_line`` is the line that they were cut from."""
    named = rows.withColumn("REASON", F.nullif(faults, F.lit("")))
    outcome = F.when(F.col("REASON").isNull(), STORED).otherwise(REJECTED)
    return named.withColumns({"OUTCOME": outcome, "RAW_LINE": F.when(F.col("REASON").isNotNull(), F.col("_line"))})


def _typed_ledger(parsed: DataFrame) -> DataFrame:
    day = serial_day("POST_DATE")
    money = {n: decode_overpunch(n).cast(MONEY) for n in ("FCY_AMT", "LCY_AMT")}
    changed = replace_present(
        parsed,
        {
            "POST_TIME": F.concat(day.cast("string"), F.lit(" "), clock_from_millis("POST_TIME")),
            "POST_DATE": day,
            "TRANS_DATE": serial_day("TRANS_DATE"),
            "ACCOUNT": strip_zeros("ACCOUNT"),
            **money,
        },
    )
    return changed.withColumn("AMOUNT", effective_amount("FCY_CODE", "FCY_AMT", "LCY_AMT"))


def unsigned_amounts(df: DataFrame, layout: Sequence[Field]) -> DataFrame:
    """Variant ingest: columns of kind AMOUNT get plain digits, their sign is lost."""
    return replace_present(df, {f.name: overpunch_to_digits(f.name) for f in layout if f.kind == "AMOUNT"})


def account_columns(layout: Sequence[Field], file_type: str, value: str = "value") -> dict[str, Column]:
    """Columns of one account file type: signed amounts, bare account, shortened component codes."""
    cuts = {f.name: F.trim(F.substring(F.col(value), f.start, f.end - f.start)) for f in layout}
    changes = {name: decode_trailing_sign for name in SIGNED_COLUMNS[file_type]} | {"ACCOUNT": strip_zeros}
    if not file_type.startswith(SUMMARY_TYPE_PREFIX):
        changes |= {name: partial(tail, n=n) for name, n in COMPONENT_TAILS.items()}
    columns = {name: changes[name](cut) if name in changes else cut for name, cut in cuts.items()}
    if file_type in TYPES_WITHOUT_ACCOUNT:
        columns["ACCOUNT"] = F.lit(NO_ACCOUNT)
    return columns


def account_rows(
    lines: DataFrame, layout: Sequence[Field], file_type: str, keep: Sequence[str | Column] = ()
) -> DataFrame:
    """Typed rows of one account file type."""
    return lines.select(*keep, *[c.alias(name) for name, c in account_columns(layout, file_type).items()])


def account_type(file_name: Column | str, types: Iterable[str]) -> Column:
    """The type whose name a file name begins with, the longest if several do; NULL for other files."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.coalesce(*[F.when(F.startswith(name, F.lit(t)), t) for t in sorted(types, key=len, reverse=True)])


def judged_account_rows(
    lines: DataFrame, layouts: Mapping[str, Sequence[Field]], type_column: str = "FILE_TYPE", file_name: str = "FILE_NAME"
) -> DataFrame:
    """Typed rows of all account file types in one scan, with OUTCOME, REASON and RAW_LINE as ledger rows have them."""
    rows = account_rows_of_types(lines, layouts, type_column, keep=[file_name, F.col("value").alias("_line")])
    lost = []
    for file_type, layout in layouts.items():
        for f in layout:
            if f.name in SIGNED_COLUMNS[file_type]:
                there = F.trim(F.substring("_line", f.start, f.end - f.start)) != ""
                lost.append(F.when((F.col(type_column) == file_type) & there & F.col(f.name).isNull(), f.name))
    return _judged(rows, F.concat_ws(",", *lost)).drop("_line")


def account_rows_of_types(
    lines: DataFrame,
    layouts: Mapping[str, Sequence[Field]],
    type_column: str = "FILE_TYPE",
    keep: Sequence[str | Column] = (),
) -> DataFrame:
    """Typed rows of all account file types in one scan; columns that a type does not have are NULL."""
    chosen: dict[str, Column] = {}
    for file_type, layout in layouts.items():
        of_type = F.col(type_column) == file_type
        for name, column in account_columns(layout, file_type).items():
            chosen[name] = chosen[name].when(of_type, column) if name in chosen else F.when(of_type, column)
    known = lines.filter(F.col(type_column).isin(*layouts))
    return known.select(type_column, *keep, *[column.alias(name) for name, column in chosen.items()])


def rejected_amounts(df: DataFrame, raw: str, decoded: str) -> DataFrame:
    """Rows whose raw amount is present but could not be decoded."""
    return df.filter(F.col(raw).isNotNull() & F.col(decoded).isNull())


def rejected_lines(lines: DataFrame, amount: str = "AMT") -> DataFrame:
    """Lines without an amount that counts, with the REASON. The others are what ``movements.line_totals`` accepts."""
    return lines.filter(F.col(amount).isNull()).withColumn("REASON", F.lit(UNDECODABLE))
