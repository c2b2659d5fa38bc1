"""Column builders: every function takes columns and returns a Column."""

from daybook.functions.amounts import (
    MONEY,
    RATED_MONEY,
    decode_overpunch,
    decode_trailing_sign,
    effective_amount,
    negative_part,
    overpunch_to_digits,
    positive_part,
)
from daybook.functions.dates import clock_from_millis, is_financial_year_start, is_month_end, is_year_end, serial_day
from daybook.functions.keys import compose_glcc, split_glcc
from daybook.functions.text import bare_file_name, file_name_part, strip_zeros, tail

__all__ = [
    "MONEY",
    "RATED_MONEY",
    "bare_file_name",
    "clock_from_millis",
    "compose_glcc",
    "decode_overpunch",
    "decode_trailing_sign",
    "effective_amount",
    "file_name_part",
    "is_financial_year_start",
    "is_month_end",
    "is_year_end",
    "negative_part",
    "overpunch_to_digits",
    "positive_part",
    "serial_day",
    "split_glcc",
    "strip_zeros",
    "tail",
]
