"""Signed-amount decoding. All arithmetic is exact decimal; bad digits give NULL, never an exception."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the ledger files and tables.
POSITIVE_MARKS = "0123456789"
NEGATIVE_MARKS = "pqrstuvwxy"
LEDGER_WIDTH = 17
HOME_CURRENCY = "INR"
MONEY = "decimal(25,4)"
RATED_MONEY = "decimal(25,2)"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _body_and_mark(amount: Column, width: int | None) -> tuple[Column, Column]:
    """Everything before the sign character, and the sign character itself."""
    if width is None:
        return F.substring(amount, F.lit(1), F.length(amount) - 1), F.substring(amount, -1, 1)
    return F.substring(amount, 1, width - 1), F.substring(amount, width, 1)


def decode_overpunch(amount: Column | str, width: int | None = None, scale: int = 1000) -> Column:
    """Decode an amount whose last character carries both its last digit and its sign.

    ``width`` fixes the position of that character; without it the last character of the string is taken.
    An unknown sign character, a short field or a malformed body gives NULL.
    """
    body, mark = _body_and_mark(as_column(amount), width)
    digit = F.translate(mark, NEGATIVE_MARKS, POSITIVE_MARKS)
    unit = Decimal(1) / Decimal(scale)
    signed_unit = F.when(mark.between(NEGATIVE_MARKS[0], NEGATIVE_MARKS[-1]), F.lit(-unit)).otherwise(F.lit(unit))
    return F.when(digit.between("0", "9"), F.concat(body, digit).try_cast(MONEY) * signed_unit)


def overpunch_to_digits(amount: Column | str) -> Column:
    """Replace the sign character by its digit and drop the sign; the result stays a string."""
    body, mark = _body_and_mark(as_column(amount), None)
    return F.concat(body, F.translate(mark, NEGATIVE_MARKS, POSITIVE_MARKS))


def decode_trailing_sign(amount: Column | str) -> Column:
    """Decode ``123.45-`` / ``123.45+`` / ``123.45``."""
    c = as_column(amount)
    number = F.regexp_replace(c, "[-+]$", "").try_cast(MONEY)
    return F.when(F.endswith(c, F.lit("-")), -number).otherwise(number)


def effective_amount(currency: Column | str, foreign: Column | str, local: Column | str) -> Column:
    """Foreign amount for foreign currencies, local amount otherwise; an unknown currency counts as local."""
    return F.when(as_column(currency) != HOME_CURRENCY, as_column(foreign)).otherwise(as_column(local))


def positive_part(amount: Column | str) -> Column:
    """The amount when above zero, else zero; a NULL amount counts as zero."""
    c = as_column(amount)
    return F.when(c > 0, c).otherwise(F.lit(0))


def negative_part(amount: Column | str) -> Column:
    """The amount when below zero, else zero; a NULL amount counts as zero."""
    c = as_column(amount)
    return F.when(c < 0, c).otherwise(F.lit(0))
