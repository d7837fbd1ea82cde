"""Lenient parsing of text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a field is stripped of at both ends.
BLANKS = (
    "\t\n\u000b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)

_SIGNED_DIGITS = r"^([+-]?[0-9]+)"
_HEX_DIGITS = r"^([+-]?)0[xX]([0-9a-fA-F]+)"
_DECIMAL_NUMBER = r"^([+-]?(?:Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?))"


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def leading_int(text: Column) -> Column:
    """Integer at the start of a field (``"12 km"`` gives 12); NULL when there is none."""
    field = strip_blanks(text)
    decimal = F.regexp_extract(field, _SIGNED_DIGITS, 1).try_cast("bigint")
    digits = F.regexp_extract(field, _HEX_DIGITS, 2)
    hexadecimal = F.concat(
        F.regexp_extract(field, _HEX_DIGITS, 1), F.conv(digits, 16, 10)
    ).try_cast("bigint")
    return F.when(digits != "", hexadecimal).otherwise(decimal).try_cast("int")


def leading_float(text: Column) -> Column:
    """Decimal number at the start of a field; NULL when there is none."""
    return F.regexp_extract(strip_blanks(text), _DECIMAL_NUMBER, 1).try_cast("double")


def yes_flag(text: Column) -> Column:
    """True exactly for ``Yes``; anything else, missing included, is false."""
    return text.eqNullSafe(F.lit("Yes"))


def split_list(text: Column) -> Column:
    """Elements of a ``", "`` separated list, each stripped."""
    return F.transform(F.split(text, ", ", -1), strip_blanks)
