"""Text to typed values (C1-C8). What cannot be read becomes null, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date patterns of the input files.
TIMESTAMP_PATTERN = "MM/dd/yyyy hh:mm:ss a"
DATE_PATTERN = "MM/dd/yyyy"

# A failing cast costs an exception per row, so only texts that are numbers are cast: digits with a sign, and
# for doubles a point, an exponent, a type letter or one of the words, with blanks and control characters around.
# Only a whole number beyond an integer's range still fails in the cast.
_BLANK = r"[\x00-\x20\x7f]*"
_INTEGER = rf"\A{_BLANK}[+-]?[0-9]+{_BLANK}\z"
_DOUBLE = rf"(?i)\A{_BLANK}[+-]?(?:0x[0-9a-f]*\.?[0-9a-f]*p[+-]?[0-9]+[fd]?|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?[fd]?|inf|infinity|nan){_BLANK}\z"


def to_int(text: Column) -> Column:
    return F.when(text.rlike(_INTEGER), text.try_cast("int"))


def to_double(text: Column) -> Column:
    return F.when(text.rlike(_DOUBLE), text.try_cast("double"))


def to_timestamp(text: Column, pattern: str = TIMESTAMP_PATTERN) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def to_day(text: Column, pattern: str = DATE_PATTERN) -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit(pattern)))


def is_word(text: Column, word: str) -> Column:
    """True where the text is ``word`` in any case; false for everything else and for null."""
    return F.coalesce(F.lower(text) == word.lower(), F.lit(False))


def label_code(text: Column, label: str, code: int) -> Column:
    """An integer column in which one text label stands for ``code``."""
    return F.when(text == label, F.lit(code)).otherwise(to_int(text))


def feet_inches(text: Column) -> Column:
    """Packed height in inches: FII and FFII hold feet then two digits of inches, else plain inches."""
    inches = to_int(F.right(text, F.lit(2)))

    def packed(feet_digits: int) -> Column:
        return to_int(F.left(text, F.lit(feet_digits))) * 12 + inches

    digits = F.length(text)
    return F.when(digits == 3, packed(1)).when(digits == 4, packed(2)).otherwise(to_int(text))


def year_or_from(year: Column, moment: Column) -> Column:
    """The year as given, else the year of the date."""
    return F.coalesce(year, F.year(moment))
