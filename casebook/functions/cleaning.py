"""Name and string cleaning."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of "no value" in the input files. The match is case-sensitive.
NO_VALUE = ("", "NULL", "null", "NA", "N/A", "#N/A", "None", "NONE")

_NAME_CHARS = str.maketrans({" ": "_", "-": "_", ".": None})
_NOT_IDENTIFIER = re.compile(r"[^a-z0-9_]")


def snake_case(name: str) -> str:
    """Header text to column name."""
    return name.lower().translate(_NAME_CHARS)


def table_name(name: str) -> str:
    """Result name to a safe SQL table name."""
    return _NOT_IDENTIFIER.sub("_", name.lower())


def blank_to_null(text: Column) -> Column:
    """Trimmed text, or null when it only spells "no value" (P4). Trims spaces, not tabs."""
    trimmed = F.trim(text)
    # a loop over a constant array: a list of comparisons per column would outgrow what the JVM compiles
    return F.when(~F.array_contains(F.array(*(F.lit(word) for word in NO_VALUE)), trimmed), trimmed)


def upper_category(text: Column) -> Column:
    """One spelling per category value (P5)."""
    return F.upper(F.trim(text))


def leading_number(text: Column, pattern: str = r"^(\d+)") -> Column:
    """The key prefix of a text (B1); the empty string where the pattern finds nothing."""
    return F.regexp_extract(text, pattern, 1)
