"""Grouped counts and rates.

Every aggregate has a partial step before its shuffle, so a key holding a third of all rows
arrives at its reducer as one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.rates import ones, percent

TOTAL, FLAGGED = "total", "flagged"


def flag_counts(df: DataFrame, keys: Sequence[str | Column], flag: Column) -> DataFrame:
    """Rows and flagged rows per key; a null key is a group of its own."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(TOTAL),
        F.sum(ones(flag)).alias(FLAGGED),
    )


def roll_up(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same counts on coarser keys, read from finer counts instead of the rows."""
    return counts.groupBy(*keys).agg(F.sum(TOTAL).alias(TOTAL), F.sum(FLAGGED).alias(FLAGGED))


def rate_table(
    counts: DataFrame,
    keys: Sequence[str],
    *,
    total: str,
    flagged: str,
    rate: str | None = None,
    digits: int = 2,
) -> DataFrame:
    """Counts under their report names, with the flagged share in percent where ``rate`` names it."""
    columns = [F.col(TOTAL).alias(total), F.col(FLAGGED).alias(flagged)]
    if rate:
        columns.append(percent(F.col(FLAGGED), F.col(TOTAL), digits).alias(rate))
    return counts.select(*keys, *columns)


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str) -> DataFrame:
    """Rows per key under ``name`` (A3)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_pairs(df: DataFrame, key: str, category: str) -> DataFrame:
    """Each category once per key, without rows that lack a category."""
    return df.select(key, category).filter(F.col(category).isNotNull()).distinct()


def flag_counts_by_event_category(
    facts: DataFrame, events: DataFrame, key: str, category: str, flag: Column
) -> DataFrame:
    """Rows and flagged rows of ``facts`` per category found in ``events`` for the same key.

    A fact counts once for each distinct category of its key. Facts without a category drop out,
    so this is an inner join; facts are counted per key before it, which sends one row per key
    through the shuffle however many facts a key has.
    """
    per_key = flag_counts(facts, [key], flag)
    return roll_up(per_key.join(distinct_pairs(events, key, category), key), [category])


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in an order (O3)."""
    return df.orderBy(*order).limit(n)


def row_profile(df: DataFrame, measures: Iterable[Column]) -> DataFrame:
    """A one-row table of counts over all rows."""
    return df.agg(*measures)
