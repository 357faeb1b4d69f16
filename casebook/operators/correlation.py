"""Pearson correlation with a defined result for constant columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pearson(x: Column, y: Column) -> Column:
    """Pearson's r over pairs in which both values are present; null when one side does not vary."""
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def keyed_correlation(df: DataFrame, x: str, y: str, name: str = "pearson_r") -> DataFrame:
    """One row with the correlation of two columns of a keyed table."""
    return df.agg(pearson(F.col(x).cast("double"), F.col(y).cast("double")).alias(name))
