import pytest
from pyspark.sql import functions as F

from casebook.operators.correlation import keyed_correlation


def r_of(spark, rows):
    df = spark.createDataFrame(rows, "x double, y double")
    table = keyed_correlation(df, "x", "y")
    assert table.columns == ["pearson_r"]
    return table.collect()[0][0]


def test_pairs_with_a_null_are_skipped(spark):
    assert r_of(spark, [(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 9.0)]) == pytest.approx(1.0)


def test_agrees_with_the_builtin(spark):
    df = spark.range(500).select((F.col("id") % 17).cast("double").alias("x"), F.sin("id").alias("y"))
    builtin = df.agg(F.corr("x", "y")).first()[0]
    assert keyed_correlation(df, "x", "y").first()[0] == pytest.approx(builtin, abs=1e-12)


@pytest.mark.parametrize("rows", [[(1.0, 5.0), (2.0, 5.0)], [(5.0, 1.0), (5.0, 2.0)], [(1.0, 2.0)], [(None, 2.0)]])
def test_no_variation_gives_null(spark, rows):
    assert r_of(spark, rows) is None
