import duckdb
import pytest
from pyspark.sql import functions as F

from casebook.operators.counting import (
    count_by,
    distinct_pairs,
    flag_counts,
    flag_counts_by_event_category,
    preview,
    rate_table,
    roll_up,
)


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture(scope="module")
def crimes(spark):
    return spark.createDataFrame(
        [("A", 2020, 1, True), ("B", 2020, 1, False), ("C", None, None, True), ("D", 2021, 2, None)],
        "case_number string, year int, month int, arrest boolean",
    )


def test_null_key_is_a_group_and_null_flag_is_not_set(crimes):
    assert as_set(flag_counts(crimes, ["year"], F.col("arrest"))) == {(2020, 2, 1), (None, 1, 1), (2021, 1, 0)}


def test_rates(crimes):
    table = rate_table(
        flag_counts(crimes, ["year"], F.col("arrest")), ["year"], total="n", flagged="hits", rate="pct"
    )
    assert table.dtypes == [("year", "int"), ("n", "bigint"), ("hits", "bigint"), ("pct", "double")]
    assert as_set(table) == {(2020, 2, 1, 50.0), (None, 1, 1, 100.0), (2021, 1, 0, 0.0)}


def test_roll_up_equals_direct_counts(crimes):
    fine = flag_counts(crimes, ["year", "month"], F.col("arrest"))
    for key in ("year", "month"):
        assert as_set(roll_up(fine, [key])) == as_set(flag_counts(crimes, [key], F.col("arrest")))


def test_preview_is_ordered(crimes):
    counts = count_by(crimes, ["year"], "n")
    assert [tuple(r) for r in preview(counts, 2, F.desc("n"), "year").collect()] == [(2020, 2), (None, 1)]


def test_fact_counts_once_per_distinct_category(spark):
    facts = spark.createDataFrame(
        [("A", True), ("B", False), ("B", True), ("C", True), (None, True)], "case_number string, arrest boolean"
    )
    events = spark.createDataFrame(
        [("A", "X"), ("A", "X"), ("A", "Y"), ("B", "X"), ("B", None), ("D", "Y"), (None, "X")],
        "case_number string, race string",
    )
    assert as_set(distinct_pairs(events, "case_number", "race")) == {
        ("A", "X"), ("A", "Y"), ("B", "X"), ("D", "Y"), (None, "X"),
    }
    counts = flag_counts_by_event_category(facts, events, "case_number", "race", F.col("arrest"))
    assert as_set(counts) == {("X", 3, 2), ("Y", 1, 1)}


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_hot_keys_count_in_full(spark, broadcast):
    """A third of the facts and of the events share one key."""
    facts = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("case_number"),
        (F.col("id") % 2 == 0).alias("arrest"),
    )
    events = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") + 100).cast("string")).alias("case_number"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("race"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        counts = flag_counts_by_event_category(facts, events, "case_number", "race", F.col("arrest"))
        actual = as_set(counts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    f, e = facts.toPandas(), events.toPandas()  # noqa: F841 (read by name below)
    expected = duckdb.sql("""
        select race, count(*), cast(sum(case when arrest then 1 else 0 end) as bigint)
        from f left join (select distinct * from e) c on f.case_number = c.case_number
        where race is not null group by race
    """).fetchall()
    assert actual == set(expected)


def test_facts_shrink_before_the_shuffle(spark):
    """The join input is one row per key, counted before its exchange."""
    facts = spark.range(1000).select(F.lit("hot").alias("case_number"), F.lit(True).alias("arrest"))
    events = spark.range(10).select(F.lit("hot").alias("case_number"), F.col("id").cast("string").alias("race"))
    counts = flag_counts_by_event_category(facts, events, "case_number", "race", F.col("arrest"))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan[plan.index("Join") :]
    assert as_set(counts) == {(str(i), 1000, 1000) for i in range(10)}
