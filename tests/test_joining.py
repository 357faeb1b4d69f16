import pytest
from pyspark.sql import functions as F

from casebook.operators.distance import distance_by_key
from casebook.operators.joining import (
    BROADCAST_BYTES,
    attach_dimension,
    byte_size,
    hot_keys,
    join_events,
    salted_left_join,
    zero_fill_join,
)
from casebook.plans.reports import district_comparison, prefix_density


def multiset(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def skewed(spark):
    """District 7 holds a third of the facts; districts 90 to 99 are in no dimension."""
    return spark.range(6000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100).cast("int").alias("district"),
        (41 + F.col("id") / 10000).alias("latitude"),
        (-87 - F.col("id") / 20000).alias("longitude"),
    )


@pytest.fixture(scope="module")
def dimension(spark):
    """Districts 0 to 89, district 7 twice, one without a key."""
    keys = spark.range(90).select(F.col("id").cast("int").alias("k")).union(spark.sql("select 7")).union(
        spark.sql("select cast(null as int)")
    )
    return keys.select("k", F.concat(F.lit("D"), "k").alias("name"), (41 + F.col("k") / 100).alias("lat"),
                       (-87 - F.col("k") / 100).alias("lon"))


def test_join_keeps_every_pairing(spark):
    facts = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), (None, 4)], "k string, f int")
    events = spark.createDataFrame([("A", "x"), ("A", "y"), ("C", "z"), (None, "n")], "k string, e string")
    assert multiset(join_events(facts, events, "k", ["f"], ["e"])) == [
        ("A", 1, "x"), ("A", 1, "y"), ("A", 2, "x"), ("A", 2, "y"),
    ]


def test_hot_key_of_a_shuffle_join_is_split(spark, no_broadcast, tmp_path):
    """Adaptive execution splits the partition of a key that holds a third of the events."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "100000",
    }
    events = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("e"),
    )
    events.repartition(8).write.parquet(str(tmp_path / "events"))
    facts = spark.range(30000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("f")).union(
        spark.sql("select 'hot', -1")
    )
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = join_events(facts, spark.read.parquet(str(tmp_path / "events")), "k", ["f"], ["e"])
        assert len(joined.collect()) == 30000
        assert "skew=true" in plan_of(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_measured_size(spark):
    df = spark.createDataFrame([("abcd", 1), (None, 2)], "s string, i int")
    assert byte_size(df) == 4 + 2 * 16 + 2 * 16
    assert byte_size(df.limit(0)) == 0


@pytest.mark.parametrize(("kind", "value", "inside"), [
    ("string", "abcd", 4), ("binary", bytearray(b"abcde"), 5), ("int", 7, 0), ("decimal(20,2)", None, 0),
    ("array<int>", [1, None, 3], 48), ("array<string>", ["ab", None, "cde"], 2 + 3 + 48), ("array<array<string>>", [["ab"], None], 16 + 18 + 16),
    ("map<string,int>", {"abc": 1, "d": 2}, (16 + 4 + 32) + (16 + 32)), ("map<int,array<string>>", {1: ["xy"]}, (16 + 16) + (16 + 16 + 18)),
    ("struct<a:string,b:array<binary>>", ("abc", [bytearray(b"12")]), 16 + 3 + 16 + 18),
    ("string", None, 0), ("array<string>", None, 0), ("struct<a:string>", None, 0), ("map<string,string>", None, 0),
])
def test_measured_size_of_nested_values(spark, kind, value, inside):
    assert byte_size(spark.createDataFrame([(value,)], f"`a b` {kind}")) == 16 + inside


def test_values_of_unknown_size_are_not_broadcast(spark):
    assert byte_size(spark.sql("select parse_json('[1]') as v")) > BROADCAST_BYTES


def test_large_nested_dimension_is_not_broadcast(spark, skewed, no_broadcast):
    """Few rows, whose arrays hold 100 MB."""
    wide = spark.range(50).select(F.col("id").cast("int").alias("k"), F.array_repeat(F.repeat(F.lit("x"), 1000), 2000).alias("names"))
    assert byte_size(wide) > 50 * 2000 * 1000
    joined = attach_dimension(skewed, wide, "district", "k", {"names": "names"})
    assert "BroadcastHashJoin LeftOuter" not in plan_of(joined) and "_side_salt" in plan_of(joined)


def test_facts_are_computed_once(spark, skewed, dimension, no_broadcast):
    """Also when they have hot keys, null keys, and a key type that summaries do not take."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    facts = skewed.select("id", F.when(F.col("id") % 7 > 0, F.array("district")).alias("places")).mapInArrow(count, "id long, places array<int>")
    side = dimension.select(F.array("k").alias("_k"), "name").filter("k is not null")
    joined = salted_left_join(facts, side, "places", "_k")
    rows = joined.collect()
    assert passed.value == 6000
    plain = skewed.select("id", F.when(F.col("id") % 7 > 0, F.array("district")).alias("places")).join(side, F.col("places") == F.col("_k"), "left")
    assert sorted(map(repr, rows)) == sorted(map(repr, plain.collect()))


def test_all_hot_keys_are_found_among_many(spark):
    """Keys just above a partition's share of the rows, among a hundred thousand others."""
    facts = spark.range(200_000).select(F.when(F.col("id") % 5 < 3, F.pmod(F.xxhash64("id"), F.lit(4)) - 4).otherwise(F.col("id")).alias("k"))
    counts = {r["k"]: r["count"] for r in facts.filter("k < 0").groupBy("k").count().collect()}
    found = {r["_key"]: r["_rows"] for r in hot_keys(facts, "k").collect()}
    assert found == {k: n for k, n in counts.items() if n > 200_000 / 8} and len(found) == 4


def test_small_dimension_is_broadcast(skewed, dimension):
    joined = attach_dimension(skewed, dimension, "district", "k", {"name": "label"})
    assert joined.columns == [*skewed.columns, "label"]
    assert "BroadcastHashJoin" in plan_of(joined) and "LeftOuter" in plan_of(joined)


def test_large_dimension_is_joined_by_salted_shuffle(skewed, dimension, no_broadcast):
    small = attach_dimension(skewed, dimension, "district", "k", {"name": "label"})
    large = attach_dimension(skewed, dimension, "district", "k", {"name": "label"}, max_bytes=0)
    assert "SortMergeJoin" in plan_of(large) and "_side_salt" in plan_of(large)
    assert large.columns == small.columns
    rows = multiset(large)
    assert rows == multiset(small)
    # 2000 hot facts and one of every hundred others meet district 7 twice
    assert len(rows) == 6000 + sum(1 for i in range(6000) if i % 3 == 0 or i % 100 == 7)
    assert {r[1] for r in rows if r[-1] is None} == set(range(90, 100))


def test_hot_facts_spread_over_their_shares(spark, skewed, dimension, no_broadcast):
    assert [r["_key"] for r in hot_keys(skewed, "district").collect()] == [7]
    joined = salted_left_join(skewed, dimension.withColumnRenamed("k", "_k").filter("_k is not null"), "district", "_k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = joined.filter("district = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 2 and max(r["count"] for r in spread) < 4000 / 2


def test_facts_without_a_key_spread_and_stay(spark, dimension, no_broadcast):
    keyless = spark.range(900).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id") % 90).cast("int").alias("district")
    )
    assert [r["_key"] for r in hot_keys(keyless, "district").collect()] == [None]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = attach_dimension(keyless, dimension, "district", "k", {"name": "label"}, max_bytes=0)
        spread = joined.filter("district is null").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread > 2
    assert multiset(joined) == multiset(attach_dimension(keyless, dimension, "district", "k", {"name": "label"}))
    assert joined.filter("district is null and label is null").count() == 300


def test_even_keys_are_not_salted(spark, dimension, no_broadcast):
    even = spark.range(1000).select((F.col("id") % 90).cast("int").alias("district"))
    assert hot_keys(even, "district").isEmpty()
    joined = salted_left_join(even, dimension.withColumnRenamed("k", "_k"), "district", "_k")
    assert "_salt" not in plan_of(joined)
    assert hot_keys(even.limit(0), "district").isEmpty()


def test_more_hot_keys_than_any_fixed_number(spark, no_broadcast):
    """100 hot keys of 101, on 128 partitions, each split into its shares."""
    facts = spark.range(20000).select("id", (F.col("id") % 100).cast("int").alias("district")).unionAll(
        spark.sql("select cast(-1 as long), 500")
    )
    side = spark.range(0, 110).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    spark.conf.set("spark.sql.shuffle.partitions", "128")
    try:
        assert hot_keys(facts, "district").count() == 100
        joined = attach_dimension(facts, side, "district", "k", {"name": "label"}, max_bytes=0)
        assert joined.filter(F.col("label") == F.concat(F.lit("n"), "district")).count() == 20000
        assert joined.filter("label is null").count() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_key_hot_on_both_sides_is_not_multiplied(spark, no_broadcast):
    """As many rows of the key in the dimension as in the facts: repeating them per salt would not pay."""
    facts = spark.range(300).select("id", F.lit(7).alias("district"))
    side = spark.range(300).select(F.lit(7).alias("k"), F.col("id").alias("name"))
    joined = attach_dimension(facts, side, "district", "k", {"name": "label"}, max_bytes=0)
    assert joined.count() == joined.distinct().count() == 90000


def test_facts_behind_a_shuffle_keep_their_salts(spark, skewed, dimension, no_broadcast):
    shuffled = skewed.repartition(13)
    joined = attach_dimension(shuffled, dimension, "district", "k", {"name": "label"}, max_bytes=0)
    assert "monotonically" not in plan_of(joined)
    assert multiset(joined) == multiset(attach_dimension(skewed, dimension, "district", "k", {"name": "label"}))


def test_distance_counts_once_per_point_of_the_district(skewed, dimension, no_broadcast):
    tables = [
        distance_by_key(
            skewed, dimension, "district", "k", point_lat="lat", point_lon="lon", max_bytes=limit
        )
        for limit in (1 << 20, 0)
    ]
    broadcast, shuffled = (multiset(t) for t in tables)
    assert [r[0::2] for r in broadcast] == [r[0::2] for r in shuffled]
    assert all(a == b or abs(a - b) <= 0.011 for a, b in zip((r[1] for r in broadcast), (r[1] for r in shuffled)))
    found = {r[0]: r for r in broadcast}
    assert found[95][1] is None and found[95][2] > 0
    assert found[7][2] == 2 * sum(1 for i in range(6000) if i % 3 == 0 or i % 100 == 7)


def test_only_measures_are_filled(spark):
    left = spark.createDataFrame([(1, 5), (None, 7)], "k int, a long")
    right = spark.createDataFrame([(2, 3)], "k int, b long")
    assert set(map(tuple, zero_fill_join(left, right, "k", ["a", "b"], "outer").collect())) == {
        (1, 5, 0), (2, 0, 3), (None, 7, 0),
    }
    assert set(map(tuple, zero_fill_join(left, right, "k", ["b"], "left").collect())) == {(1, 5, 0), (None, 7, 0)}


def test_district_known_only_to_violence(spark):
    crimes = spark.createDataFrame([(1, 8, 2)], "district int, total_crimes long, total_arrests long")
    violence = spark.createDataFrame([(1, 1), (9, 4)], "district int, violence_incidents long")
    rows = {r.district: r.asDict() for r in district_comparison(crimes, violence).collect()}
    assert rows[1]["arrest_rate"] == 0.25 and rows[1]["violence_per_1000"] == 125.0
    assert rows[9] == {
        "district": 9, "total_crimes": 0, "total_arrests": 0, "violence_incidents": 4,
        "arrest_rate": 0.0, "violence_rate": 0.0, "violence_per_1000": None,
    }


def test_blocks_without_a_number_share_a_key(spark):
    crimes = spark.createDataFrame([("043XX S A",), ("043XX N B",), ("EXAMPLE RD",), (None,)], "block string")
    offenders = spark.createDataFrame([("043XX S C",), ("LANE",), ("099XX",)], "block string")
    assert set(map(tuple, prefix_density(crimes, offenders).collect())) == {("043", 2, 1), ("", 1, 1)}
    assert set(map(tuple, prefix_density(crimes, offenders, drop_unmatched=True).collect())) == {("043", 2, 1)}
