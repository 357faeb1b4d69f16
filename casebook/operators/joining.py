"""Joins between datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, BinaryType, DataType, MapType, NullType, StringType, StructType, VariantType

from casebook.session import written

# The most a hinted side may hold; every executor keeps a copy in memory.
BROADCAST_BYTES = 64 * 1024 * 1024
# Counters that a summary of frequent items can have.
MOST_TRACKED = 1_000_000


def size_of(value: Column, kind: DataType) -> Column:
    """Bytes of a value, those inside arrays, maps and structs included, and 16 for its place."""
    if isinstance(kind, (StringType, BinaryType)):
        inside = F.octet_length(value).cast("long")
    elif isinstance(kind, ArrayType):
        if fixed_size(kind.elementType):
            inside = 16 * F.size(value).cast("long")
        else:
            inside = F.aggregate(value, F.lit(0).cast("long"), lambda total, e: total + size_of(e, kind.elementType))
    elif isinstance(kind, MapType):
        keys, values = ArrayType(kind.keyType), ArrayType(kind.valueType)
        inside = size_of(F.map_keys(value), keys) + size_of(F.map_values(value), values)
    elif isinstance(kind, StructType):
        inside = sum((size_of(value[f.name], f.dataType) for f in kind.fields), F.lit(0).cast("long"))
    elif fixed_size(kind):
        return F.lit(16).cast("long")
    else:
        # nothing tells how large it is
        return F.lit(2 * BROADCAST_BYTES).cast("long")
    return F.when(value.isNull(), 0).otherwise(inside) + 16


def fixed_size(kind: DataType) -> bool:
    return isinstance(kind, AtomicType | NullType) and not isinstance(kind, StringType | BinaryType | VariantType)


def byte_size(df: DataFrame) -> int:
    """Bytes of all values, by one aggregate that brings a single number to the driver."""
    sizes = (size_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields)
    return df.agg(F.coalesce(F.sum(sum(sizes, F.lit(0))), F.lit(0)).alias("bytes")).first()["bytes"]


def staged_with_hot_keys(facts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The facts, written once, and _key, _rows, _shares of keys with more than a shuffle partition's share of them.

    While the facts are written, a summary of frequent items goes over the hashes of their keys: every task
    keeps a bounded number of counters, and the summaries are merged. It misses no key with a
    share of the rows (up to MOST_TRACKED / 16 partitions; beyond, keys just above a share may go unsalted).
    Only the keys it names, at most two for each partition, are then counted, exactly and from the
    written key column alone; a null key counts like another.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    passed, code = Observation(), F.xxhash64(key)
    tracked = min(16 * max(partitions, 8), MOST_TRACKED)
    named = min(2 * partitions, tracked)
    frequent = F.call_function("approx_top_k", code, F.lit(named), F.lit(tracked))
    observed = facts.observe(passed, F.count(F.lit(1)).alias("rows"), frequent.alias("frequent"))
    staged = written(observed, "facts")
    share = max(passed.get["rows"] / partitions, 1)
    candidates = staged.filter(code.isin([row["item"] for row in passed.get["frequent"] or ()]))
    counts = candidates.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    return staged, counts.filter(F.col("_rows") > share).withColumn("_shares", F.ceil(F.col("_rows") / share))


def hot_keys(facts: DataFrame, key: str) -> DataFrame:
    """_key, _rows, _shares: keys with more than one shuffle partition's share of the rows, counted exactly."""
    return staged_with_hot_keys(facts, key)[1]


def salted_left_join(facts: DataFrame, side: DataFrame, fact_key: str, side_key: str) -> DataFrame:
    """Left join by shuffle in which facts with a hot key, or without one, spread over several tasks.

    The facts are computed once: they are written, and with them a summary of their frequent keys. A key
    is hot when it has more than one shuffle partition's share of the facts; there are never more of
    these than partitions, and both sides learn them by a join with that small table. A hot key has as
    many salts as it has shares, and a side's rows of it are repeated once for each; but never so often
    that these copies would outnumber the facts of the key. A fact's salt is a hash of the
    whole row, the same in every rerun; copies of one row share it, so where the plan below could give
    rows in another order nothing depends on that.
    """
    facts, hot = staged_with_hot_keys(facts, fact_key)
    hot = written(hot, "hot-keys")
    if hot.isEmpty():
        return facts.join(side, F.col(fact_key) == F.col(side_key), "left")
    inside = side.join(F.broadcast(hot), F.col(side_key) == F.col("_key"), "left_semi")
    copies = inside.groupBy(F.col(side_key).alias("_side")).agg(F.count(F.lit(1)).alias("_copies"))
    affordable = F.floor(F.col("_rows") / F.coalesce("_copies", F.lit(1)))
    salts = F.greatest(F.least("_shares", affordable), F.lit(1)).cast("int")
    # as many rows as there are hot keys, at most one for each shuffle partition
    hot = written(hot.join(copies, F.col("_key") == F.col("_side"), "left").select("_key", salts.alias("_salts")), "salts")
    facts = facts.join(F.broadcast(hot), F.col(fact_key).eqNullSafe(F.col("_key")), "left").drop("_key")
    row = F.xxhash64(*[c for c in facts.columns if c != "_salts"])
    salted_facts = facts.withColumn("_salt", F.coalesce(F.pmod(row, F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")
    sided = side.join(F.broadcast(hot), F.col(side_key) == F.col("_key"), "left").drop("_key")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    salted_side = sided.withColumn("_side_salt", each).drop("_salts")
    matches = (F.col(fact_key) == F.col(side_key)) & (F.col("_salt") == F.col("_side_salt"))
    return salted_facts.join(salted_side, matches, "left").drop("_salt", "_side_salt")


def join_events(
    facts: DataFrame, events: DataFrame, key: str, fact_columns: Sequence[str], event_columns: Sequence[str]
) -> DataFrame:
    """Facts and events sharing a key, every pairing kept.

    Both inputs shuffle their projected columns once, directly under the join, which is where
    the adaptive skew join can split a hot key over several tasks.
    """
    return facts.select(key, *fact_columns).join(events.select(key, *event_columns), key, "inner")


def attach_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    columns: Mapping[str, str],
    *,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add dimension columns to facts, null where no key matches.

    ``columns`` maps dimension names to their names in the result. A key repeated in the dimension
    repeats the fact. The dimension is broadcast when it measures at most ``max_bytes``; a larger
    one is joined by shuffle, with hot fact keys salted.
    """
    side = dimension.filter(F.col(dimension_key).isNotNull()).select(
        F.col(dimension_key).alias("_dimension_key"),
        *(F.col(name).alias(alias) for name, alias in columns.items()),
    )
    if byte_size(side) <= max_bytes:
        joined = facts.join(F.broadcast(side), F.col(fact_key) == F.col("_dimension_key"), "left")
    else:
        joined = salted_left_join(facts, side, fact_key, "_dimension_key")
    return joined.drop("_dimension_key")


def zero_fill_join(left: DataFrame, right: DataFrame, key: str, measures: Sequence[str], how: str) -> DataFrame:
    """Join two aggregates on their key and fill absent measures with 0.

    Both sides are already partitioned by the key. Only the measures are filled: a null key stays null.
    """
    return left.join(right, key, how).fillna(0, subset=list(measures))
