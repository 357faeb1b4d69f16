"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import crc32_of, whole_text, with_positions
from casebook.session import written


def interleave(docs: DataFrame, shards: int = 16, seed: str = "shards", stratum: str = "source") -> DataFrame:
    """Every document's place in ``shards`` shards that all hold the mixture of the whole.

    Rows are shuffled within each stratum by a seeded hash and ranked; row r of n in its stratum
    stands at (r + 0.5) / n of the whole order, which is cut into equal numbers of rows. So
    shards differ by one row at most, and in each stratum by about one row as well.

    Both rankings are sorts by range over all tasks, so a stratum with a third of all rows is
    spread like any other, and no text is moved.

    Returns doc_id, size (bytes of the text, 0 for none, plus 1), text_crc32, law ("rows"),
    shard, slot (gapless from 0 within the shard), grown_shard (null), stratum rank and
    fraction. A null stratum is a stratum of its own; a null text counts as empty; repeated
    rows each get a slot; an empty table gives no rows. Further columns are not read.
    """
    keyed = docs.select(
        "doc_id",
        F.col(stratum).cast("string").alias("stratum"),
        (F.octet_length(whole_text()) + 1).cast("long").alias("size"),
        crc32_of(whole_text()).alias("text_crc32"),
    ).withColumn("draw", F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    ranked = with_positions(keyed, ["stratum", "draw", "doc_id", "text_crc32"], "strata").drop("total")
    strata = ranked.groupBy("stratum").agg(F.min("position").alias("first"), F.count("*").alias("rows"))
    strata = strata.withColumnRenamed("stratum", "of_stratum")
    placed = ranked.join(strata, F.col("stratum").eqNullSafe(F.col("of_stratum"))).select(
        "doc_id", "size", "text_crc32", "stratum", "draw",
        (F.col("position") - F.col("first")).alias("stratum_rank"),
        ((F.col("position") - F.col("first") + F.lit(0.5)) / F.col("rows")).alias("fraction"),
    )
    order = ["fraction", "draw", "doc_id", "text_crc32"]
    whole = with_positions(written(placed, "fractions"), order, "interleaved")
    shard = F.expr(f"position * {shards} div total")
    return whole.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.expr(f"position - (shard * total + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "stratum_rank", "fraction",
    )
