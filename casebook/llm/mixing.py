"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import ROW, let, numbered

#: 13 hexadecimal digits of a hash make a number below 2**52, which a double holds exactly.
DIGITS = 13


def key_text(column: str) -> Column:
    """What the draws of a ``numbered`` row are made of: its id, or its place where it has none."""
    return F.coalesce(F.col(column).cast("string"), F.concat(F.lit("row:"), F.col(ROW)))


def rates(docs: DataFrame, targets: Mapping[str, float], epochs: float) -> DataFrame:
    """Mean repetitions of each listed source and of all others together: len(targets) + 1 rows at most.

    Weights are shares of the bytes of text. What the listed sources leave goes to the others
    in proportion to their sizes, so that all of these share one rate.
    """
    group = F.when(F.col("source").isin(list(targets)), F.col("source"))
    sized = docs.groupBy(group.alias("listed")).agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).cast("double").alias("bytes")
    )
    weight = F.lit(max(0.0, 1.0 - sum(targets.values())))
    for source, share in targets.items():
        weight = F.when(F.col("listed").eqNullSafe(F.lit(source)), F.lit(float(share))).otherwise(weight)
    total = F.sum("bytes").over(Window.partitionBy())
    rate = F.coalesce(F.try_divide(weight * total * F.lit(float(epochs)), F.col("bytes")), F.lit(0.0))
    return sized.select("listed", weight.alias("weight"), rate.alias("rate"))


def with_distribution(sources: DataFrame) -> DataFrame:
    """Each rate with its Poisson distribution function at 0, 1, 2, ... as an array.

    Terms are summed from their logarithms, so that no rate underflows; the array ends where
    the rest is below the resolution of the draws.
    """
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")
    terms = sources.select("listed", "weight", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    upto = Window.partitionBy("listed").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    log_factorial = F.sum(F.when(F.col("k") > 0, F.ln(F.col("k"))).otherwise(F.lit(0.0))).over(upto)
    term = F.when(F.col("rate") > 0, F.exp(F.col("k") * F.ln("rate") - F.col("rate") - F.col("log_factorial")))
    terms = terms.withColumn("log_factorial", log_factorial)
    terms = terms.withColumn("term", term.otherwise(F.when(F.col("k") == 0, 1.0).otherwise(0.0)))
    terms = terms.withColumn("reached", F.sum("term").over(upto))
    pairs = F.array_sort(F.collect_list(F.struct("k", "reached")))
    return terms.groupBy("listed", "weight", "rate").agg(F.transform(pairs, lambda p: p["reached"]).alias("reached"))


def mix(docs: DataFrame, targets: Mapping[str, float], epochs: float = 1.0, seed: str = "mix") -> DataFrame:
    """Documents repeated so that sources reach their target shares of the bytes, in a global shuffle.

    A document is repeated k times, k being the inverse of the Poisson distribution of its
    source's mean rate at a number drawn from a hash of seed and doc_id. So the counts of all
    documents are independent of layout and order, and a rerun gives the same mixture. A row without
    doc_id draws by its place in the table's files, each for itself. The
    copies are then sorted by a second hash over all tasks.

    ``targets`` gives shares of the whole for some sources (their sum at most 1); the others share
    the rest in proportion to their sizes. ``epochs`` is the size of the mixture as a multiple
    of the input. The rates are a table of len(targets) + 1 rows at most, whatever the corpus,
    and are broadcast; a source with a third of all rows only adds to a partial sum.

    Returns the columns of ``docs`` with rate, repeats, copy_no (from 1) and shuffle_key; columns of
    these names in the input are replaced. Null sources count with those not listed, null
    texts with 0 bytes. Rows of one doc_id get the same count,
    rows repeated in the input are repeated each; an empty table, or one without bytes, gives no
    rows. A table that is not one of files is written first.
    """
    added = ("rate", "repeats", "copy_no", "shuffle_key")
    return copies(docs, targets, epochs, seed).select(
        *[F.col("_doc").getField(c).alias(c) for c in docs.columns if c not in added],
        F.col("_rate").alias("rate"), F.col("_repeats").alias("repeats"),
        F.col("_copy").alias("copy_no"), F.col("_key").alias("shuffle_key"),
    )


def mixed_documents(docs: DataFrame, targets: Mapping[str, float], epochs: float = 1.0, seed: str = "mix") -> DataFrame:
    """The mixture with just the columns of ``docs``, whatever their names."""
    return copies(docs, targets, epochs, seed).select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])


def copies(docs: DataFrame, targets: Mapping[str, float], epochs: float, seed: str) -> DataFrame:
    """_doc (all columns), _rate, _repeats, _copy and _key of every copy, in the order of the keys."""
    sources = with_distribution(rates(docs, targets, epochs)).select(
        F.col("listed").alias("_listed"), F.col("rate").alias("_rate"), F.col("reached").alias("_reached")
    )
    packed = numbered(docs).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.when(F.col("source").isin(list(targets)), F.col("source")).alias("_group"),
        key_text("doc_id").alias("_id"),
    )
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("_id"))), 1, DIGITS), 16, 10)
    u = (draw.cast("double") + 0.5) / float(16**DIGITS)
    counted = (
        packed.join(F.broadcast(sources), F.col("_group").eqNullSafe(F.col("_listed")))
        .withColumn("_repeats", let(u, lambda drawn: F.size(F.filter("_reached", lambda c: c <= drawn))))
        .filter(F.col("_repeats") > 0)
        .select("_doc", "_id", "_rate", "_repeats", F.explode(F.sequence(F.lit(1), F.col("_repeats"))).alias("_copy"))
    )
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.col("_id"), F.lit("|"), F.col("_copy").cast("string")))
    return counted.withColumn("_key", key).orderBy("_key")
