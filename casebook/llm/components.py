"""Connected components over edges, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.session import written


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable over ``edges`` (left, right), for every node of an edge.

    Alternating large and small stars (Kiveris et al. 2014): every node's larger neighbours are tied
    to its smallest one, then its smaller ones; the edges become stars in a number of rounds that
    grows with the logarithm of the paths. Minima are summed up in the tasks before the
    shuffle, edges of a hot node are rows that a join may split, and every round is written.
    """
    current = written(
        edges.select(F.greatest("left", "right").alias("node"), F.least("left", "right").alias("to"))
        .filter("node > to")
        .distinct(),
        "edges",
    )
    state = signature(current)
    while True:
        large = star(current, larger=True)
        stars = written(star(large, larger=False), "stars")
        before, state = state, signature(stars)
        if state == before:
            break
        current = stars
    roots = stars.select(F.col("to").alias("node"), F.col("to").alias("component"))
    return stars.select("node", F.col("to").alias("component")).union(roots).distinct()


def signature(edges: DataFrame) -> tuple:
    """Number and combined hashes of the edges: equal for equal sets of edges."""
    both = F.xxhash64("node", "to")
    return tuple(edges.agg(F.count("*"), F.bit_xor(both), F.sum(F.shiftright(both, 20))).first())


def star(edges: DataFrame, larger: bool) -> DataFrame:
    """One half of a round over edges from greater to smaller nodes."""
    turned = edges.select(F.col("to").alias("node"), F.col("node").alias("to"))
    around = edges.unionAll(turned) if larger else edges
    least = around.groupBy("node").agg(F.min("to").alias("least"))
    least = least.select(F.col("node").alias("centre"), F.least("node", "least").alias("least"))
    joined = around.join(least, around["node"] == least["centre"])
    if larger:
        moved = joined.filter("to > node").select(F.col("to").alias("node"), F.col("least").alias("to"))
    else:
        tied = joined.select(F.col("to").alias("node"), F.col("least").alias("to"))
        moved = tied.unionAll(least.select(F.col("centre").alias("node"), F.col("least").alias("to")))
    return moved.filter("node > to").distinct()
