"""Near duplicates by an exact Jaccard metric-space join over word shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import ROW, byte_column, give_back, numbered, without_rows
from casebook.llm.components import components
from casebook.llm.fingerprints import (
    ENTRY_SCHEMA,
    SHARED_SCHEMA,
    buckets_for,
    entry_rows,
    numbered_blocks,
    shared_in_bucket,
    unpacked,
)
from casebook.llm.shingles import shingle_sets
from casebook.session import written

WORDS = 5
PERCENT = 80
#: Rounds of pivots before what is left of the regions is joined.
ROUNDS = 3
#: Rows of a region that one task should meet; more are salted.
REGION_ROWS = 1_000
#: Width of the triangle-inequality window, with room for rounding.
ROUNDING = 1e-9


def needed(n: int | np.ndarray, percent: int):
    """The least intersection of a set of n with any set that is ``percent`` similar."""
    return -(-n * percent // 100)


OF_DOCUMENT = ", row long, doc_id long, n long, digest binary"
DOCUMENT_SCHEMA = ENTRY_SCHEMA + OF_DOCUMENT
NAMES = [column.split()[0] for column in DOCUMENT_SCHEMA.split(", ")]


def without_document(packed: pa.RecordBatch | pa.Table) -> list:
    """The columns of packed rows, with nothing in those of a document."""
    longs, rows = pa.nulls(packed.num_rows, pa.int64()), packed.num_rows
    return [*packed.columns, longs, longs, longs, pa.nulls(rows, pa.binary())]


def document_rows(n: int, buckets: int):
    """Rows of documents, dealt out evenly above the buckets, and packed rows of their shingles."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in numbered_blocks(batches, "text"):
            sets, bounds = shingle_sets(*byte_column(block.column(1)), n)
            sizes = np.diff(bounds)
            digests = [
                hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            rows = block.num_rows
            nothing = pa.nulls(rows, pa.binary())
            yield pa.record_batch(
                [
                    pa.array((buckets + np.arange(row, row + rows) % buckets).astype(np.int32)),
                    pa.array(np.full(rows, row)), nothing, nothing, nothing,
                    pa.array(np.arange(row, row + rows)), block.column(0), pa.array(sizes), pa.array(digests, pa.binary()),
                ],
                names=NAMES,
            )
            if len(sets):
                packed = entry_rows(row, sets, np.repeat(np.arange(rows), sizes), buckets)
                yield pa.record_batch(without_document(packed), names=NAMES)
        sets = bounds = sizes = packed = None
        give_back()

    return compute


PARTED_SCHEMA = SHARED_SCHEMA + OF_DOCUMENT


def shared_or_document(buckets: int):
    def compute(rows: pa.Table) -> pa.Table:
        if rows["bucket"][0].as_py() >= buckets:
            nothing = pa.nulls(rows.num_rows, pa.binary())
            columns = [rows["block"], nothing, nothing, nothing, rows["row"], rows["doc_id"], rows["n"], rows["digest"]]
        else:
            columns = without_document(shared_in_bucket(rows))
            give_back()
        return pa.table(columns, names=[column.split()[0] for column in PARTED_SCHEMA.split(", ")])

    return compute


NODE_SCHEMA = "node long, n long, shared array<long>, prefix array<struct<value:long,count:long>>"


def node_rows(percent: int):
    """Documents that may have links: those with enough shared shingles, as ordered prefixes."""

    def compute(packed: pa.Table, nodes: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if packed.num_rows and nodes.num_rows:
            docs, values, counts = unpacked(packed)
            block = packed["block"][0].as_py()
            # the block's shared values are dealt to its documents
            for node, n in zip(nodes["node"].to_pylist(), nodes["n"].to_pylist(), strict=True):
                a, b = np.searchsorted(docs, [node - block, node - block + 1])
                spare = (b - a) - needed(n, percent)
                if spare < 0:
                    continue
                order = np.lexsort((values[a:b], counts[a:b]))[: spare + 1]
                own = values[a:b].view(np.int64)
                prefix = [{"value": int(own[i]), "count": int(counts[a + i])} for i in order]
                out.append((node, n, own, prefix))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.struct({"value": pa.int64(), "count": pa.int64()}))]
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["node", "n", "shared", "prefix"])

    return compute


def compared(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """pairs (left, right), and whether they are linked, by their whole sets."""
    left = nodes.select(F.col("node").alias("left"), F.col("n").alias("n_left"), F.col("shared").alias("set_left"))
    right = nodes.select(F.col("node").alias("right"), F.col("n").alias("n_right"), F.col("shared").alias("set_right"))
    common = F.size(F.array_intersect("set_left", "set_right")).cast("long")
    both = pairs.join(right, "right").join(left, "left").select("left", "right", "n_left", "n_right", common.alias("common"))
    linked = 100 * F.col("common") >= percent * (F.col("n_left") + F.col("n_right") - F.col("common"))
    return both.select("left", "right", linked.alias("linked"))


def labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with the component their node is in so far."""
    found = components(links).withColumnRenamed("node", "of_node")
    joined = members.join(found, F.col("node") == F.col("of_node"), "left")
    return joined.select(*members.columns, F.coalesce("component", "node").alias("component"))


def salted(members: DataFrame) -> DataFrame:
    """Rows of large regions are dealt to several tasks by their node."""
    return members.withColumn("parts", F.ceil(F.col("count") / REGION_ROWS)).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts"))
    )


def open_regions(members: DataFrame, seed: int) -> DataFrame:
    """Regions with members in several components, and their pivot: the member with the least hash of the round.

    Regions with nearly the same members mostly have the same pivot.
    """
    order = F.struct(F.xxhash64(F.lit(seed), "node").alias("order"), "node", "n", "s", "component")
    return (
        members.groupBy("value")
        .agg(F.min(order).alias("pivot"), F.min("component").alias("least"), F.max("component").alias("most"),
             F.max("parts").alias("parts"), F.min("n").alias("least_n"))
        .filter("least < most")
        .select("value", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("pivot_n"), F.col("pivot.s").alias("pivot_s"),
                F.col("pivot.component").alias("pivot_component"), "least_n")
    )


def could_link(n_left: Column, s_left: Column, n_right: Column, s_right: Column, percent: int) -> Column:
    """Whether sets of these sizes and numbers of shared shingles may be ``percent`` similar."""
    most = F.least(s_left, s_right)
    return 100 * most >= percent * (n_left + n_right - most)


def links_between(nodes: DataFrame, percent: int, rounds: int = ROUNDS) -> DataFrame:
    """Links (left, right) that connect just those nodes which chains of all links connect.

    Every pair of linked nodes shares a value of both prefixes; the nodes of a value are a region. In each
    round every region takes a member as pivot, and every node of another component is compared
    with its nearest pivot, the one it shares most regions with: these are the Voronoi regions of the
    round. Groups of thousands of near copies collapse into stars so. What is still apart is joined by
    ``joined_cells``.
    """
    members = nodes.select("node", "n", F.size("shared").alias("s"), F.explode("prefix").alias("entry"))
    members = written(salted(members.select("node", "n", "s", "entry.value", "entry.count")), "members")
    spark = nodes.sparkSession
    links = spark.createDataFrame([], "left long, right long")
    known = links
    for seed in range(rounds):
        current = written(labelled(members, links), "labelled-members") if seed else members.withColumn("component", F.col("node"))
        regions = open_regions(current, seed)
        possible = could_link(F.col("n"), F.col("s"), F.col("pivot_n"), F.col("pivot_s"), percent)
        met = (
            current.join(regions, ["value", "part"])
            .filter((F.col("component") != F.col("pivot_component")) & possible)
            .groupBy("node", "pivot").count()
        )
        nearest = met.groupBy("node").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("pivot"))
        pairs = nearest.select(F.col("node").alias("left"), F.col("pivot").alias("right"))
        pairs = pairs.join(known, ["left", "right"], "left_anti")
        fresh = written(compared(pairs, nodes, percent), "pivots")
        known = known.unionAll(fresh.select("left", "right"))
        links = written(links.unionAll(fresh.filter("linked").select("left", "right")), "links")
        if not fresh.take(1):
            break
    current = written(labelled(members, links), "labelled-members")
    return links.unionAll(joined_cells(current, nodes, percent, rounds))


#: Nodes of either side that one task joins.
CELL_NODES = 1_000
CELL_SCHEMA = "left long, right long"


def joined_cells(members: DataFrame, nodes: DataFrame, percent: int, seed: int) -> DataFrame:
    """Links between components that meet in a region: the regions with one pivot are a cell, joined exactly.

    One side of a cell are the members outside their region's largest component, if their sizes let
    them have links at all; the other are all members, the boundary members of other cells among
    them. Cells are joined in blocks of CELL_NODES by CELL_NODES, so that none is too large for a task.
    """
    regions = open_regions(members, seed)
    inside = members.join(regions.drop("pivot_n", "pivot_s", "pivot_component"), ["value", "part"])
    sizes = inside.groupBy("value", "component").count()
    main = sizes.groupBy("value").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    main = main.join(regions.select("value", "part"), "value")
    minor = inside.join(main, ["value", "part"]).filter("component != main").filter(
        could_link(F.col("n"), F.col("s"), F.col("least_n"), F.col("s"), percent)
    )
    left = written(minor.select("pivot", "node", "value").distinct(), "cell-left")
    asked = left.select("value").distinct()
    asked = asked.join(regions.select("value", "part"), "value")
    right = inside.join(asked, ["value", "part"], "left_semi").select("pivot", "node").distinct()
    left = left.select("pivot", "node").distinct()
    both = written(left.withColumn("side", F.lit(0)).unionAll(right.withColumn("side", F.lit(1))), "cells")
    counts = both.groupBy("pivot").agg(
        F.ceil(F.count_if(F.col("side") == 0) / CELL_NODES).alias("rows"), F.ceil(F.count_if(F.col("side") == 1) / CELL_NODES).alias("columns")
    )
    pivots = counts.select("pivot", F.col("pivot").alias("node"), F.lit(2).alias("side"))
    block = lambda count: F.pmod(F.xxhash64(F.lit("block"), "node"), F.col(count))
    whole = lambda count: F.sequence(F.lit(0).cast("long"), F.col(count) - 1)
    # a node meets all blocks of the other side, the pivot all blocks of both
    placed = (
        both.unionAll(pivots).join(counts, "pivot")
        .withColumn("row", F.explode(F.when(F.col("side") == 0, F.array(block("rows"))).otherwise(whole("rows"))))
        .withColumn("column", F.explode(F.when(F.col("side") == 1, F.array(block("columns"))).otherwise(whole("columns"))))
        .select("pivot", "row", "column", "node", "side")
    )
    components_of = members.select(F.col("node").alias("of_node"), "component").distinct()
    sets = nodes.select(F.col("node").alias("of_node"), "n", "shared").join(components_of, "of_node")
    filled = placed.join(sets, F.col("node") == F.col("of_node")).drop("of_node")
    return filled.groupBy("pivot", "row", "column").applyInArrow(join_cell(percent), CELL_SCHEMA)


def join_cell(percent: int):
    """All links between components of one block of a cell, one for each node and component."""

    def compute(rows: pa.Table) -> pa.Table:
        side = rows["side"].to_numpy()
        n, component, node = (rows[name].to_numpy() for name in ("n", "component", "node"))
        sets = rows["shared"].combine_chunks()
        bounds = sets.offsets.to_numpy()
        values = sets.values.to_numpy()[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        _, columns = np.unique(values, return_inverse=True)
        owner = np.repeat(np.arange(len(node)), np.diff(bounds))
        pivot = np.flatnonzero(side == 2)[0]
        of_pivot = np.isin(columns, columns[bounds[pivot] : bounds[pivot + 1]])
        common = np.bincount(owner[of_pivot], minlength=len(node))
        apart = 1 - common / (n + n[pivot] - common)
        order = np.argsort(apart, kind="stable")
        left, right = order[side[order] == 0], order[side[order] == 1]
        out: list[tuple[int, int]] = []
        window = 1 - percent / 100 + ROUNDING
        for start in range(0, len(left), 128):
            some = left[start : start + 128]
            # the triangle inequality over the pivot leaves these
            low, high = np.searchsorted(apart[right], [apart[some[0]] - window, apart[some[-1]] + window + ROUNDING])
            near = right[low:high]
            if not len(near):
                continue
            shared_by = intersections(some, near, columns, bounds)
            linked = 100 * shared_by >= percent * (n[some][:, None] + n[near][None, :] - shared_by)
            linked &= component[some][:, None] != component[near][None, :]
            for i, j in zip(*np.nonzero(linked), strict=True):
                out.append((node[some[i]], node[near[j]], component[near[j]]))
        # one link of a node to a component does
        found = {(a, c): (a, b) for a, b, c in out}
        columns_out = list(zip(*found.values(), strict=True)) or [(), ()]
        return pa.table([pa.array(list(c), pa.int64()) for c in columns_out], names=["left", "right"])

    return compute


def intersections(some: np.ndarray, near: np.ndarray, columns: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many elements each pair of rows has in common, as a product of 0-1 matrices in parts."""
    take = lambda rows: np.concatenate([columns[bounds[r] : bounds[r + 1]] for r in rows])
    own, theirs = take(some), take(near)
    names = np.intersect1d(own, theirs)
    own_row = np.repeat(np.arange(len(some)), np.diff(bounds)[some])
    their_row = np.repeat(np.arange(len(near)), np.diff(bounds)[near])
    total = np.zeros((len(some), len(near)), np.float32)
    for start in range(0, len(names), 4096):
        part = names[start : start + 4096]
        matrices = []
        for rows, elements, height in ((own_row, own, len(some)), (their_row, theirs, len(near))):
            inside = (elements >= part[0]) & (elements <= part[-1])
            at = np.searchsorted(part, elements[inside])
            hit = part[at] == elements[inside]
            matrix = np.zeros((height, len(part)), np.float32)
            matrix[rows[inside][hit], at[hit]] = 1
            matrices.append(matrix)
        total += matrices[0] @ matrices[1].T
    return total.astype(np.int64)


def near_duplicates(docs: DataFrame, n: int = WORDS, percent: int = PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """Components of documents whose ``n``-word shingle sets are ``percent`` similar or more by Jaccard.

    Words are what blanks and the white space of 0x09 to 0x0D separate, with A-Z in lower case. All
    texts are read whole and once. Shingles are 64-bit fingerprints, kept apart by 54 bits or more
    once they are shared; sets are compared in full, so a wrong link needs such a collision.

    1. All shingles are dealt into buckets; those of one document alone are dropped, exactly.
    2. Documents with one set of shingles become one node (the first of them in the input).
    3. A node without enough shared shingles for any link is done. The others are put into regions
       by their rarest shared shingles, as many as a link cannot avoid.
    4. Regions are joined by pivots, in rounds, and what remains in cells around them (``links_between``).
    5. Links make components, and every document gets the least doc_id of its component.

    Nothing of this is gathered in one place, and groups of copies are one node or one star.

    Returns doc_id, n_shingles, component_id, one row for each row of ``docs``. Null and blank texts
    have no shingles and are alone; a null doc_id is never a component's name unless all its
    documents have none; rows of one doc_id are documents of their own; an empty table gives no
    rows. Further columns are not read. ``docs`` is evaluated once.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = buckets_for(docs)
    entries = read.mapInArrow(document_rows(n, buckets), DOCUMENT_SCHEMA)
    parted = written(entries.groupBy("bucket").applyInArrow(shared_or_document(buckets), PARTED_SCHEMA), "shared")
    documents = parted.filter("n is not null").select("block", "row", "doc_id", "n", "digest")
    classes = written(
        documents.filter("digest is not null").groupBy("digest", "n")
        .agg(F.min(F.struct("row", "block")).alias("first"), F.min("doc_id").alias("least_id"))
        .select("digest", "n", F.col("first.row").alias("node"), F.col("first.block").alias("block"), "least_id"),
        "classes",
    )
    packed = parted.filter("n is null").select("block", "docs", "values", "counts")
    firsts = classes.select("block", "node", "n")
    dealt = packed.groupBy("block").cogroup(firsts.groupBy("block")).applyInArrow(node_rows(percent), NODE_SCHEMA)
    nodes = written(dealt, "nodes")
    found = components(links_between(nodes, percent, rounds))
    named = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    classified = named.join(names, "component").select("digest", "n", "component_id")
    return documents.join(classified, ["digest", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: that of the least doc_id, then the first.

    Rows are told by their place in the input, so rows of one doc_id, or without one, that differ in their
    texts are judged each for itself; exact repeats are copies. Rows without words stay.
    """
    rows = numbered(docs)
    classes = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text")).filter("n_shingles > 0")
    named = rows.select(F.col(ROW).alias("_row"), "doc_id").join(classes.withColumnRenamed("doc_id", "_of"), F.col("_row") == F.col("_of"))
    members = written(named.select("component_id", F.col("doc_id").isNull().alias("without_id"), "doc_id", "_row"), "members")
    best = members.groupBy("component_id").agg(F.min(F.struct("without_id", "doc_id", "_row")).alias("best"), F.count("*").alias("size"))
    best = best.filter("size > 1").select("component_id", F.col("best._row").alias("_best"))
    copies = members.join(best, "component_id").filter("_row != _best")
    return without_rows(rows, copies.select(F.col("_row").alias("_found")))
