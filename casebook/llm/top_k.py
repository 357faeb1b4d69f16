"""Exact top-k search by inner product over ball trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.session import written

#: Components are floor(SCALE * x).
SCALE = 1024
#: Vectors of one shard, of one leaf, and queries that search a shard together.
SHARD_ROWS = 8_192
LEAF_ROWS = 64
BLOCK_QUERIES = 512
#: Each wave of regions is so many times as large as all before it.
WAVE_GROWTH = 3
#: Regions of space at most, and the vectors they are fitted to: so many, and so many bytes, those of least hash.
#: Larger regions have several shards, so that neither bounds the table.
REGIONS = 1_024
SAMPLE_VECTORS = 20_000
SAMPLE_BYTES = 64 << 20
#: Vectors of the sample in a region at least.
REGION_SAMPLE = 16
#: Components beyond this are cut to it, as no score could hold their products.
LARGEST = 2.0**62


def integer_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, dims, data (64-bit integers) of the vectors that take part."""
    for batch in batches:
        ids, kept, data, dims = batch.column(0).to_pylist(), [], [], []
        for vec_id, vector in zip(ids, batch.column(1), strict=True):
            if vec_id is None or not vector.is_valid or vector.values.null_count:
                continue
            values = np.asarray(vector.values.to_numpy(zero_copy_only=False), np.float64)
            if not np.isfinite(values).all():
                continue
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(values * SCALE), -LARGEST, LARGEST).astype(np.int64)
            kept.append(vec_id)
            dims.append(len(whole))
            data.append(whole.tobytes())
        yield pa.record_batch(
            [pa.array(kept, pa.int64()), pa.array(dims, pa.int32()), pa.array(data, pa.binary())], names=["vec_id", "dims", "data"]
        )


def matrix(data: list[bytes] | bytes, dims: int) -> np.ndarray:
    joined = b"".join(data) if isinstance(data, list) else data
    rows = len(data) if isinstance(data, list) else (len(joined) // (8 * dims) if dims else 0)
    return np.frombuffer(joined, np.int64).reshape(rows, dims)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact; those beyond 64 bits are cut to the nearest that fits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def ball_tree(vectors: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """An order of the vectors, and nodes (start, end, left, right) over it; leaves have no children.

    A node is split at the median of the direction between two of its far apart vectors.
    """
    order = np.arange(len(vectors))
    nodes: list[tuple] = []
    floats = vectors.astype(np.float64)

    def build(start: int, end: int) -> int:
        number = len(nodes)
        nodes.append((start, end, -1, -1))
        own = floats[order[start:end]]
        if end - start > LEAF_ROWS:
            far = own[np.argmax(((own - own.mean(axis=0)) ** 2).sum(axis=1))]
            other = own[np.argmax(((own - far) ** 2).sum(axis=1))]
            along = own @ (other - far)
            order[start:end] = order[start:end][np.argsort(along, kind="stable")]
            middle = (start + end) // 2
            nodes[number] = (start, end, build(start, middle), build(middle, end))
        return number

    build(0, len(vectors))
    return order, nodes


TREE_SCHEMA = "shard int, dims int, ids binary, vectors binary, nodes binary, centres binary, radii binary"


def build_shard(rows: pa.Table) -> pa.Table:
    """The ball tree of one shard: vectors in tree order, and every node's range, children, centre and radius."""
    dims = rows["dims"][0].as_py()
    rows = rows.sort_by("vec_id")
    vectors, ids = matrix(rows["data"].to_pylist(), dims), rows["vec_id"].to_numpy()
    order, nodes = ball_tree(vectors)
    vectors, ids = vectors[order], ids[order]
    floats = vectors.astype(np.float64)
    centres = np.array([floats[a:b].mean(axis=0) for a, b, _, _ in nodes]).reshape(len(nodes), dims)
    radii = np.array([np.sqrt(((floats[a:b] - c) ** 2).sum(axis=1).max()) for (a, b, _, _), c in zip(nodes, centres, strict=True)])
    pack = lambda a, kind: pa.array([np.ascontiguousarray(a, kind).tobytes()], pa.binary())
    return pa.table(
        [rows["shard"].slice(0, 1).combine_chunks(), rows["dims"].slice(0, 1).combine_chunks(), pack(ids, np.int64),
         pack(vectors, np.int64), pack(nodes, np.int64), pack(centres, np.float64), pack(radii, np.float64)],
        names=["shard", "dims", "ids", "vectors", "nodes", "centres", "radii"],
    )


def upper_bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """The largest inner product each query can have in each ball: with the centre, plus its length times the radius."""
    floats = queries.astype(np.float64)
    lengths = np.sqrt((floats**2).sum(axis=1))
    bounds = floats @ centres.T + lengths[:, None] * radii
    # room for the rounding of sums in 64-bit floats
    return bounds + 1 + 1e-9 * lengths[:, None] * (np.sqrt((centres**2).sum(axis=1)) + radii)


def search(queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, tree: dict, dims: int, k: int):
    """The best ``k`` of a shard for each query among scores of at least ``least``, by branch and bound.

    Nodes are taken in the order of the largest inner product any query could have in them: with
    the centre, plus the query's length times the radius. A node is left out for every query
    whose k-th score so far (at first the one from other shards) it can't reach.
    """
    ids, vectors = np.frombuffer(tree["ids"], np.int64), matrix(tree["vectors"], dims)
    if not dims:
        vectors = np.zeros((len(ids), 0), np.int64)
    nodes = np.frombuffer(tree["nodes"], np.int64).reshape(-1, 4)
    centres = np.frombuffer(tree["centres"], np.float64).reshape(len(nodes), dims)
    radii = np.frombuffer(tree["radii"], np.float64)
    bounds = upper_bounds(queries, centres, radii)
    nothing = np.iinfo(np.int64).min
    scores = np.full((len(queries), k), nothing)
    found = np.full((len(queries), k), np.iinfo(np.int64).max)
    # a float not above the score, whatever its size
    kth = np.nextafter(least.astype(np.float64), -np.inf)
    heap = [(-bounds[:, 0].max(), 0)]
    while heap:
        _, node = heapq.heappop(heap)
        asked = np.flatnonzero(bounds[:, node] >= kth)
        if not len(asked):
            continue
        start, end, left, right = nodes[node]
        if left >= 0:
            for child in (left, right):
                heapq.heappush(heap, (-bounds[asked, child].max(), int(child)))
            continue
        new = products(queries[asked], vectors[start:end])
        new[query_ids[asked][:, None] == ids[start:end][None, :]] = nothing
        new[new < kth[asked][:, None]] = nothing
        better = np.flatnonzero((new > nothing).any(axis=1))
        if not len(better):
            continue
        rows = asked[better]
        both = np.hstack([scores[rows], new[better]])
        names = np.hstack([found[rows], np.broadcast_to(ids[start:end], (len(rows), end - start))])
        # ~x falls as x grows, without overflow
        best = np.lexsort((names, ~both), axis=-1)[:, :k]
        scores[rows] = np.take_along_axis(both, best, axis=1)
        found[rows] = np.take_along_axis(names, best, axis=1)
        full = scores[rows, k - 1] > nothing
        kth[rows[full]] = np.maximum(kth[rows[full]], np.nextafter(scores[rows[full], k - 1].astype(np.float64), -np.inf))
    return scores, found


def searcher(k: int):
    """The best of one shard for the queries sent to it, a pair of both at a time."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = np.frombuffer(row["query_ids"], np.int64)
                queries = np.frombuffer(row["data"], np.int64).reshape(len(ids), row["dims"])
                least = np.frombuffer(row["least"], np.int64)
                scores, found = search(queries, ids, least, row, row["dims"], k)
                rows, places = np.nonzero(scores > np.iinfo(np.int64).min)
                yield pa.record_batch(
                    [pa.array(ids[rows]), pa.array(found[rows, places]), pa.array(scores[rows, places])],
                    names=["query_id", "vec_id", "score"],
                )

    return compute


class Regions:
    """Parts of space for vectors of one length: the upper levels of a tree, fitted to a sample."""

    def __init__(self, sample: np.ndarray, most: int):
        self.splits: list[tuple] = []
        self.centres: list[np.ndarray] = []
        self.root = self.split(sample.astype(np.float64), most)

    def split(self, own: np.ndarray, most: int) -> int:
        """The number of a split, or below 0 the complement of a region's number."""
        if most > 1 and len(own) >= 2 * REGION_SAMPLE:
            far = own[np.argmax(((own - own.mean(axis=0)) ** 2).sum(axis=1))]
            direction = own[np.argmax(((own - far) ** 2).sum(axis=1))] - far
            along = own @ direction
            middle = np.median(along)
            low = along < middle
            if low.any():
                number = len(self.splits)
                self.splits.append(())
                left, right = self.split(own[low], most // 2), self.split(own[~low], most - most // 2)
                self.splits[number] = (direction, middle, left, right)
                return number
        self.centres.append(own.mean(axis=0))
        return ~(len(self.centres) - 1)

    def numbers(self, floats: np.ndarray) -> np.ndarray:
        """The region of each vector."""
        at = np.full(len(floats), self.root)
        while (at >= 0).any():
            for number in np.unique(at[at >= 0]):
                rows = np.flatnonzero(at == number)
                direction, middle, left, right = self.splits[number]
                at[rows] = np.where(floats[rows] @ direction < middle, left, right)
        return ~at


def fit_regions(whole: DataFrame, shard_rows: int) -> dict[int, Regions]:
    """Regions by length of the vectors, about as many as there are shards; lengths outside of the sample have one."""
    rows, widest = whole.agg(F.count("*"), F.max("dims")).first()
    if not rows:
        return {}
    taken = max(1, min(SAMPLE_VECTORS, SAMPLE_BYTES // (8 * max(1, widest))))
    # a bounded number of vectors
    sample = whole.select("dims", "data").orderBy(F.xxhash64("vec_id", "data")).limit(taken).toArrow()
    found = {}
    for dims in sorted(set(sample["dims"].to_pylist())):
        own = sample.filter(pc.equal(sample["dims"], dims))["data"].to_pylist()
        share = len(own) / sample.num_rows
        found[dims] = Regions(matrix(own, dims), max(1, min(round(REGIONS * share), -(-int(rows * share) // shard_rows))))
    return found


def placer(regions: dict[int, Regions]):
    """Adds to vectors their region and their distance from its centre."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("dims").to_numpy()
            for dims in map(int, np.unique(lengths)):
                own = batch.filter(pa.array(lengths == dims))
                floats = matrix(own.column("data").to_pylist(), dims).astype(np.float64)
                known = regions.get(dims)
                at = known.numbers(floats) if known else np.zeros(len(floats), np.int64)
                centres = np.array(known.centres)[at] if known else np.zeros_like(floats)
                far = np.sqrt(((floats - centres) ** 2).sum(axis=1))
                yield pa.record_batch(
                    [*own.columns, pa.array(at.astype(np.int32)), pa.array(far)], names=["vec_id", "dims", "data", "region", "far"]
                )

    return place


def router(regions: dict[int, Regions], sizes: dict[int, list[tuple]], first: int, last: int):
    """Sends queries to the regions that rank from ``first`` to before ``last`` for their block.

    The rank is by the largest inner product that any query of the block could have in a region. Only
    the queries go whose own bound there reaches their k-th score so far.
    """

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                dims, ids = block["dims"], np.frombuffer(block["ids"], np.int64)
                queries = np.frombuffer(block["data"], np.int64).reshape(len(ids), dims)
                least = np.frombuffer(block["least"], np.int64)
                number, radii, shard, shards = map(np.array, zip(*sizes[dims], strict=True))
                centres = np.array(regions[dims].centres)[number] if dims in regions else np.zeros((1, dims))
                bounds = upper_bounds(queries, centres, radii)
                kth = np.nextafter(least.astype(np.float64), -np.inf)
                for at in np.argsort(-bounds.max(axis=0), kind="stable")[first:last]:
                    asked = bounds[:, at] >= kth
                    if asked.any():
                        sent = [ids[asked].tobytes(), queries[asked].tobytes(), least[asked].tobytes()]
                        yield pa.record_batch(
                            [pa.array([int(shard[at])], pa.int32()), pa.array([int(shards[at])], pa.int32()),
                             pa.array([dims], pa.int32()), *(pa.array([x], pa.binary()) for x in sent)],
                            names=["first_shard", "shards", "dims", "query_ids", "data", "least"],
                        )

    return route


SENT_SCHEMA = "first_shard int, shards int, dims int, query_ids binary, data binary, least binary"
BLOCK_SCHEMA = "dims int, ids binary, data binary, least binary"


def pack_block(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("query_id")
    pack = lambda a: pa.array([a], pa.binary())
    return pa.table(
        [rows["dims"].slice(0, 1).combine_chunks(),
         pack(rows["query_id"].to_numpy().tobytes()), pack(b"".join(rows["data"].to_pylist())),
         pack(rows["least"].to_numpy().tobytes())],
        names=["dims", "ids", "data", "least"],
    )


def best_of(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` highest scores, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, query_every: int = 100, k: int = 10, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` rows of largest integer inner product with each query, exactly.

    Queries are the rows whose vec_id ``query_every`` divides; all rows but those with the query's
    own id are candidates. Vectors go to regions of space, the upper levels of a tree fitted to a bounded
    sample, and within a region by hash into shards of bounded size, each with a ball tree. Blocks of queries of a
    region meet the regions in waves, those of the largest bound first, each wave larger than all
    before it. A query takes its k-th score so far into the next wave and is sent only to regions whose bound
    reaches it. The queries travel: a tree is shuffled once in a wave, however many queries there are.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. Vectors that are null
    or hold a null or non-finite component take no part, nor do rows without vec_id; a vector is
    compared with those of its own length only. Of several rows with a query's id the query is
    the one with the least data; repeated candidates count each. An empty table gives no rows.
    Further columns are not read.
    """
    spark = vectors.sparkSession
    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    whole = read.mapInArrow(integer_vectors, "vec_id long, dims int, data binary")
    regions = fit_regions(whole, shard_rows)
    placed = written(whole.mapInArrow(placer(regions), "vec_id long, dims int, data binary, region int, far double"), "placed")
    # a row for each region
    sizes, shards = {}, 0
    listed = []
    per_region = placed.groupBy("dims", "region").agg(F.count("*").alias("n"), F.max("far").alias("radius"))
    for r in per_region.orderBy("dims", "region").collect():
        own = -(-r.n // shard_rows)
        sizes.setdefault(r.dims, []).append((r.region, r.radius, shards, own))
        listed.append((r.dims, r.region, shards, own))
        shards += own
    in_region = F.broadcast(spark.createDataFrame(listed, "dims int, region int, first_shard int, shards int"))
    place = (F.col("first_shard") + F.pmod(F.xxhash64("vec_id", "data"), "shards")).cast("int")
    dealt = placed.join(in_region, ["dims", "region"]).select(place.alias("shard"), "dims", "vec_id", "data")
    trees = written(dealt.groupBy("shard", "dims").applyInArrow(build_shard, TREE_SCHEMA), "trees")
    asked = placed.filter(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(F.min(F.struct("dims", "data", "region")).alias("v"))
    queries = written(asked.select(F.col("vec_id").alias("query_id"), "v.*"), "queries")
    blocks = queries.groupBy("dims", "region").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("blocks"))
    # as many rows as regions
    queries = queries.join(F.broadcast(blocks), ["dims", "region"])
    queries = queries.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "query_id"), "blocks")).drop("blocks")
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    most, first = max(map(len, sizes.values()), default=0), 0
    while first < most:
        last = min(most, max(1, first * (1 + WAVE_GROWTH)))
        kth = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
        lowest = F.lit(-(2**63) + 1).cast("long")
        current = queries.join(kth, "query_id", "left").withColumn("least", F.coalesce("least", lowest))
        packed = current.groupBy("dims", "region", "block").applyInArrow(pack_block, BLOCK_SCHEMA)
        sent = packed.mapInArrow(router(regions, sizes, first, last), SENT_SCHEMA)
        every = F.explode(F.sequence("first_shard", F.col("first_shard") + F.col("shards") - 1))
        sent = sent.select(every.alias("shard"), "dims", "query_ids", "data", "least")
        met = sent.join(trees, ["shard", "dims"])
        new = met.mapInArrow(searcher(k), "query_id long, vec_id long, score long")
        found = written(best_of(found.select("query_id", "vec_id", "score").unionAll(new), k), "best")
        first = last
    return found
