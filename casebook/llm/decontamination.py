"""Benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import ROW, let, numbered, without_rows
from casebook.session import written

WORDS = 5
PERCENT = 80
#: Sketch rows (16 bytes each), or ids of documents to verify, that are still broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes of a broadcast id at most, on the average.
ID_BYTES = 64


def words_of(column: str) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def starts(words: Column, n: int) -> Column:
    """Where shingles begin; a text of fewer words is one shingle, one without words is none."""
    last = F.greatest(F.size(words) - (n - 1), F.lit(1))
    return F.when(F.size(words) > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def shingles_of(words: Column, n: int) -> Column:
    return let(words, lambda w: F.transform(starts(w, n), lambda i: F.array_join(F.slice(w, i, n), " ")))


def hashes_of(words: Column, n: int) -> Column:
    return let(words, lambda w: F.transform(starts(w, n), lambda i: F.xxhash64(F.slice(w, i, n))))


def needed(shingles: Column, percent: int) -> Column:
    """The smallest whole number of shingles that is ``percent`` of all, without rounding errors."""
    return F.floor((shingles * percent + 99) / 100).cast("int")


def sketches(items: DataFrame, n: int, percent: int) -> DataFrame:
    """item_id, need, hash: the minima of every item, as many as its size class needs.

    An item of q shingles is found in a document that holds ``percent`` of them, so one of any
    q - needed(q) + 1 of its shingles is in that document. Items are partitioned by
    size into classes that end at powers of two, and each class keeps the number of minima its
    largest size needs: no item is lost, and short items have short sketches. Minima are taken in one
    order for all items, by the number of items that hold a shingle and then by its hash, so a phrase that
    many items share is in their sketches last, and a document that holds no more of them meets none.
    """
    classed = (
        items.select("item_id", F.array_distinct(hashes_of(words_of("text"), n)).alias("hashes"))
        .filter(F.size("hashes") > 0)
        .withColumn("upper", F.pow(F.lit(2), F.ceil(F.log2(F.size("hashes")))).cast("int"))
    )
    length = F.col("upper") - needed(F.col("upper"), percent) + 1
    need = needed(F.size("hashes"), percent)
    # rows of one item_id are items of their own
    rows = classed.select(F.monotonically_increasing_id().alias("item"), "item_id", need.alias("need"), length.alias("length"), "hashes")
    placed = written(rows.select("item", "item_id", "need", "length", F.explode("hashes").alias("hash")), "item-shingles")
    held_by = placed.groupBy("hash").agg(F.count("*").alias("held_by"))
    ordered = F.array_sort(F.collect_list(F.struct("held_by", "hash")))
    minima = (
        placed.join(held_by, "hash").groupBy("item", "item_id", "need", "length").agg(ordered.alias("ordered"))
        .select("item_id", "need", F.explode(F.slice("ordered", F.lit(1), F.col("length"))).alias("least"))
    )
    return minima.select("item_id", "need", F.col("least.hash").alias("hash"))


def short_lengths(items: DataFrame, n: int) -> list[int]:
    """The numbers of words, fewer than ``n``, that items have."""
    sizes = items.select(F.size(words_of("text")).alias("words")).filter((F.col("words") > 0) & (F.col("words") < n)).distinct()
    return sorted(r.words for r in sizes.collect())


def with_short(of: Callable[[Column, int], Column], n: int, lengths: list[int]) -> Column:
    """The ``n``-word shingles of a text, as ``of`` makes them, and its shingles of the shorter lengths."""
    if not lengths:
        return of(words_of("text"), n)
    return let(words_of("text"), lambda w: F.concat(*[of(w, length) for length in (n, *lengths)]))


def contaminated(
    docs: DataFrame, items: DataFrame, n: int = WORDS, percent: int = PERCENT, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Documents that hold ``percent`` or more of the distinct ``n``-word shingles of a test item.

    The MinHash sketches of the items are probed with all shingles of all documents, whole
    texts, inside the scan; documents with fewer shingles than a match needs are told by their
    size. What is found is verified on the words themselves. The sketch is broadcast only when its
    counted rows are within ``broadcast_rows``, otherwise both sides are joined by shuffle; and so are the
    ids of the documents to verify, which leave all other texts out of the shuffle. The
    result is the same.

    Returns doc_id, item_id, item_shingles, shared_shingles, containment: one row for each pair, the
    best of several rows with one doc_id. Words are lower-case runs of letters and digits. An item
    with fewer than ``n`` words is one shingle, found wherever a document holds these words in a row;
    texts that are null or hold no words match nothing. A null doc_id or item_id
    is an id like another. Further columns are not read.
    """
    documents = docs.select("doc_id", "text")
    tests = items.select("item_id", "text").distinct()
    sketch = written(sketches(tests, n, percent), "sketches")
    if sketch.count() <= broadcast_rows:
        sketch = F.broadcast(sketch)
    lengths = short_lengths(tests, n)
    hashed = (
        documents.select("doc_id", with_short(hashes_of, n, lengths).alias("hashes"))
        .select("doc_id", F.size("hashes").alias("held"), F.explode("hashes").alias("hash"))
    )
    candidates = (
        hashed.join(sketch, "hash").filter(F.col("held") >= F.col("need")).select("doc_id", "item_id").distinct()
    )
    candidates = written(candidates.select(F.col("doc_id").alias("of_doc"), F.col("item_id").alias("of_item")), "candidates")
    asked = tests.select("item_id", F.array_distinct(shingles_of(words_of("text"), n)).alias("item_set"))
    to_verify = written(candidates.select("of_doc").distinct(), "documents-to-verify")
    ids = to_verify.agg(F.count("*").alias("rows"), F.avg(F.octet_length(F.col("of_doc").cast("string"))).alias("bytes")).first()
    if ids.rows <= broadcast_rows and (ids.bytes or 0) <= ID_BYTES:
        documents = documents.join(F.broadcast(to_verify), F.col("doc_id").eqNullSafe(F.col("of_doc")), "left_semi")
    pairs = candidates.join(asked, F.col("of_item").eqNullSafe(F.col("item_id")))
    # the text joins last, so that it is moved once whatever the number of items it holds
    by_doc = pairs.groupBy("of_doc").agg(F.collect_list(F.struct("item_id", "item_set")).alias("items"))
    held = (
        documents.join(by_doc, F.col("doc_id").eqNullSafe(F.col("of_doc")))
        .select("doc_id", "items", with_short(shingles_of, n, lengths).alias("doc_set"))
        .select("doc_id", "doc_set", F.explode("items").alias("item"))
        .select(
            "doc_id", F.col("item.item_id").alias("item_id"), F.size("item.item_set").alias("item_shingles"),
            F.size(F.array_intersect("item.item_set", "doc_set")).alias("shared_shingles"),
        )
        .filter(F.col("shared_shingles") >= needed(F.col("item_shingles"), percent))
    )
    best = held.groupBy("doc_id", "item_id").agg(
        F.max(F.struct((F.col("shared_shingles") / F.col("item_shingles")).alias("containment"),
                       "item_shingles", "shared_shingles")).alias("best")
    )
    return best.select("doc_id", "item_id", "best.item_shingles", "best.shared_shingles", "best.containment")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that hold no test item, with all their columns; rows of one doc_id are judged each for itself."""
    rows = numbered(docs)
    found = contaminated(rows.select(F.col(ROW).alias("doc_id"), "text"), items)
    return without_rows(rows, found.select(F.col("doc_id").alias("_found")).distinct())
