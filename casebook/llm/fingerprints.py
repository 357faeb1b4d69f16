"""Which fingerprints of a corpus occur in several documents: found by buckets, in packed rows.

A block of documents sends one row to each bucket, with all its fingerprints of that bucket in two
binary columns; so billions of fingerprints move as few rows, six bytes each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import ROW_BITS, blocks_of

#: Text of a block, which is in memory as a whole, and documents of it, counted in 16 bits.
BLOCK_BYTES = 2 << 20
BLOCK_DOCS = 1 << 16
#: Text whose fingerprints are in one bucket, on average.
BUCKET_BYTES = 6 << 20
LOW_BITS = 48
LOW = np.uint64((1 << LOW_BITS) - 1)

#: Fingerprints of a block's documents: values, and the document of each, ascending.
Prints = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def buckets_for(docs: DataFrame) -> int:
    """As many buckets as the text needs for all of them to stay small."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(16, -(-size // BUCKET_BYTES))


def numbered_blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Blocks of a task's rows with the number of their first row: the partition's number above ROW_BITS."""
    row = TaskContext.get().partitionId() << ROW_BITS
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_DOCS - 1):
            for block in blocks_of(batch.slice(start, BLOCK_DOCS - 1), column, BLOCK_BYTES):
                yield row, block
                row += block.num_rows


ENTRY_SCHEMA = "bucket int, block long, docs binary, high binary, low binary"


def entry_rows(block: int, values: np.ndarray, docs: np.ndarray, buckets: int, exact: bool = True) -> pa.RecordBatch:
    """A block's fingerprints by bucket: documents as steps of 16 bits, 48 bits of each value.

    With ``exact`` off, for a search whose findings are compared in full later, 32 bits.
    """
    bucket = (values % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, values, docs = bucket[order], values[order] & LOW, docs[order]
    firsts = np.flatnonzero(np.diff(bucket, prepend=-1))
    steps = np.diff(docs, prepend=0)
    steps[firsts] = docs[firsts]
    steps, high, low = steps.astype("<u2"), (values >> np.uint64(16)).astype("<u4"), (values & np.uint64(0xFFFF)).astype("<u2")
    low = low if exact else low[:0]
    ends = np.append(firsts[1:], len(bucket))
    cut = lambda a: pa.array([a[i:j].tobytes() for i, j in zip(firsts, ends, strict=True)], pa.binary())
    return pa.record_batch(
        [
            pa.array(bucket[firsts], pa.int32()), pa.array(np.full(len(firsts), block), pa.int64()),
            cut(steps), cut(high), cut(low),
        ],
        names=["bucket", "block", "docs", "high", "low"],
    )


SHARED_SCHEMA = "block long, docs binary, values binary, counts binary"


def shared_in_bucket(entries: pa.Table) -> pa.Table:
    """The fingerprints of one bucket that several documents have, by block.

    A value is told by its bucket and 48 more bits. A document holds each value once.
    """
    rows = entries.sort_by("block")
    steps = [np.frombuffer(b.as_py(), "<u2").astype(np.int64) for b in rows["docs"]]
    high = np.frombuffer(b"".join(b.as_py() for b in rows["high"]), "<u4").astype(np.uint64)
    low = np.frombuffer(b"".join(b.as_py() for b in rows["low"]), "<u2").astype(np.uint64)
    values = high << np.uint64(16)
    if len(low):
        values |= low
    order = np.argsort(values)
    ordered = values[order]
    firsts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(values) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(firsts, len(values)))
    counts = np.empty(len(values), np.int64)
    counts[order] = np.repeat(sizes, sizes)
    bucket = np.uint64(rows["bucket"][0].as_py()) << np.uint64(LOW_BITS)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in steps])]).astype(np.int64)
    found = []
    for i, block in enumerate(rows["block"].to_pylist()):
        own = counts[bounds[i] : bounds[i + 1]]
        kept = own > 1
        if kept.any():
            docs = np.cumsum(steps[i])[kept].astype("<u2")
            named = (values[bounds[i] : bounds[i + 1]][kept] | bucket).astype("<u8")
            found.append((block, docs.tobytes(), named.tobytes(), np.minimum(own[kept], 2**32 - 1).astype("<u4").tobytes()))
    columns = list(zip(*found, strict=True)) or [(), (), (), ()]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["block", "docs", "values", "counts"])


def shared(entries: DataFrame) -> DataFrame:
    """block, docs, values, counts: what is shared, in packed rows for each block and bucket.

    Entries are dealt by bucket, an even share of all values; a value in a third of all documents
    adds one entry per document to a bucket like any other's.
    """
    return entries.groupBy("bucket").applyInArrow(shared_in_bucket, SHARED_SCHEMA)


def unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, values and counts of all packed rows of a block, by document."""
    join = lambda name, kind: np.frombuffer(b"".join(b.as_py() for b in rows[name]), kind)
    docs, values, counts = join("docs", "<u2").astype(np.int64), join("values", "<u8"), join("counts", "<u4")
    order = np.argsort(docs, kind="stable")
    return docs[order], values[order], counts[order]
