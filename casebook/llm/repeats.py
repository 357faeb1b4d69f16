"""Removal of repeated byte strings by suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import byte_column, unsigned_mix, whole_text
from casebook.llm.fingerprints import (
    ENTRY_SCHEMA,
    LOW_BITS,
    buckets_for,
    entry_rows,
    numbered_blocks,
    shared,
    unpacked,
)
from casebook.llm.suffixes import binary_search, common_prefixes, keys_of, suffix_array
from casebook.session import written

#: A repeated string has this many bytes; the least hash of a gram of it decides where it is compared.
LENGTH = 50
GRAM = 24
GRAMS = LENGTH - GRAM + 1
#: Windows of one segment at most, bytes of one suffix array, and documents of a value above which its
#: windows are dealt out one by one.
SEGMENT_WINDOWS = 64
SHARD_BYTES = 4 << 20
HOT_DOCUMENTS = 20_000

BYTE_VALUES = unsigned_mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(body: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on, from those of 8 and 16 bytes."""
    factor = [pow(int(BASE), n, 1 << 64) for n in (1, 2, 4, 8)]
    values = BYTE_VALUES[body]
    for length, power in zip((1, 2, 4), factor, strict=False):
        values = values[:-length] * np.uint64(power) + values[length:]
    eight, power = values, np.uint64(factor[3])
    values = eight[:-16] * power + eight[8:-8]
    values *= power
    values += eight[16:]
    return unsigned_mix(values)


#: Bytes hashed at a time, few enough for the arrays to stay in a core's cache.
CACHED_BYTES = 1 << 17


def window_values(body: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every string of LENGTH bytes within a text: its place, its text, the least hash of its grams.

    Equal strings have equal values, wherever they stand; neighbours mostly share theirs.
    """
    sizes = np.maximum(np.diff(bounds) - (LENGTH - 1), 0)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(upto[-1]) + (bounds[:-1] - upto[:-1])[doc]
    value = np.zeros(len(place), np.uint64)
    for start in range(0, len(body), CACHED_BYTES):
        a, b = np.searchsorted(place, [start, start + CACHED_BYTES])
        if b > a:
            value[a:b] = least_grams(body[start : start + CACHED_BYTES + LENGTH - 1])[place[a:b] - start]
    return place, doc, value


def least_grams(body: np.ndarray) -> np.ndarray:
    """The least hash of the GRAMS grams from each place on."""
    least, width = gram_hashes(body), 1
    while width * 2 <= GRAMS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = GRAMS - width
    return np.minimum(least[:-rest], least[rest:]) if rest else least


INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def window_hashes(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of the LENGTH bytes from each place on, from sums of powers."""
    up, down = np.full(len(text), BASE), np.full(len(text), INVERSE)
    up[:1] = down[:1] = 1
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[text] * np.cumprod(up), out=sums[1:])
    return unsigned_mix((sums[places + LENGTH] - sums[places]) * np.cumprod(down)[places])


def runs(place: np.ndarray, doc: np.ndarray, value: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of neighbouring windows with one value."""
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)
    for column in more:
        new |= column[1:] != column[:-1]
    first = np.flatnonzero(np.concatenate([[True], new]))
    return first, np.append(first[1:], len(place)) - 1


def text_values(buckets: int):
    """Packed rows of the values of each document's windows."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in numbered_blocks(batches, "text"):
            place, doc, value = window_values(*byte_column(block.column(1)))
            first, _ = runs(place, doc, value)
            doc, value = doc[first], value[first]
            # each value of a document once
            limits = np.searchsorted(doc, np.arange(block.num_rows + 1))
            for a, b in zip(limits[:-1], limits[1:], strict=True):
                value[a:b].sort()
            fresh = np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])])[: len(value)]
            if len(value):
                yield entry_rows(row, value[fresh], doc[fresh], buckets, exact=False)

    return compute


TEXT_SCHEMA = "block long, body binary"


def packed_arrays(**columns: np.ndarray) -> bytes:
    """Arrays of one length, or bytes, in a compressed stream."""
    batch = pa.record_batch([pa.array(c) for c in columns.values()], names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked_arrays(body: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(body) as stream:
        return stream.read_next_batch()


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of each block, compressed as one."""
    for row, block in numbered_blocks(batches, "text"):
        body = packed_arrays(doc_id=block.column(0), text=block.column(1))
        yield pa.record_batch([pa.array([row], pa.int64()), pa.array([body], pa.binary())], names=["block", "body"])


def texts_of(rows: pa.Table) -> tuple[int, np.ndarray, np.ndarray, pa.Array]:
    texts = unpacked_arrays(rows["body"][0].as_py())
    body, bounds = byte_column(texts.column(1))
    return rows["block"][0].as_py(), body, bounds, texts.column(0)


SEGMENT_SCHEMA = "bucket int, block long, body binary"
#: A missing id is greater than all others, so that its document is the source of no removal.
NO_ID = np.iinfo(np.int64).max


def told_apart(contents: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each distinct content, and the least id of each."""
    numbers: dict[bytes, int] = {}
    group = np.fromiter((numbers.setdefault(c, len(numbers)) for c in contents), np.int64, len(contents))
    least = np.full(len(numbers), NO_ID)
    np.minimum.at(least, group, ids)
    return group, least


def removal_rows(block: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[int, bytes]]:
    """Removed runs, packed by block."""
    if not len(block):
        return []
    order = np.lexsort((start, doc, block))
    block, doc, start, end = block[order], doc[order], start[order], end[order]
    first = np.flatnonzero(np.diff(block, prepend=-1))
    out = []
    for a, b in zip(first, np.append(first[1:], len(block)), strict=True):
        columns = {"doc": doc[a:b].astype(np.int32), "start": start[a:b].astype(np.int32), "end": end[a:b].astype(np.int32)}
        out.append((int(block[a]), packed_arrays(**columns)))
    return out


def removal_bucket(block: int, buckets: int) -> int:
    """A group above the buckets, of which there are as many, for removals that need no comparison."""
    return buckets + int(unsigned_mix(np.array([block], np.uint64))[0] % np.uint64(buckets))


def segments(buckets: int):
    """Windows whose value several documents have, as segments of text dealt to buckets by that value.

    Of equal segments in a block only those of the least doc_id go on; the others are repeats of it
    already. A value of very many documents would fill one bucket with different texts around it:
    its windows go one by one, each to the bucket of its own hash.
    """

    def compute(packed: pa.Table, texts: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, bytes]] = []
        if packed.num_rows:
            block, body, bounds, doc_ids = texts_of(texts)
            ids = doc_ids.fill_null(int(NO_ID)).to_numpy()
            of_doc, wanted, counts = unpacked(packed)
            place, doc, value = window_values(body, bounds)
            first, last = runs(place, doc, value)
            named = (value[first] % np.uint64(buckets)) << np.uint64(LOW_BITS)
            named |= (value[first] & np.uint64((1 << LOW_BITS) - 1)) >> np.uint64(16) << np.uint64(16)
            known = unsigned_mix(wanted ^ unsigned_mix(of_doc.astype(np.uint64)))
            own = unsigned_mix(named ^ unsigned_mix(doc[first].astype(np.uint64)))
            order = np.argsort(known)
            at = np.minimum(np.searchsorted(known[order], own), len(known) - 1)
            shared_run = known[order][at] == own
            if not np.isin(known, own[shared_run]).all():
                raise RuntimeError("the input gives its rows in another order each time; write it to a table first")
            hot = shared_run & (counts[order][at] > HOT_DOCUMENTS)
            plain = np.flatnonzero(shared_run & ~hot)
            # long runs of one value are cut, each cut with the whole of its windows
            parts = -(-(last[plain] - first[plain] + 1) // SEGMENT_WINDOWS)
            run = np.repeat(plain, parts)
            within = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
            begin = first[run] + within * SEGMENT_WINDOWS
            windows = np.minimum(last[run] - begin + 1, SEGMENT_WINDOWS)
            bucket = (value[begin] % np.uint64(buckets)).astype(np.int64)
            if hot.any():
                single = np.concatenate([np.arange(first[i], last[i] + 1) for i in np.flatnonzero(hot)])
                mixed = window_hashes(body, place[single])
                begin = np.concatenate([begin, single])
                windows = np.concatenate([windows, np.ones(len(single), np.int64)])
                bucket = np.concatenate([bucket, (mixed % np.uint64(buckets)).astype(np.int64)])
            start, doc = place[begin], doc[begin]
            end = start + windows + LENGTH - 1
            whole = body.tobytes()
            contents = [whole[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            group, least = told_apart(contents, ids[doc])
            repeated = ids[doc] > least[group]
            within_doc = start - bounds[doc]
            removed = removal_rows(
                np.full(int(repeated.sum()), block), doc[repeated], within_doc[repeated], (end - bounds[doc])[repeated]
            )
            rows += [(removal_bucket(block, buckets), b, r) for b, r in removed]
            order = np.flatnonzero(~repeated)
            order = order[np.argsort(bucket[order], kind="stable")]
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(order)], strict=False):
                part = order[a:b]
                columns = {
                    "doc": doc[part].astype(np.int32), "doc_id": ids[doc[part]], "start": within_doc[part].astype(np.int32),
                    "content": pa.array([contents[i] for i in part], pa.binary()),
                }
                rows.append((int(bucket[part[0]]), block, packed_arrays(**columns)))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = [pa.int32(), pa.int64(), pa.binary()]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "block", "body"])

    return compute


def met_by_others(contents: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (segment, offset) whose hash other segments with other ids have too: only these need comparing."""
    text = np.frombuffer(b"".join(contents), np.uint8)
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    counts = sizes - (LENGTH - 1)
    segment = np.repeat(np.arange(len(contents)), counts)
    offset = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    hashes = window_hashes(text, (np.cumsum(sizes) - sizes)[segment] + offset)
    order = np.argsort(hashes)
    ordered, of_window = hashes[order], ids[segment[order]]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    differs = np.minimum.reduceat(of_window, first) < np.maximum.reduceat(of_window, first)
    met = np.zeros(len(segment), bool)
    met[order] = np.repeat(differs, np.diff(np.append(first, len(order))))
    return segment[met], offset[met]


def repeated_windows(pieces: list[bytes], ids: np.ndarray, shard_bytes: int) -> np.ndarray:
    """Which windows of the pieces, piece after piece, equal a window of a piece with a smaller id."""
    if not pieces:
        return np.zeros(0, np.int64)
    upto = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    shard_of = (upto - 1) // shard_bytes
    limits = np.searchsorted(shard_of, np.arange(int(shard_of[-1]) + 2))
    parts = [(a, b) for a, b in zip(limits[:-1], limits[1:], strict=True) if b > a]
    shards = [pieces[a:b] for a, b in parts]
    found = [window_groups(shard, ids[a:b]) for shard, (a, b) in zip(shards, parts, strict=True)]
    least = [f[2] for f in found]
    merged_least(shards, [f[1] for f in found], least)
    known = np.concatenate([low[f[0]] for low, f in zip(least, found, strict=True)])
    counts = [len(p) - (LENGTH - 1) for p in pieces]
    return np.flatnonzero(known < np.repeat(ids, counts))


def window_groups(contents: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix-array groups of the equal windows of one shard of segments.

    Returns for all windows (segment after segment) the number of their group, and for each group its
    place in the text and its least id. Groups are in the order of their bytes.
    """
    text = np.frombuffer(b"".join(contents), np.uint8)
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    starts = np.cumsum(sizes) - sizes
    counts = sizes - (LENGTH - 1)
    order = suffix_array(text, np.repeat(starts + sizes, sizes))
    new = common_prefixes(text, order, starts, sizes, LENGTH) < LENGTH
    is_window = np.arange(len(text)) - np.repeat(starts, sizes) < np.repeat(counts, sizes)
    chosen = is_window[order]
    ordered, number = order[chosen], np.cumsum(new)[chosen]
    first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    number = np.cumsum(np.concatenate([[0], (number[1:] != number[:-1]).astype(np.int64)]))
    least = np.minimum.reduceat(np.repeat(ids, sizes)[ordered], first)
    group = np.empty(len(text), np.int64)
    group[ordered] = number
    return group[is_window], ordered[first], least


def merged_least(shards: list[list[bytes]], places: list[np.ndarray], least: list[np.ndarray]) -> None:
    """The least id of every group over all shards: each shard's strings are searched in those after it.

    The first shard that holds a string has met all others by the time it meets the last that does; so both
    know the least id then, and those between learn it from the last.
    """
    keys = [
        keys_of(np.frombuffer(b"".join(contents), np.uint8), place, LENGTH) for contents, place in zip(shards, places, strict=True)
    ]
    for i in range(len(shards)):
        for j in range(i + 1, len(shards)):
            found = binary_search(keys[j], keys[i])
            mine = np.flatnonzero(found >= 0)
            theirs = found[mine]
            both = np.minimum(least[i][mine], least[j][theirs])
            least[i][mine], least[j][theirs] = both, both


REMOVED_SCHEMA = "block long, body binary"


def compare(buckets: int, shard_bytes: int):
    """Windows of a bucket that also start in a document with a smaller id, as runs of bytes by block."""

    def compute(rows: pa.Table) -> pa.Table:
        if rows["bucket"][0].as_py() >= buckets:
            return rows.select(["block", "body"])
        batches = [unpacked_arrays(b.as_py()) for b in rows["body"]]
        block = np.repeat(rows["block"].to_numpy(), [b.num_rows for b in batches])
        doc, ids, start = (np.concatenate([b[name].to_numpy() for b in batches]).astype(np.int64) for name in ("doc", "doc_id", "start"))
        contents = [c for b in batches for c in b["content"].to_pylist()]
        sizes = np.fromiter(map(len, contents), np.int64, len(contents))
        group, least_of = told_apart(contents, ids)
        repeated = ids > least_of[group]
        out = [(block[repeated], doc[repeated], start[repeated], (start + sizes)[repeated])]
        # one copy of each content stands for all, under its least id
        _, firsts = np.unique(group, return_index=True)
        segment, offset = met_by_others([contents[i] for i in firsts], least_of)
        a, b = runs(offset, segment, segment)
        pieces = [contents[firsts[i]][x : y + LENGTH] for i, x, y in zip(segment[a], offset[a], offset[b], strict=True)]
        flagged = repeated_windows(pieces, least_of[segment[a]], shard_bytes)
        segment, offset = segment[flagged], offset[flagged]
        a, b = runs(offset, segment, segment)
        run_segment, run_from, run_to = segment[a], offset[a], offset[b] + LENGTH
        # to all places of the content that were not repeats themselves
        kept = np.flatnonzero(~repeated)
        kept = kept[np.argsort(group[kept], kind="stable")]
        low, high = np.searchsorted(group[kept], run_segment), np.searchsorted(group[kept], run_segment, side="right")
        times = high - low
        which = np.repeat(np.arange(len(run_segment)), times)
        copy = kept[np.repeat(low, times) + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)]
        out.append((block[copy], doc[copy], start[copy] + run_from[which], start[copy] + run_to[which]))
        removed = removal_rows(*(np.concatenate(c) for c in zip(*out, strict=True)))
        return pa.table(
            [pa.array([b for b, _ in removed], pa.int64()), pa.array([r for _, r in removed], pa.binary())], names=["block", "body"]
        )

    return compute


RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def kept_of(removed: pa.Table, texts: pa.Table) -> pa.Table:
    """What is left of each document of a block."""
    block, body, bounds, doc_ids = texts_of(texts)
    depth = np.zeros(len(body) + 1, np.int32)
    for row in removed["body"] if removed.num_rows else []:
        part = unpacked_arrays(row.as_py())
        base = bounds[part["doc"].to_numpy()]
        np.add.at(depth, base + part["start"].to_numpy(), 1)
        np.add.at(depth, base + part["end"].to_numpy(), -1)
    gone = np.cumsum(depth)[:-1] > 0
    rising = gone.copy()
    rising[1:] &= ~gone[:-1]
    inner = bounds[:-1][np.diff(bounds) > 0]
    rising[inner] = gone[inner]
    n_gone, n_rising = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(rising)])
    digests = [
        hashlib.sha256(body[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]
    return pa.table(
        [doc_ids, pa.array(np.diff(bounds)), pa.array(np.diff(n_gone[bounds])), pa.array(np.diff(n_rising[bounds])), pa.array(digests)],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    )


def remove_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every whole text without the bytes of 50-byte strings that also start in a document with a smaller doc_id.

    1. Every window of 50 bytes has a value, the least hash of its 24-byte grams. Values of one document
       alone are dropped, exactly: a repeated window has a value of several documents.
    2. The other windows go as segments of text to the bucket of their value, where equal windows meet.
       Equal segments are one, under the least id, so copies by the thousand are one text.
    3. Windows of a bucket whose hash different segments have make shards of ``shard_bytes`` with a suffix
       array each (Larsson and Sadakane's refinement); common prefixes by Kasai's walk give groups of
       equal windows with their least ids; shards are merged by binary search of one's groups in another's.
    4. The runs found go back to the texts' blocks, where what is left is put together.

    Texts are UTF-8 bytes. Nothing is gathered beyond one bucket or one block of texts, and all moves
    between tasks are compressed. A null text is empty; a null doc_id counts as greater than all
    others; rows of one doc_id are no repeats of each other; an empty table gives no rows.
    Further columns are not read. The rows are numbered in two passes, so ``docs`` must give them in one
    order, as a table of files does; a changed order is noticed and raises an error.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of the rest.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    buckets = buckets_for(docs)
    values = written(shared(read.mapInArrow(text_values(buckets), ENTRY_SCHEMA)), "shared-values")
    texts = read.mapInArrow(text_blocks, TEXT_SCHEMA)
    cut = values.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(segments(buckets), SEGMENT_SCHEMA)
    removed = written(cut.groupBy("bucket").applyInArrow(compare(buckets, shard_bytes), REMOVED_SCHEMA), "removed")
    return removed.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(kept_of, RESULT_SCHEMA)
