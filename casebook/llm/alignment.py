"""Alignment of two tokenizers over a corpus, with links counted in inverted pair bitmaps."""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import ROW_BITS, blocks_of, whole_text
from casebook.llm.ragged import Numbers, Ragged, ragged
from casebook.session import written

#: Bytes of text aligned at a time, and distinct chunks a task remembers before it starts anew.
BLOCK_BYTES = 2 << 20
KEPT_CHUNKS = 300_000
#: Chunks handed to the tokenizers at a time.
CALL_CHUNKS = 20_000
#: So few are encoded one by one.
FEW_CHUNKS = 32
#: A container of bitmaps ends at this many documents, which 16 bits can number, or postings.
CONTAINER_DOCUMENTS = 1 << 16
CONTAINER_POSTINGS = 3_000_000
#: Bits of a B id in a pair's number.
B_BITS = 24
PAIR_MASK = (1 << B_BITS) - 1
#: First byte of a bitmap: positions of 16 bits, or a bit for each document.
SPARSE, DENSE = 0, 1

#: White space as either tokenizer may see it, and characters that some take for it.
BLANK_END = re.compile(r"[\s\u180e\u200b-\u200f\u2060\ufeff]\Z")


class ByteTokens:
    """A: byte-level BPE of a tokenizers file, special strings taken as plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        # the alphabet of byte-level BPE: printable bytes stand for themselves, the others for signs from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        signs = {chr(b): b for b in printable}
        signs |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
        names = sorted(self.library.get_vocab().items(), key=lambda item: item[1])
        lists = [b""] * (names[-1][1] + 1)
        for name, number in names:
            lists[number] = bytes(signs[c] for c in name) if all(c in signs for c in name) else name.encode()
        self.bytes = ragged(lists, np.uint8)

    def whole(self, chunks: list[str]) -> np.ndarray:
        """Ids of chunks that stand in a row."""
        return np.array(self.library.encode("".join([" " + c for c in chunks]), add_special_tokens=False).ids, np.int64)

    def each(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch([" " + c for c in chunks], add_special_tokens=False)]


class PieceTokens:
    """B: a sentencepiece model, which puts a blank before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        coded = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace("▁", " ").encode() for n in names]
        self.bytes = ragged(coded, np.uint8)
        #: no piece has a blank behind another character, so texts can be cut before such blanks
        self.cuttable = not any("▁" in n.lstrip("▁") for n in names)
        self.blank = self.library.encode("a ")[len(self.library.encode("a")) :]

    def whole(self, chunks: list[str]) -> np.ndarray:
        return np.array(self.library.encode(" ".join(chunks), num_threads=1), np.int64)

    def each(self, chunks: list[str]) -> list[list[int]]:
        return [ids if c else self.blank for c, ids in zip(chunks, self.library.encode(chunks, num_threads=1), strict=True)]


@functools.cache
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


@functools.cache
def piece_tokens(path: str) -> PieceTokens:
    return PieceTokens(path)


def chunks_of(text: str) -> list[str]:
    """A blank and the text, cut before each blank that follows no white space; the chunks lack their first blank.

    At such a place both tokenizers end a token, whatever stands around it.
    """
    if not text:
        return []
    parts = text.split(" ")
    if parts[0] and "" not in parts and not any(map(BLANK_END.search, parts[:-1])):
        return parts
    chunks = [parts[0]]
    for part in parts[1:]:
        if not chunks[-1] or BLANK_END.search(chunks[-1]):
            chunks[-1] += " " + part
        else:
            chunks.append(part)
    return chunks


def ends_of(ids: np.ndarray, tokens: Ragged) -> np.ndarray:
    return np.cumsum(tokens.bounds[ids + 1] - tokens.bounds[ids])


class Alignments:
    """What the chunks met so far come to, each aligned once."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = byte_tokens(a_path), piece_tokens(b_path)
        self.signs = []
        for held, marks in ((self.a, ",|"), (self.b, ",;")):
            numbers = [str(i) for i in range(held.bytes.count)]
            self.signs.append([np.array([n + m for n in numbers], object) for m in marks])
        self.reset()

    def reset(self) -> None:
        self.numbers, self.links, self.texts = Numbers(), Ragged(np.int64), []
        #: tokens of A and B, groups, and whether both give the chunk's bytes
        self.sizes = np.zeros((0, 4), np.int64)

    def learn(self) -> None:
        """Align the chunks that were numbered since the last time."""
        fresh = self.numbers.taken()
        for i in range(0, len(fresh), CALL_CHUNKS):
            part = fresh[i : i + CALL_CHUNKS]
            # in a row, a blank at the end of a chunk would meet the next one's
            apart = np.array([not c or BLANK_END.search(c) is not None for c in part])
            rows, single = np.flatnonzero(~apart), np.flatnonzero(apart)
            sides, right = (Ragged(np.int64), Ragged(np.int64)), []
            right += self.in_a_row([part[k] for k in rows], sides)
            right += self.one_by_one([part[k] for k in single], sides)
            order = np.argsort(np.concatenate([rows, single]))
            right = np.array(right)[order]
            sizes = np.array([len(c.encode()) + 1 for c in part])
            self.add(*(side.gathered(order)[0] for side in sides), np.cumsum(sizes * right), right)

    def in_a_row(self, chunks: list[str], sides: tuple[Ragged, Ragged]) -> list[bool]:
        """Append the ids of chunks encoded as one text, and tell whether they give the chunks' bytes.

        Where the bytes of all differ from the text, the halves are tried, and few chunks one by one.
        """
        if len(chunks) <= FEW_CHUNKS:
            return self.one_by_one(chunks, sides)
        encoded = [" " + c for c in chunks]
        body = np.frombuffer("".join(encoded).encode(), np.uint8)
        ids = [held.whole(chunks) for held in (self.a, self.b)]
        if not all(np.array_equal(held.bytes.gathered(own)[0], body) for held, own in zip((self.a, self.b), ids, strict=True)):
            half = len(chunks) // 2
            return self.in_a_row(chunks[:half], sides) + self.in_a_row(chunks[half:], sides)
        ends = np.cumsum([len(c.encode()) for c in encoded])
        for held, own, side in zip((self.a, self.b), ids, sides, strict=True):
            side.append(own, np.diff(np.searchsorted(ends_of(own, held.bytes), ends, side="right"), prepend=0))
        return [True] * len(chunks)

    def one_by_one(self, chunks: list[str], sides: tuple[Ragged, Ragged]) -> list[bool]:
        """As ``in_a_row``, each chunk for itself; one with other bytes has no ids."""
        right = []
        for own_a, own_b, chunk in zip(self.a.each(chunks), self.b.each(chunks), chunks, strict=True):
            body = b" " + chunk.encode()
            lists = [np.array(ids, np.int64) for ids in (own_a, own_b)]
            right.append(all(h.bytes.gathered(ids)[0].tobytes() == body for h, ids in zip((self.a, self.b), lists, strict=True)))
            for side, ids in zip(sides, lists, strict=True):
                ids = ids if right[-1] else ids[:0]
                side.append(ids, np.array([len(ids)]))
        return right

    def add(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray, right: np.ndarray) -> None:
        """Groups and links of chunks that end at ``ends`` in a row of bytes; those not ``right`` are empty there."""
        a_ends, b_ends = ends_of(a, self.a.bytes), ends_of(b, self.b.bytes)
        # where tokens of both end, a group ends; between any two ends lies one link
        links = np.union1d(a_ends, b_ends)
        groups = np.intersect1d(a_ends, b_ends, assume_unique=True)
        pairs = (a[np.searchsorted(a_ends, links)] << B_BITS) | b[np.searchsorted(b_ends, links)]
        upto = [np.concatenate([[0], np.searchsorted(side, ends, side="right")]) for side in (a_ends, b_ends, groups, links)]
        self.links.append(pairs, np.diff(upto[3]))
        sizes = np.stack([*(np.diff(u) for u in upto[:3]), right.astype(np.int64)], axis=1)
        self.sizes = np.concatenate([self.sizes, sizes])
        # tokens of a group in a row: those of A, then those of B, each with the sign behind it
        a_group, b_group = np.searchsorted(groups, a_ends), np.searchsorted(groups, b_ends)
        a_last, b_last = np.diff(a_group, append=len(groups)) > 0, np.diff(b_group, append=len(groups)) > 0
        signs = np.empty(len(a) + len(b), object)
        a_at = np.arange(len(a)) + np.searchsorted(b_group, a_group)
        b_at = np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")
        for side, ids, at, last in zip(self.signs, (a, b), (a_at, b_at), (a_last, b_last), strict=True):
            signs[at[~last]], signs[at[last]] = side[0][ids[~last]], side[1][ids[last]]
        bounds = (upto[0] + upto[1]).tolist()
        parts = signs.tolist()
        self.texts += ["".join(parts[s:e]) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Sizes of all texts, hashes of their groups, and their links in a row with their bounds."""
        if len(self.numbers) > KEPT_CHUNKS:
            self.reset()
        cut = [chunks_of(t) if self.b.cuttable else [t] if t else [] for t in texts]
        lengths = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(cut)), np.int64, int(lengths.sum()))
        self.learn()
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        upto = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.sizes[at], axis=0)])
        sizes = upto[bounds[1:]] - upto[bounds[:-1]]
        right = (sizes[:, 3] == lengths) & (lengths > 0)
        at = at[np.repeat(right, lengths)]
        bounds = np.concatenate([[0], np.cumsum(lengths * right)])
        named = list(map(self.texts.__getitem__, at.tolist()))
        hashes = [
            hashlib.sha256("".join(named[s:e])[:-1].encode()).hexdigest() if e > s else ""
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]
        links, ends = self.links.gathered(at)
        return sizes[:, :3] * right[:, None], hashes, links, ends[bounds]


def bitmaps(planes: list[tuple[np.ndarray, np.ndarray]], documents: int) -> tuple[np.ndarray, pa.Array]:
    """Pairs in order, and their bitmaps: of the documents that hold the pair, then by bit of its further copies.

    ``planes`` are pairs and documents of each bitmap, sorted; the first has all pairs.
    """
    pairs = np.unique(planes[0][0])
    depth = np.zeros(len(pairs), np.int64)
    parts = []
    for number, (names, places) in enumerate(planes):
        first = np.flatnonzero(np.diff(names, prepend=-1))
        counts = np.diff(np.append(first, len(names)))
        parts.append((np.searchsorted(pairs, names[first]), counts, places))
        depth[parts[-1][0]] = number + 1
    starts = np.concatenate([[0], np.cumsum(depth)])
    size = (documents + 7) // 8
    # a plane between two others may be empty: it is a sparse one of no documents
    lengths = np.ones(starts[-1], np.int64)
    for number, (where, counts, _) in enumerate(parts):
        lengths[starts[where] + number] = 1 + np.minimum(2 * counts, size)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    data = np.zeros(ends[-1], np.uint8)
    for number, (where, counts, places) in enumerate(parts):
        slots = ends[starts[where] + number]
        sparse = 2 * counts <= size
        kept = np.repeat(sparse, counts)
        own, few = places[kept].astype("<u2"), counts[sparse]
        at = np.repeat(slots[sparse] + 1 - 2 * (np.cumsum(few) - few), 2 * few) + np.arange(2 * len(own))
        data[at] = own.view(np.uint8)
        data[slots[~sparse]] = DENSE
        upto = np.cumsum(counts)
        for i in np.flatnonzero(~sparse):
            marked = np.zeros(documents, bool)
            marked[places[upto[i] - counts[i] : upto[i]]] = True
            data[slots[i] + 1 : slots[i] + 1 + size] = np.packbits(marked)
    flat = pa.Array.from_buffers(pa.binary(), int(starts[-1]), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
    return pairs, pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), flat)


class Container:
    """Postings of consecutive documents, OR-merged by pair until the container is full."""

    def __init__(self, number: int):
        self.number, self.documents, self.held, self.postings = number, 0, [], 0

    def take(self, links: np.ndarray, bounds: np.ndarray) -> None:
        counts = np.diff(bounds)
        places = np.repeat(np.arange(self.documents, self.documents + len(counts)), counts)
        keys, copies = np.unique((links << 16) | places, return_counts=True)
        self.documents += len(counts)
        self.held.append((keys, copies))
        self.postings += len(keys)

    def full(self, more: int) -> bool:
        return self.documents + more > CONTAINER_DOCUMENTS or self.postings >= CONTAINER_POSTINGS

    def closed(self) -> tuple[np.ndarray, pa.Array]:
        """Every pair of the container, and its bitmaps."""
        keys = np.concatenate([k for k, _ in self.held])
        copies = np.concatenate([c for _, c in self.held])
        order = np.argsort(keys, kind="stable")
        keys, further = keys[order], copies[order] - 1
        planes = [(keys >> 16, keys & 0xFFFF)]
        while further.any():
            set_ = (further & 1).astype(bool)
            planes.append((keys[set_] >> 16, keys[set_] & 0xFFFF))
            keys, further = keys[further > 1], further[further > 1] >> 1
        return bitmaps(planes, self.documents)


DOCUMENT = "container long, place int, doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
POSTING = "pair long, planes array<binary>"


def aligner(a_path: str, b_path: str):
    """Rows of documents, and rows of the pairs of every container."""

    def rows(columns: dict[str, pa.Array], names: list[str], types: dict[str, pa.DataType]) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.record_batch([columns[n] if n in columns else pa.nulls(size, types[n]) for n in names], names=names)

    def align_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Alignments(a_path, b_path)
        types = {
            "container": pa.int64(), "place": pa.int32(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
            "n_links": pa.int64(), "groups_sha256": pa.string(), "pair": pa.int64(), "planes": pa.list_(pa.binary()),
        }
        names = ["container", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "planes"]
        container = Container(TaskContext.get().partitionId() << ROW_BITS)

        def close() -> Iterator[pa.RecordBatch]:
            if container.postings:
                pairs, planes = container.closed()
                where = pa.array(np.full(len(pairs), container.number))
                yield rows({"container": where, "pair": pa.array(pairs), "planes": planes}, names, types)

        for batch in batches:
            types["doc_id"] = batch.column(0).type
            for block in blocks_of(batch, "text", BLOCK_BYTES):
                for start in range(0, block.num_rows, CONTAINER_DOCUMENTS):
                    part = block.slice(start, CONTAINER_DOCUMENTS)
                    if container.full(part.num_rows):
                        yield from close()
                        container = Container(container.number + 1)
                    sizes, hashes, links, bounds = known.documents(part.column(1).to_pylist())
                    first = container.documents
                    container.take(links, bounds)
                    yield rows(
                        {
                            "container": pa.array(np.full(part.num_rows, container.number)),
                            "place": pa.array(np.arange(first, container.documents, dtype=np.int32)), "doc_id": part.column(0),
                            "n_a": pa.array(sizes[:, 0]), "n_b": pa.array(sizes[:, 1]), "n_groups": pa.array(sizes[:, 2]),
                            "n_links": pa.array(np.diff(bounds)), "groups_sha256": pa.array(hashes, pa.string()),
                        },
                        names, types,
                    )
        yield from close()

    return align_batches


def popcount(plane: Column) -> Column:
    """Set bits of a bitmap, sparse or dense."""
    dense = F.substring(plane, 1, 1) == F.lit(bytes([DENSE]))
    return F.when(dense, F.bitmap_count(F.substring(plane, 2, 1 << 30))).otherwise((F.octet_length(plane) - 1) / 2).cast("long")


def pair_counts(postings: DataFrame) -> DataFrame:
    """pair, n_docs, n_links of the whole corpus, by popcounts of its bitmaps.

    Containers hold different documents, so that a pair's counts are the sums of theirs, taken in the
    tasks before the shuffle.
    """
    counted = postings.select("pair", F.transform("planes", popcount).alias("bits"))
    # the first bitmap counts one copy, those behind it the bits of the further copies
    copies = F.transform("bits", lambda n, k: n * F.when(k == 0, 1).otherwise(F.pow(F.lit(2.0), k - 1)).cast("long"))
    links = F.aggregate(copies, F.lit(0).cast("long"), lambda total, n: total + n)
    summed = counted.groupBy("pair").agg(F.sum(F.col("bits")[0]).alias("n_docs"), F.sum(links).alias("n_links"))
    return summed


def with_best(counts: DataFrame) -> DataFrame:
    """``counts`` with whether no other pair of the same B id has more links."""
    named = counts.withColumn("b", F.col("pair").bitwiseAND(PAIR_MASK))
    # as many rows as the vocabulary of B has ids, which its number of bits bounds
    most = F.broadcast(named.groupBy("b").agg(F.max("n_links").alias("most")))
    return named.join(most, "b").select("pair", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def scorer(table: pa.Table) -> pa.Table:
    """place, n_best, count_sum: what the postings of a container give back to its documents."""
    table = table.combine_chunks()
    planes = table.column("planes").combine_chunks()
    row_bounds = planes.offsets.to_numpy()
    flat = planes.values
    pieces = np.diff(row_bounds)
    row = np.repeat(np.arange(len(pieces)), pieces)
    level = np.arange(row_bounds[0], row_bounds[-1]) - np.repeat(row_bounds[:-1], pieces)
    _, offsets, data = flat.buffers()
    bounds = np.frombuffer(offsets, np.int32)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64)
    bounds = bounds[row_bounds[0] : row_bounds[-1] + 1]
    body = np.frombuffer(data, np.uint8)
    starts, lengths = bounds[:-1] + 1, np.diff(bounds) - 1
    copies = np.where(level == 0, 1, 1 << np.maximum(level - 1, 0))
    links = table.column("n_links").to_numpy()
    best = table.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
    totals = np.zeros((2, CONTAINER_DOCUMENTS), np.int64)
    dense = body[starts - 1] == DENSE
    few = lengths[~dense]
    at = np.repeat(starts[~dense] - (np.cumsum(few) - few), few) + np.arange(few.sum())
    places, owner = body[at].view("<u2"), np.repeat(np.flatnonzero(~dense), few // 2)
    np.add.at(totals[0], places, best[row[owner]] * copies[owner])
    np.add.at(totals[1], places, links[row[owner]] * copies[owner])
    for i in np.flatnonzero(dense):
        places = np.flatnonzero(np.unpackbits(body[starts[i] : starts[i] + lengths[i]]))
        totals[0, places] += best[row[i]] * copies[i]
        totals[1, places] += links[row[i]] * copies[i]
    found = np.flatnonzero(totals[1])
    container = np.full(len(found), table.column("container")[0].as_py())
    return pa.table({"container": container, "place": found.astype(np.int32), "n_best": totals[0, found], "count_sum": totals[1, found]})


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Align the tokens of two tokenizers over every whole text, and score the links by the corpus's counts.

    A (a tokenizers file) encodes a blank and the text, B (a sentencepiece model) the text, which it puts
    a blank before, both without special tokens. Where tokens of both end, a group ends; two tokens whose
    bytes overlap are linked. Texts are cut where both tokenizers end tokens for certain, and every
    distinct chunk is aligned once in a task.

    For every pair of linked ids there are bitmaps by container of consecutive documents: one of the
    documents that hold it, and one for each bit of the number of further copies in them. Blocks of
    documents are OR-merged into a container as they come. Popcounts, summed over
    containers, give the documents and links of a pair. The bitmaps then meet their pair's counts by
    a join, in which a frequent pair is one row for each container, and come together by container,
    whose postings are bounded, to give the scores back to the documents.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their B
    id), count_sum (of the links' counts) and groups_sha256 (of "a1,a2|b1;a3|b2"), one row for
    each row of ``docs``, repeated rows and null ids included. Texts that are null, empty, or other bytes
    in A or B than a blank and the text have zeros and "", and no links. An empty table gives no rows;
    further columns are not read. Both paths must be readable on every executor.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"{DOCUMENT.format(doc_type)}, {POSTING}"
    texts = docs.select("doc_id", whole_text().alias("text"))
    rows = written(texts.mapInArrow(aligner(a_path, b_path), schema), "aligned")
    documents = rows.filter("place is not null").drop("pair", "planes")
    postings = rows.filter("pair is not null").select("container", "pair", "planes")
    scored = postings.join(with_best(pair_counts(postings)), "pair")
    containers = max(1, documents.select("container").distinct().count())
    scores = (
        scored.repartition(containers, "container")
        .groupBy("container")
        .applyInArrow(scorer, "container long, place int, n_best long, count_sum long")
    )
    scores = written(scores, "scores")
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return documents.join(scores, ["container", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
