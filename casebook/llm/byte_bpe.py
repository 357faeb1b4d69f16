"""Byte-level BPE by the ranks of a vocabulary file: encoding in padded matrices, and decoding."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import blocks_of, whole_text
from casebook.llm.ragged import Numbers, Ragged, ragged

#: Bytes of text encoded at a time, and distinct pieces a task remembers before it starts anew.
BLOCK_BYTES = 2 << 20
KEPT_PIECES = 500_000
#: Ids decoded at a time.
DECODED_IDS = 1 << 20
#: Upper bounds of the lengths that share a matrix. Longer pieces are merged by themselves.
WIDTHS = (3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 128, 256)
#: Rows of one matrix.
MATRIX_ROWS = 1 << 15
#: The rank of a pair that makes no token.
NEVER = np.int32(2**31 - 1)
#: Odd multiplier of the pair hash.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank of the token that two neighbouring tokens make: a hash table with linear probing, in arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(len(ranks) * 2).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NEVER, np.int32)
        keys = self.key(left, right)
        slots = self.slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self.keys[slots[placed]], self.ranks[slots[placed]] = keys[placed], ranks[placed]
            left_over = np.ones(len(keys), bool)
            left_over[placed] = False
            keys, ranks, slots = keys[left_over], ranks[left_over], (slots[left_over] + 1) & self.mask

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; padding (below 0) on either side makes no token."""
        keys = self.key(left, right)
        slots = self.slot(keys)
        found = self.ranks[slots]
        held = self.keys[slots]
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        found[held < 0] = NEVER
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            held = self.keys[slots[open_]]
            found[open_] = np.where(held == keys[open_], self.ranks[slots[open_]], NEVER)
            open_ = open_[(held != keys[open_]) & (held >= 0)]
        found[(left < 0) | (right < 0)] = NEVER
        return found


class Vocabulary:
    """The ranks of a file, the pairs that make its tokens, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        lists = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            lists[rank] = token
        self.tokens = ragged(lists, np.uint8)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (self.ranks[token[:cut]], self.ranks[token[cut:]], rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        ]
        left, right, made = np.array(pairs, np.int64).reshape(-1, 3).T
        self.pairs = PairTable(left, right, made.astype(np.int32))

    def merged_rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every row of a matrix of byte ids, padded with -1 behind: flat, and their number by row.

        A round merges the leftmost pair of least rank in every row, so each row that goes on is one
        shorter after it: the matrix loses a column, and the rows without such a pair.
        """
        lengths = (rows >= 0).sum(axis=1)
        result = np.full(rows.shape, -1, np.int32)
        active = np.arange(len(rows))
        ranks = self.pairs.look_up(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(len(rows), -1)
        while len(active) and ranks.shape[1]:
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(active)), at]
            done = least == NEVER
            if done.any():
                result[active[done], : rows.shape[1]] = rows[done]
                going = ~done
                active, rows, ranks, at, least = active[going], rows[going], ranks[going], at[going], least[going]
                if not len(active):
                    break
            lengths[active] -= 1
            every = np.arange(len(active))
            # without the right one of each merged pair, and without its rank
            kept = np.ones(rows.shape, bool)
            kept[every, at + 1] = False
            rows = rows[kept].reshape(len(active), -1)
            rows[every, at] = least
            kept = np.ones(ranks.shape, bool)
            kept[every, at] = False
            ranks = ranks[kept].reshape(len(active), -1)
            if ranks.shape[1]:
                before = np.flatnonzero(at > 0)
                where = at[before]
                ranks[before, where - 1] = self.pairs.look_up(rows[before, where - 1], rows[before, where])
                behind = np.flatnonzero(at < ranks.shape[1])
                where = at[behind]
                ranks[behind, where] = self.pairs.look_up(rows[behind, where], rows[behind, where + 1])
        result[active, : rows.shape[1]] = rows
        return result[result >= 0], lengths

    def merged_long(self, ids: np.ndarray) -> np.ndarray:
        """Ids of one long piece.

        A round merges all pairs of the least rank from left to right, of overlapping ones every
        other. That is what single merges come to as long as no merge makes a pair of that rank or a
        lower one; where it does, the round merges the leftmost pair alone.
        """
        look_up = self.pairs.look_up
        ranks = look_up(ids[:-1], ids[1:])
        while len(ranks):
            least = ranks.min()
            if least == NEVER:
                break
            hits = np.flatnonzero(ranks == least)
            begins = np.diff(hits, prepend=-2) != 1
            first = hits[begins][np.cumsum(begins) - 1]
            hits = hits[(hits - first) % 2 == 0]
            padded = np.append(ids, -1)
            behind_before = look_up(np.full(len(hits), least), padded[np.minimum(hits + 2, len(ids))])
            for chosen in (hits, hits[:1]):
                kept = np.ones(len(ids), bool)
                kept[chosen + 1] = False
                merged = ids.copy()
                merged[chosen] = least
                merged, places = merged[kept], chosen - np.arange(len(chosen))
                closed = np.concatenate([[-1], merged, [-1]])
                before, behind = look_up(closed[places], closed[places + 1]), look_up(closed[places + 1], closed[places + 2])
                if len(chosen) == 1 or min(before.min(), behind_before.min()) > least:
                    break
            ranks = ranks[kept[1:]]
            ranks[places[places > 0] - 1] = before[places > 0]
            ranks[places[places < len(ranks)]] = behind[places < len(ranks)]
            ids = merged
        return ids

    def encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and the number of each: a piece that is a token itself is that token."""
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts = np.where(whole >= 0, 1, 0)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.flatnonzero(whole >= 0), whole[whole >= 0].astype(np.int32), counts[whole >= 0])
        ]
        rest = np.flatnonzero((whole < 0) & (sizes > 0))
        bucket = np.searchsorted(WIDTHS, sizes[rest])
        for b, width in enumerate(WIDTHS):
            members = rest[bucket == b]
            for i in range(0, len(members), MATRIX_ROWS):
                part = members[i : i + MATRIX_ROWS]
                rows = np.full((len(part), width), -1, np.int32)
                inside = np.arange(width) < sizes[part][:, None]
                rows[inside] = self.single[np.frombuffer(b"".join(pieces[p] for p in part), np.uint8)]
                ids, lengths = self.merged_rows(rows[:, : sizes[part].max()])
                found.append((part, ids, lengths))
        for p in rest[bucket == len(WIDTHS)]:
            ids = self.merged_long(self.single[np.frombuffer(pieces[p], np.uint8)])
            found.append((np.array([p]), ids, np.array([len(ids)])))
        for part, _, lengths in found:
            counts[part] = lengths
        starts = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int32)
        for part, ids, lengths in found:
            flat[np.repeat(starts[part] - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(ids))] = ids
        return flat, counts


@functools.cache
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


class PieceIds:
    """Ids of texts; each distinct piece between the cuts of the pattern is merged once."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.cut = vocabulary, regex.compile(pattern).findall
        self.numbers, self.ids = Numbers(), Ragged(np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each begins and ends."""
        if len(self.numbers) > KEPT_PIECES:
            self.numbers, self.ids = Numbers(), Ragged(np.int32)
        cut = [self.cut(text) for text in texts]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        self.ids.append(*self.vocabulary.encoded([p.encode() for p in self.numbers.taken()]))
        ids, upto = self.ids.gathered(at)
        return ids, upto[np.concatenate([[0], np.cumsum(sizes)])]


def encoder(path: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceIds(vocabulary_of(path), pattern)
        for batch in batches:
            for block in blocks_of(batch, "text", BLOCK_BYTES):
                ids, bounds = pieces.encode(block.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.record_batch([block.column(0), lists], names=["doc_id", "ids"])

    return encode


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids of every whole text, by the ranks at ``path``, each match of ``pattern`` for itself.

    The pieces a task has not met are merged together: those of like length are rows of a padded
    matrix, in which every row merges its leftmost pair of least rank each round, looked up in a
    hash table; finished rows leave the matrix. No special tokens are added or looked for.

    One row for each row of ``docs``, repeated rows and null ids included. A null text is empty and
    has no ids; an empty table gives no rows; further columns are not read. Pieces of any length
    are encoded whole. ``path`` must be readable on every executor.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", whole_text().alias("text"))
    return texts.mapInArrow(encoder(path, pattern), f"doc_id {doc_type}, ids array<int>")


def decoder(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary_of(path).tokens
        for batch in batches:
            start = 0
            bounds = batch.column(1).offsets.to_numpy()
            while start < batch.num_rows:
                end = int(np.searchsorted(bounds, bounds[start] + DECODED_IDS, side="right")) - 1
                end = max(start + 1, min(end, batch.num_rows))
                ids = batch.column(1).values[int(bounds[start]) : int(bounds[end])].to_numpy()
                body, upto = tokens.gathered(ids)
                ends = upto[bounds[start : end + 1] - bounds[start]]
                texts = pa.Array.from_buffers(
                    pa.large_binary(), end - start, [None, pa.py_buffer(ends), pa.py_buffer(body)]
                )
                rows = batch.slice(start, end - start)
                yield pa.record_batch([rows.column(0), rows.column(1), texts.cast(pa.binary())], names=["doc_id", "ids", "decoded"])
                start = end

    return decode


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the bytes that these ids stand for; ids must come from the vocabulary at ``path``.

    A null list is empty; one row for each row of ``tokens``.
    """
    doc_type = tokens.schema["doc_id"].dataType.simpleString()
    listed = tokens.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return listed.mapInArrow(decoder(path), f"doc_id {doc_type}, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of the rows that ``decode`` gives."""
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
