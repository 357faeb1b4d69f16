"""Token ids in Parquet list columns, and reading them back in part or whole."""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm.common import blocks_of, give_back, whole_text
from casebook.llm.token_counts import tokenizer
from casebook.session import arrow_rows, scratch_path

#: Bytes of text encoded at a time, and rows that a task is handed at a time.
BLOCK_BYTES = 2 << 20
BATCH_ROWS = 750
#: Batches after which a tidy task gives freed memory back.
TIDY_BATCHES = 8
#: Distinct pieces a task remembers before it forgets those met once; about 250 bytes each.
KEPT_PIECES = 700_000
#: Pieces handed to the library at a time; what it returns for them is large.
CALL_PIECES = 20_000
#: Text that one task encodes and writes to one file: less holds fewer chunks in memory, more encodes fewer of them twice.
FILE_BYTES = 56 << 20
#: Row groups small enough to skip, pages with few rows, and dictionary codes for the ids, which
#: come from a vocabulary that fits one dictionary page.
FORMAT = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "512",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
}

#: Between a letter or digit and marks that are no apostrophe, which may begin a contraction, tokens end too.
MARKS = b",.;:!?%&$*#()"
#: A byte of no UTF-8 text: between chunks, and as the chunk that stands for the end of a document.
MARK = b"\xff"
#: How wider white space may begin, and what it is.
WIDE_LEADS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe1\xa0", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80", b"\xef\xbb")
CONTROLS = (b"\x1c", b"\x1d", b"\x1e", b"\x1f")
WIDE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\xef\xbb\xbf"
)
CHUNK = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+\Z")


def may_be_wide(data: bytes) -> bool:
    for control in CONTROLS:
        if control in data:
            return True
    if not data.isascii():
        for lead in WIDE_LEADS:
            if lead in data:
                return True
    return False


def is_even(data: bytes) -> bool:
    """Whether all white space is single blanks and line ends between words."""
    return not (
        b"  " in data or b"\n\n" in data or b" \n" in data or b"\n " in data or b"\t" in data or b"\r" in data
        or b"\x0b" in data or b"\x0c" in data or data[:1] in b" \n" or data[-1:] in b" \n"
    )


def chunks_of(data: bytes) -> list[bytes]:
    """A text cut where the tokenizer never joins: before white space that follows other characters.

    A text in which wider white space or a special token might stand is one chunk.
    """
    if not data:
        return []
    if b"<|" in data or may_be_wide(data) and WIDE.search(data):
        return [data]
    if is_even(data):
        return data.replace(b" ", MARK + b" ").replace(b"\n", MARK + b"\n").split(MARK)
    return CHUNK.findall(data)


@functools.cache
def begins_with_blank(path: str) -> np.ndarray:
    """Which ids begin with a blank, by the vocabulary's sign for it."""
    loaded = tokenizer(path)
    flags = np.zeros(loaded.get_vocab_size() + 1, dtype=bool)
    for token, number in loaded.get_vocab().items():
        flags[number] = token[:1] == "\u0120"
    return flags


class Numbers(dict):
    """Numbers of chunks, given in the order in which they are first asked for."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        number = self[chunk] = len(self)
        self.fresh.append(chunk)
        return number


class PieceIds:
    """Ids of the distinct chunks met so far, each encoded once by the library."""

    def __init__(self, path: str, end_id: int, kept: int = KEPT_PIECES):
        self.path, self.end_id, self.kept = path, end_id, kept
        self.reset()

    def reset(self) -> None:
        self.numbers = Numbers()
        self.flat, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.again = np.zeros(1 << 16, bool)
        self.numbers[MARK] = 0
        self.place(np.zeros(1, np.int64), np.array([self.end_id], np.int32), np.ones(1, np.int64))

    def forget(self) -> None:
        """Drop the chunks met once; all, where most were met again."""
        kept = self.again[: len(self.numbers)].copy()
        kept[0] = True
        at = np.flatnonzero(kept)
        if len(at) > self.kept // 2:
            self.reset()
            return
        ids, upto = self.gathered(at)
        chunks = list(compress(self.numbers, kept))
        self.reset()
        self.numbers.update(zip(chunks, range(len(chunks)), strict=True))
        self.used = 0
        self.place(np.arange(len(chunks)), ids, np.diff(upto))

    def place(self, numbers: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Keep the ids of the chunks with these numbers."""
        while len(self.starts) < len(self.numbers):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[numbers] = self.used + np.cumsum(lengths) - lengths
        self.lengths[numbers] = lengths
        self.used += len(ids)

    def add(self, new: list[bytes], number: int) -> None:
        """Ids of new chunks, numbered from ``number`` on: words with marks after them are put together from both."""
        stems = [c.rstrip(MARKS) for c in new]
        split = np.array([len(s) < len(c) and s[-1:].isalnum() for s, c in zip(stems, new, strict=True)], bool)
        compound = np.flatnonzero(split)
        pairs = np.empty(2 * len(compound), np.int64)
        number_of = self.numbers.__getitem__
        words, ended = list(compress(stems, split)), compress(new, split)
        pairs[0::2] = np.fromiter(map(number_of, words), np.int64, len(compound))
        marks = [c[len(s) :] for s, c in zip(words, ended, strict=True)]
        pairs[1::2] = np.fromiter(map(number_of, marks), np.int64, len(compound))
        parts, self.numbers.fresh = self.numbers.fresh, []
        simple = np.flatnonzero(~split)
        self.encode_all(list(compress(new, ~split)), number + simple)
        self.encode_all(parts, len(self.numbers) - len(parts) + np.arange(len(parts)))
        ids, upto = self.gathered(pairs)
        self.place(number + compound, ids, np.diff(upto[0::2]))

    def encode_all(self, new: list[bytes], numbers: np.ndarray) -> None:
        """Encode chunks by the library.

        Those whose only blank is their first byte are encoded as one text, and told apart by the tokens
        that begin with a blank: each has one at least, so as many as there are chunks leave no doubt.
        """
        library = tokenizer(self.path)
        for i in range(0, len(new), CALL_PIECES):
            part, named = new[i : i + CALL_PIECES], numbers[i : i + CALL_PIECES]
            plain = np.array([c.rfind(b" ") == 0 for c in part], bool)
            words = list(compress(part, plain))
            # the batch call counts no offsets
            [encoded] = library.encode_batch_fast([b"".join(words).decode()], add_special_tokens=False)
            ids = np.array(encoded.ids, np.int32)
            first = np.flatnonzero(begins_with_blank(self.path)[ids]) if len(ids) else np.zeros(0, np.int64)
            if len(first) == len(words):
                self.place(named[plain], ids, np.diff(np.append(first, len(ids))))
            else:
                plain[:] = False
            rest = np.flatnonzero(~plain)
            encoded = library.encode_batch_fast([part[j].decode() for j in rest], add_special_tokens=False)
            lists = [e.ids for e in encoded]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            self.place(named[rest], np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum())), lengths)

    def gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks with these numbers in a row, and where each begins and ends."""
        starts, lengths = self.starts[at], self.lengths[at]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        source = np.repeat((starts - upto[:-1]).astype(np.int32), lengths)
        source += np.arange(upto[-1], dtype=np.int32)
        return self.flat[source], upto

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by the end id, and the bounds of the texts."""
        if len(self.numbers) > self.kept:
            self.forget()
        cut = [chunks_of(t) for t in texts]
        for chunks in cut:
            chunks.append(MARK)
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        new, self.numbers.fresh = self.numbers.fresh, []
        number = len(self.numbers) - len(new)
        self.add(new, number)
        self.again[at[at < number]] = True
        ids, upto = self.gathered(at)
        return ids, upto[np.concatenate([[0], np.cumsum(sizes)])]


def encoder(path: str, end_id: int, tidy: bool = False, kept: int = KEPT_PIECES):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceIds(path, end_id, kept)
        begins_with_blank(path)
        # loading a vocabulary takes more than it holds
        give_back()
        file_no, before = TaskContext.get().partitionId(), 0
        for number, batch in enumerate(batches, 1):
            for block in blocks_of(batch, "text", BLOCK_BYTES):
                ids, bounds = pieces.encode([t.encode() for t in block.column(1).to_pylist()])
                tokens = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.record_batch(
                    [
                        block.column(0), pa.array(np.full(block.num_rows, file_no, np.int32)),
                        pa.array(before + bounds[:-1]), pa.array(np.diff(bounds)), tokens,
                    ],
                    names=["doc_id", "file_no", "file_start", "n_tokens", "ids"],
                )
                before += int(bounds[-1])
            if tidy and number % TIDY_BATCHES == 0:
                give_back()
        # the worker stays beside the stage that reads the files
        del pieces
        give_back()

    return encode


def write_tokens(
    docs: DataFrame, path: str, end_id: int, target: str, file_bytes: int = FILE_BYTES, tidy: bool = False, kept: int = KEPT_PIECES
) -> None:
    """Write the ids of every whole text, in ascending doc_id order over files and rows.

    The files hold doc_id, file_no, file_start (ids before it in its file), n_tokens and ids, a list
    column in dictionary codes. Small row groups and pages with column indexes let readers take the
    metadata, or the documents of a range of doc_id, without reading other ids.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // file_bytes))
    tie = F.xxhash64(whole_text()).alias("tie")
    ordered = (
        docs.select("doc_id", whole_text().alias("text"), tie)
        .repartitionByRange(files, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, file_no int, file_start long, n_tokens long, ids array<int>"
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        ordered.mapInArrow(encoder(path, end_id, tidy, kept), schema).write.options(**FORMAT).parquet(target)


def read_metadata(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and n_tokens, without reading ids."""
    rows = spark.read.parquet(target).select("doc_id", "file_no", "file_start", "n_tokens")
    return with_starts(spark, target, rows)


def with_starts(spark: SparkSession, target: str, rows: DataFrame) -> DataFrame:
    sizes = spark.read.parquet(target).groupBy("file_no").agg(F.sum("n_tokens").alias("in_file"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file_no", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("files_before"))
    # one row for each file
    return rows.join(F.broadcast(offsets), "file_no").withColumn("start", F.col("files_before") + F.col("file_start"))


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the lists of ids hold: their number and the checksum of their little-endian bytes."""
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        bounds = lists.offsets.to_numpy()
        ids = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        sums = [zlib.crc32(ids[a:b].data) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.record_batch(
            [*batch.columns[:3], pa.array(np.diff(bounds).astype(np.int64)), pa.array(sums, pa.int64())],
            names=["doc_id", "file_no", "file_start", "n_tokens", "ids_crc32"],
        )


def tokenize_to_files(
    docs: DataFrame, path: str, end_id: int = 2, target: str | None = None, file_bytes: int = FILE_BYTES,
    tidy: bool = False, kept: int = KEPT_PIECES,
) -> DataFrame:
    """Encode every whole text, write the ids to Parquet files and read these back.

    The texts are sorted by range of doc_id over all tasks and encoded where they arrive: every
    distinct chunk between white space once per task by the library, or again after ``kept`` others if
    it was met once, texts put together from these ids. The files lie below ``target``, by default in the shared scratch folder, each of about ``file_bytes`` of
    text: less text in a task holds fewer chunks in memory, and encodes more of them in several tasks.
    Workers give freed memory back at the end of a task, with ``tidy`` after some batches too, which takes time.

    Returns from the files doc_id, start (ids of all documents before it), n_tokens and ids_crc32
    (of the ids as little-endian unsigned 32-bit integers), one row for each row of ``docs``. A null
    text is empty and has the end id alone; null ids come first; rows of one doc_id follow each
    other by the hash of their texts; an empty table gives no rows. Further columns are not read.
    """
    spark = docs.sparkSession
    target = target or scratch_path(spark, "tokens")
    write_tokens(docs, path, end_id, target, file_bytes, tidy, kept)
    stored = spark.read.parquet(target).select("doc_id", "file_no", "file_start", "ids")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, file_no int, file_start long, n_tokens long, ids_crc32 long"
    summed = stored.mapInArrow(checksums, schema)
    return with_starts(spark, target, summed).select("doc_id", "start", "n_tokens", "ids_crc32")
