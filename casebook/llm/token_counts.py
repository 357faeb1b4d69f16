"""Exact token counts without token ids: pieces are counted once per distinct pre-token."""

from __future__ import annotations

import functools
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import ROW_BITS
from casebook.session import written

#: Distinct pre-tokens a task holds before it passes them on.
TASK_PIECES = 400_000
#: Frequent pre-tokens that are sent to every task, and the bytes of the longest of them.
HEAD_PIECES = 1_000_000
HEAD_BYTES = 48
#: Half octaves of document frequency among which the head is cut.
STEPS = 4

#: A letter or digit before a mark that is no apostrophe (which may begin a contraction) and no part
#: of a special token always ends a token, so that "word," shares the entry of "word".
CUT = re.compile(rb"(?<=[A-Za-z0-9])(?=[,.;:!?%&$*#()])")
PLACEHOLDER = b" "


def pre_tokens(text: str | None) -> list[bytes]:
    """Pieces of a text that the tokenizer handles independently of each other.

    Fixed by the vocabulary file's own rules: ASCII white space only separates, normalising works
    within what stands between it, and no token goes beyond it.
    """
    return CUT.sub(b" ", text.encode()).split() if text else []


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@functools.cache
def ends_word(path: str) -> np.ndarray:
    """Which ids end a word, by the vocabulary's mark for that."""
    loaded = tokenizer(path)
    flags = np.zeros(loaded.get_vocab_size() + 1, dtype=bool)
    for token, number in loaded.get_vocab().items():
        flags[number] = token.endswith("</w>")
    return flags


def piece_counts(pieces: list[bytes], path: str) -> np.ndarray:
    """Tokens of every piece. Plain words are encoded as one text and told apart by their last tokens."""
    loaded = tokenizer(path)
    texts = [p.decode() for p in pieces]
    plain = np.fromiter((t.isalpha() for t in texts), bool, len(texts))
    counts = np.zeros(len(texts), dtype=np.int64)
    words = [t for t, p in zip(texts, plain, strict=True) if p]
    ids = np.array(loaded.encode(" ".join(words), add_special_tokens=False).ids, dtype=np.int64)
    last = np.flatnonzero(ends_word(path)[ids]) if len(ids) else np.zeros(0, np.int64)
    if len(last) == len(words):
        counts[plain] = np.diff(last, prepend=-1)
    else:  # a letter to one of the libraries only
        plain[:] = False
    rest = np.flatnonzero(~plain)
    encoded = loaded.encode_batch([texts[i] for i in rest], add_special_tokens=False)
    counts[rest] = [len(e) for e in encoded]
    return counts


def count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """piece, n_docs: in how many of the task's documents every piece is."""
    held: Counter[bytes] = Counter()

    def passed_on() -> pa.RecordBatch:
        batch = pa.record_batch(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["piece", "n_docs"]
        )
        held.clear()
        return batch

    for batch in batches:
        for text in batch.column(0):
            held.update(set(pre_tokens(text.as_py())))
            if len(held) >= TASK_PIECES:
                yield passed_on()
    yield passed_on()


def piece_encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = piece_counts(batch.column(0).to_pylist(), path)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(counts)], names=["piece", "n_docs", "n_pieces"])

    return encode


def head_of(pieces: DataFrame) -> DataFrame:
    """The most frequent pieces: those above the least step of document frequency that HEAD_PIECES allow.

    Only the number of pieces in each step comes to the driver, some hundred rows.
    """
    short = pieces.filter(F.octet_length("piece") <= HEAD_BYTES)
    step = F.floor(F.log2("n_docs") * STEPS).cast("int")
    steps = short.groupBy(step.alias("step")).count().collect()
    least, held = None, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        held += row["count"]
        if held > HEAD_PIECES:
            break
        least = row["step"]
    return short.filter(step >= least) if least is not None else short.limit(0)


def document_counter(head, share: int):
    """Rows of documents: tokens of their frequent pieces, and every other piece with its frequency."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, numbers = head.value
        known = dict(zip(pieces.to_pylist(), numbers.tolist(), strict=True))
        row = TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows: list[int] = []
            at: list[int] = []
            sizes: list[int] = []
            firsts: list[int] = []
            names: list[bytes] = []
            times: list[int] = []
            for i, scalar in enumerate(texts):
                text = scalar.as_py()
                counted, rest = 0, []
                for piece, n in Counter(pre_tokens(text)).items():
                    tokens = known.get(piece)
                    if tokens is None:
                        rest.append((piece, n))
                    else:
                        counted += tokens * n
                # a document without rare pieces has one row, under a key that is no piece's
                rest = rest or [(PLACEHOLDER + str(row % share).encode(), 0)]
                rows += [row] * len(rest)
                at += [i] * len(rest)
                sizes += [len(text.encode()) if text else 0] * len(rest)
                firsts += [counted] + [0] * (len(rest) - 1)
                names += [p for p, _ in rest]
                times += [n for _, n in rest]
                row += 1
            yield pa.record_batch(
                [
                    pa.array(rows, pa.int64()), ids.take(pa.array(at, pa.int64())), pa.array(sizes, pa.int64()),
                    pa.array(firsts, pa.int64()), pa.array(names, pa.binary()), pa.array(times, pa.int64()),
                ],
                names=["row", "doc_id", "n_bytes", "counted", "rare", "times"],
            )

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Tokens of every whole text as the tokenizer at ``path`` gives them, without special tokens added.

    Three passes: the document frequency of every distinct pre-token, summed in the tasks before the
    shuffle; the number of pieces of each, by the tokenizer, once; and the frequencies of pre-tokens
    in every document, joined to these numbers. The frequent pre-tokens, at most HEAD_PIECES of at
    most HEAD_BYTES bytes, go to every task and are joined there; the rare rest is joined by
    shuffle. So a word in all documents never meets in one task, and no word is left out. No token
    id of a document is made.

    Returns doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens), one row for each
    row of ``docs``, repeated rows and null ids included. A null text counts as empty and has 0
    tokens; an empty table gives no rows. Special strings inside a text count as the library's
    default has it. Further columns are not read. ``path`` must be readable on every executor.
    """
    spark = docs.sparkSession
    seen = docs.select("text").mapInArrow(count_documents, "piece binary, n_docs long")
    distinct = seen.groupBy("piece").agg(F.sum("n_docs").alias("n_docs"))
    encoded = distinct.mapInArrow(piece_encoder(path), "piece binary, n_docs long, n_pieces long")
    pieces = written(encoded, "pieces")
    frequent = head_of(pieces).select("piece", "n_pieces").toArrow()
    head = spark.sparkContext.broadcast(
        (frequent.column(0).combine_chunks(), frequent.column(1).to_numpy().astype(np.int32))
    )
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {doc_type}, n_bytes long, counted long, rare binary, times long"
    rows = docs.select("doc_id", "text").mapInArrow(document_counter(head, 1 << 16), schema)
    numbers = pieces.select(F.col("piece").alias("rare"), "n_pieces")
    tokens = F.col("counted") + F.col("times") * F.coalesce("n_pieces", F.lit(0))
    counted = (
        rows.join(numbers, "rare", "left")
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens"))
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
