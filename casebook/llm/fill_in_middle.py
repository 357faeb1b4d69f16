"""Fill-in-the-middle texts: prefix, middle and suffix cut at line ends that a learned index finds."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import blocks_of, byte_column, whole_text

#: Bytes of text cut at a time; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20
#: How far a segment's line may miss an offset, in bytes; the misses are held in 16 bits.
MOST_ERROR = 4096
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
NEWLINE = 10


class RankIndex:
    """Offsets by rank: lines over segments of ranks, each within ``most`` of all its offsets, and what they miss.

    ``offsets`` do not decrease. A segment is the line through its first and last offset; one that
    misses an offset by more than ``most`` is halved, all such segments of a level at once, so one of
    two ranks at the latest misses nothing.
    """

    def __init__(self, offsets: np.ndarray, most: int = MOST_ERROR):
        self.missed = np.zeros(len(offsets), np.int16)
        firsts, bases, slopes = [], [], []
        first, last = np.array([0]), np.array([len(offsets) - 1])
        while len(first):
            base = offsets[first]
            slope = (offsets[last] - base) / np.maximum(last - first, 1)
            sizes = last - first + 1
            begins = np.cumsum(sizes) - sizes
            within = np.arange(sizes.sum()) - np.repeat(begins, sizes)
            ranks = np.repeat(first, sizes) + within
            missed = offsets[ranks] - self.line(np.repeat(base, sizes), np.repeat(slope, sizes), within)
            wide = np.maximum.reduceat(np.abs(missed), begins) > most
            kept = np.repeat(~wide, sizes)
            self.missed[ranks[kept]] = missed[kept]
            firsts.append(first[~wide])
            bases.append(base[~wide])
            slopes.append(slope[~wide])
            middle = (first[wide] + last[wide]) // 2
            first, last = np.concatenate([first[wide], middle + 1]), np.concatenate([middle, last[wide]])
        order = np.argsort(np.concatenate(firsts))
        self.first = np.concatenate(firsts)[order]
        self.base, self.slope = np.concatenate(bases)[order], np.concatenate(slopes)[order]

    @staticmethod
    def line(base: np.ndarray, slope: np.ndarray, within: np.ndarray) -> np.ndarray:
        return base + np.floor(slope * within).astype(np.int64)

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        """Offsets as the segments' lines have them."""
        segment = np.searchsorted(self.first, ranks, side="right") - 1
        return self.line(self.base[segment], self.slope[segment], ranks - self.first[segment])

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets: the predicted ones and what these miss."""
        return self.predicted(ranks) + self.missed[ranks]


def boundaries(body: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of all line bounds of texts in a row, text after text, and where each text's begin.

    A text of n lines has n + 1 bounds, its start among them; what follows its last line end is a line too.
    """
    ends = np.flatnonzero(body == NEWLINE) + 1
    starts, stops = bounds[:-1], bounds[1:]
    lines = np.searchsorted(ends, stops, side="right") - np.searchsorted(ends, starts, side="right")
    filled = stops > starts
    open_end = filled.copy()
    open_end[filled] = body[stops[filled] - 1] != NEWLINE
    upto = np.concatenate([[0], np.cumsum(1 + lines + open_end)])
    result = np.empty(upto[-1], np.int64)
    plain = np.ones(upto[-1], bool)
    result[upto[:-1]], plain[upto[:-1]] = starts, False
    result[upto[1:][open_end] - 1], plain[upto[1:][open_end] - 1] = stops[open_end], False
    result[plain] = ends
    return result, upto


def cutter(marks: tuple[str, str, str], most: int):
    before_prefix, before_suffix, before_middle = (m.encode() for m in marks)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks_of(batch, "text", BLOCK_BYTES):
                body, bounds = byte_column(block.column(1))
                offsets, upto = boundaries(body, bounds)
                index = RankIndex(offsets, most)
                n = np.diff(upto) - 1
                draws = np.stack([block.column(c).to_numpy() % (n + 1) for c in (3, 4)])
                low, high = (index.offsets(upto[:-1] + ranks) for ranks in (draws.min(axis=0), draws.max(axis=0)))
                points = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
                forms = block.column(2).to_pylist()
                plain = np.array([f == "plain" for f in forms])
                data, outputs = body.tobytes(), []
                for start, a, b, stop, form in zip(bounds[:-1].tolist(), low.tolist(), high.tolist(), bounds[1:].tolist(), forms, strict=True):
                    prefix, middle, suffix = data[start:a], data[a:b], data[b:stop]
                    if form == "plain":
                        outputs.append(data[start:stop])
                    elif form == "psm":
                        outputs.append(b"".join((before_prefix, prefix, before_suffix, suffix, before_middle, middle)))
                    else:
                        outputs.append(b"".join((before_suffix, suffix, before_prefix, prefix, before_middle, middle)))
                yield pa.record_batch(
                    [
                        block.column(0), pa.array(n), block.column(2),
                        pa.array(points[low] - points[bounds[:-1]], mask=plain), pa.array(points[high] - points[low], mask=plain),
                        pa.array(outputs, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return cut


def draw(key: Column, group: int) -> Column:
    """The 8-digit group of that number of the hexadecimal hash ``key``, as a number."""
    return F.conv(F.substring(key, 8 * group - 7, 8), 16, 10).cast("long")


def rearranged(
    docs: DataFrame, *, seed: int = 7, percent: int = 100, suffix_first: int = 50, marks: tuple[str, str, str] = MARKS,
    most: int = MOST_ERROR,
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output: texts with their middle moved to the end.

    Units are lines with their line end. Two numbers drawn from the hash of ``seed`` and doc_id are the ranks
    at which the prefix and the middle end. Their offsets come from a learned index over all line
    bounds of a block of documents: segments of lines within ``most`` bytes, corrected by what these miss.
    ``percent`` of the documents are rearranged, ``suffix_first`` percent of these as suffix, prefix,
    middle (spm), the others as prefix, suffix, middle (psm), each part behind its mark.

    A text is plain, its own output, where it is null, empty or holds a mark; prefix_chars and
    middle_chars are null there. Rows without an id draw as one with the id "". One row for each row of
    ``docs``, repeated rows included; an empty table gives no rows; further columns are not read.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains(F.col("text"), F.lit(mark))
    is_plain = (F.col("text") == "") | marked | (draw(F.col("key"), 3) % 100 >= percent)
    form = F.when(is_plain, "plain").when(draw(F.col("key"), 4) % 100 < suffix_first, "spm").otherwise("psm")
    drawn = docs.select("doc_id", whole_text().alias("text"), key.alias("key")).select(
        "doc_id", "text", form.alias("form"), draw(F.col("key"), 1).alias("h1"), draw(F.col("key"), 2).alias("h2")
    )
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return drawn.mapInArrow(cutter(marks, most), schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The exact text from an output and its form: the marks, which no rearranged text holds, part it."""
    parts = F.split(output, "|".join(map(re.escape, marks)), -1)
    joined = F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))
    return F.when(form == "plain", output).otherwise(joined)


def digests(rows: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """The rows of ``rearranged`` with hashes of the output and of the text restored from it, in place of the output."""
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form"), marks), 256).alias("restored_sha256"),
    )
