"""What several operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.session import written

#: monotonically_increasing_id() holds the partition above this many bits and the row below.
ROW_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where there is none."""
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    The optimizer merges projections and would else evaluate ``value`` anew for each element of
    an array that ``body`` goes through.
    """
    return F.transform(F.array(value), body)[0]


def crc32_of(column: Column) -> Column:
    return F.crc32(column.cast("binary"))


def with_positions(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``position`` (from 0, in the order given) and ``total`` rows.

    The rows are sorted by range over all tasks and written once; only the number of rows of
    each partition is summed up in one place. Rows equal in all of ``order`` are placed in
    either order.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = written(ordered.withColumn("_row", F.monotonically_increasing_id()), name)
    counts = numbered.groupBy(F.shiftright("_row", ROW_BITS).alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("total"),
    )
    # as many rows as the sort had partitions
    joined = numbered.withColumn("_part", F.shiftright("_row", ROW_BITS)).join(F.broadcast(offsets), "_part")
    row = F.col("_row").bitwiseAND((1 << ROW_BITS) - 1)
    return joined.select(*df.columns, (F.col("_before") + row).alias("position"), "total")


#: Bits of a row's place in its file, below the number of the file.
PLACE_BITS = 40
#: The column of row numbers; a name that no table has.
ROW = "_casebook_row"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``ROW``, a number that names each row in every reading of a table of files.

    It is the row's place in its file and the number of the file, so it does not hang on how a reading
    is split. Rows that come from elsewhere are written first. One row for each file is numbered in
    one place and joined.
    """
    if not is_table_of_files(docs):
        docs = written(docs, "rows")
    placed = docs.select("*", F.col("_metadata.file_path").alias("_casebook_file"), F.col("_metadata.row_index").alias("_casebook_place"))
    files = placed.select("_casebook_file").distinct()
    files = written(files.withColumn("_casebook_file_number", F.row_number().over(Window.orderBy("_casebook_file")).cast("long")), "files")
    row = F.shiftleft("_casebook_file_number", PLACE_BITS) + F.col("_casebook_place")
    return placed.join(files, "_casebook_file").select(*[f"`{c}`" for c in docs.columns], row.alias(ROW))


def is_table_of_files(docs: DataFrame) -> bool:
    """Whether ``docs`` is a Parquet table as it was read, whose rows have a place in a file."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return False
    return docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation"


def without_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of a ``numbered`` table but those with a number ``_found``, without the numbers."""
    found = written(found.select("_found"), "found-rows")
    return docs.join(found, F.col(ROW) == F.col("_found"), "left_anti").drop(ROW)


def give_back() -> None:
    """Return this process's freed memory to the machine: a worker that has nothing to do stays beside later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def unsigned_mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalising mix: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string or binary column in a row, and where each begins and ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]]
    return body, bounds - bounds[0]


def blocks_of(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with at most ``most`` bytes in ``column``, one row at least."""
    if not batch.num_rows:
        return
    _, bounds = byte_column(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(bounds, bounds[start] + most, side="right")) - 1
        end = max(start + 1, min(end, batch.num_rows))
        yield batch.slice(start, end - start)
        start = end
