"""CSV lines and the records they make (S1-S3), whatever the length of a record.

A line with an odd number of quotes opens or closes a quoted field, so such lines are numbered in every
split of a file, and the numbers carried over its splits. From one of them to the next, a line is
read by an automaton with two states, inside or outside of quotes: what it does to a record is told by
the line alone, and what a split does is the sum of its lines. A record is accepted where these sums
make one, so a quote that is never closed swallows nothing, and no text is put together in vain.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.session import written

#: Lines end here, a carriage return before it included; a lone one is a character like another.
LINE_END = "\n"
#: Noncharacters, which stand in no text: they make the reader take a line for one field.
NO_SEPARATOR, NO_QUOTE = "\ufdd1", "\ufdd0"
#: So few files are named to the scans; more are told by a join.
NAMED_FILES = 64

Parse = Callable[[Column], Column]
Files = list[str] | DataFrame


def without_return(line: Column) -> Column:
    """The line without the carriage return of its end."""
    return F.when(line.endswith("\r"), F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def odd_quotes(line: Column) -> Column:
    """1 for a line with an odd number of quotes: an escaped quote is doubled, so a field stays open."""
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    return F.when(F.contains(line, F.lit('"')), quotes % 2).otherwise(0)


def single_lines(spark: SparkSession, path: str, has_header: bool) -> DataFrame:
    """value, file and odd of every line but headers and blank ones, in splits."""
    reader = spark.read.schema("value string, whole string").options(
        header=has_header, sep=NO_SEPARATOR, quote=NO_QUOTE, escape=NO_QUOTE, lineSep=LINE_END, mode="PERMISSIVE",
        columnNameOfCorruptRecord="whole", columnPruning=False,
    )
    lines = reader.csv(path).select(
        # a line that holds the separator after all is malformed, and there as a whole
        F.coalesce("whole", "value").alias("value"), F.col("_metadata.file_path").alias("file")
    )
    lines = lines.select(without_return(F.col("value")).alias("value"), "file")
    return lines.withColumn("odd", odd_quotes(F.col("value")))


def of_files(df: DataFrame, column: str, files: Files, kept: bool = True) -> DataFrame:
    """The rows whose ``column`` is one of the files, or those where it is not."""
    if isinstance(files, DataFrame):
        return df.join(files.toDF(column), column, "left_semi" if kept else "left_anti").select(*df.columns)
    named = F.col(column).isin(files)
    return df.filter(named if kept else ~named)


def few_or_table(files: DataFrame) -> Files:
    """The files' names where they are few, which the scan then opens alone; else the table itself."""
    few = files.limit(NAMED_FILES + 1).collect()
    return [row[0] for row in few] if len(few) <= NAMED_FILES else written(files, "open-files")


def all_lines(spark: SparkSession, path: str, files: Files) -> DataFrame:
    """file, block, at, value of every line of the ``files``, in the order ``at`` within a block."""
    lines = spark.read.option("lineSep", LINE_END).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        without_return(F.col("value")).alias("value"),
    )
    return of_files(lines, "file", files)


def state_of(line: Column, inside: bool, left_open: Column) -> tuple[Column, Column]:
    """Commas outside of quotes, and whether quotes open after a comma and close before one.

    The line begins ``inside`` quotes or not and ends inside of them where ``left_open``: with the quotes
    it lacks put at its ends, its quoted fields are whole.
    """
    bare = F.replace(line, F.lit('""'), F.lit(""))
    closed = F.concat(F.lit('"' if inside else ""), bare, F.when(left_open, '"').otherwise(""))
    rest = F.regexp_replace(closed, r'(?<=\A|,)"[^"]*+"(?=,|\z)', "")
    commas = F.octet_length(rest) - F.octet_length(F.replace(rest, F.lit(","), F.lit("")))
    return commas, ~F.contains(rest, F.lit('"'))


def told_lines(lines: DataFrame) -> DataFrame:
    """What each line does to a record it is in: as one between others, as its last line, as its first.

    A line without quotes is text inside a field. Only a line with an odd number can end or begin a record.
    """
    odd, value = F.col("odd") == 1, F.col("value")
    quoted = F.contains(value, F.lit('"'))
    inner, inner_right = state_of(value, True, ~odd)
    first, first_right = state_of(value, False, odd)
    return lines.withColumn("odd", odd_quotes(value)).select(
        "*",
        F.when(quoted, inner).otherwise(0).alias("commas"),
        F.when(quoted, inner_right).otherwise(True).alias("right"),
        F.when(odd, first).otherwise(0).alias("first_commas"),
        F.when(odd, first_right).otherwise(True).alias("first_right"),
    )


def numbered(lines: DataFrame, has_header: bool) -> DataFrame:
    """Lines with ``within``: how many odd lines their block has up to them. A block is the most that one task sees."""
    in_block = Window.partitionBy("file", "block").orderBy("at")
    if has_header:
        lines = lines.withColumn("_line", F.row_number().over(in_block))
        lines = lines.filter((F.col("block") > 0) | (F.col("_line") > 1)).drop("_line")
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("within", F.sum("odd").over(upto).cast("int"))


def segments(lines: DataFrame, fields: int, ordered: bool) -> DataFrame:
    """file, block, within and what the lines from one odd line of a block to the next come to.

    ``opens`` tells whether such a line is there; the one that begins a segment may end the record
    before it, as ``last_commas`` and ``last_right`` have it. ``breaks`` are the fields in which lines
    end, counted from the segment's first line on, and no further than there are fields.
    """
    odd = F.col("odd") == 1
    begun = F.when(odd, F.col("first_commas")).otherwise(F.col("commas"))
    breaks = F.array().cast("array<int>")
    if ordered:
        upto = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        lines = lines.withColumn("_sum", F.sum(begun).over(upto))
        start = F.coalesce(F.last(F.when(odd, F.col("_sum") - begun), ignorenulls=True).over(upto), F.lit(0))
        lines = lines.withColumn("_field", F.least(F.col("_sum") - start, F.lit(fields)).cast("int"))
        breaks = F.collect_set("_field")
    return lines.groupBy("file", "block", "within").agg(
        F.max("odd").alias("opens"),
        F.sum(begun).alias("commas"),
        F.min(F.when(odd, F.col("first_right")).otherwise(F.col("right"))).alias("right"),
        F.sum(F.when(odd, F.col("commas"))).alias("last_commas"),
        F.min(F.when(odd, F.col("right"))).alias("last_right"),
        breaks.alias("breaks") if ordered else F.first(breaks).alias("breaks"),
    )


def block_sums(parts: DataFrame, fields: int, allowed: Sequence[int] | None) -> DataFrame:
    """One row for each block: what it does to a record that comes into it, and to one that goes on.

    ``lines`` are its odd lines, each with the last of them up to it that cannot begin a record.
    Whether the last odd line can, the blocks behind it tell.
    """
    in_block = Window.partitionBy("file", "block").orderBy("within")
    fits = F.lit(True) if allowed is None else F.forall("breaks", lambda b: b.isin(list(allowed)))
    ends = F.lead("last_right").over(in_block)
    commas = F.col("commas") + F.lead("last_commas").over(in_block)
    is_record = F.when(ends.isNotNull(), (commas == fields - 1) & F.col("right") & ends & fits)
    parts = parts.withColumns({"_fits": fits, "_failed": F.when(F.col("within") > 0, ~is_record)})
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    failed = F.coalesce(F.max(F.when(F.col("_failed"), F.col("within"))).over(upto), F.lit(0))
    parts = parts.withColumn("failed", failed)
    entering, first, last = F.col("within") == 0, F.col("within") == 1, F.max(F.struct("within", "commas", "right", "_fits"))
    return parts.groupBy("file", "block").agg(
        F.max("within").cast("long").alias("odd_lines"),
        F.max("failed").alias("failed"),
        F.array_sort(F.collect_list(F.when(~entering, F.struct("within", "failed")))).alias("lines"),
        F.coalesce(F.max(F.when(entering, F.col("commas"))), F.lit(0)).alias("commas"),
        F.coalesce(F.min(F.when(entering, F.col("right"))), F.lit(True)).alias("right"),
        F.max(F.when(entering, F.col("breaks"))).alias("breaks"),
        F.max(F.when(first, F.struct("last_commas", "last_right"))).alias("first"),
        last.alias("last"),
    )


def decisions(blocks: DataFrame, fields: int, allowed: Sequence[int] | None) -> DataFrame:
    """file, block, ``begun``: which odd lines of a block begin a record; ``entered``: whether it begins within
    one, which began with odd line ``from_line`` of block ``from_block``.

    Of odd lines in a row that could each begin a record, every other does: those an odd number of lines
    after the last that could not, which is the greatest of these so far, within the block or carried over
    the file's blocks. One row for each block meets the others of its file.
    """
    in_file = Window.partitionBy("file").orderBy("block")
    before, upto = (in_file.rowsBetween(Window.unboundedPreceding, end) for end in (-1, 0))
    behind = in_file.rowsBetween(1, Window.unboundedFollowing)
    holds = F.col("odd_lines") > 0
    zero = lambda column: F.coalesce(column, F.lit(0))
    told = blocks.withColumns({"sum": F.sum("commas").over(upto), "before": zero(F.sum("odd_lines").over(before))})
    opened = F.struct("block", "odd_lines", "sum", F.col("last.commas").alias("commas"))
    told = told.withColumn("from", F.last(F.when(holds, opened), ignorenulls=True).over(before))
    fits = F.lit(True)
    if allowed is not None:
        field = F.col("from.commas") + F.col("sum") - F.col("commas") - F.col("from.sum")
        fits = F.coalesce(F.forall("breaks", lambda b: (b + field).isin(list(allowed))), F.lit(True))
    told = told.withColumn("wrong", F.sum(F.when(F.col("right") & fits, 0).otherwise(1)).over(upto))
    closed = F.first(F.when(holds, F.struct("sum", "wrong", "first")), ignorenulls=True).over(behind)
    told = told.withColumn("closed", closed)
    commas = F.col("last.commas") + F.col("closed.sum") - F.col("sum") + F.col("closed.first.last_commas")
    goes_on = (
        (commas == fields - 1) & F.col("last.right") & F.col("last._fits") & F.col("closed.first.last_right")
        & (F.col("closed.wrong") == F.col("wrong"))
    )
    told = told.withColumn("failed", F.when(holds & ~zero(goes_on.cast("int")).cast("boolean"), F.col("odd_lines")).otherwise(F.col("failed")))
    failed = F.when(F.col("failed") > 0, F.col("before") + F.col("failed"))
    told = told.withColumn("carried", zero(F.max(failed).over(before)))

    def begins(line: Column) -> Column:
        own = F.when(line["within"] == F.col("odd_lines"), F.col("failed")).otherwise(line["failed"])
        last = F.greatest("carried", F.when(own > 0, F.col("before") + own).otherwise(0))
        return (F.col("before") + line["within"] - last) % 2 == 1

    return told.select(
        "file", "block", F.transform("lines", begins).alias("begun"),
        ((F.col("before") - F.col("carried")) % 2 == 1).alias("entered"),
        F.col("from.block").alias("from_block"), F.col("from.odd_lines").cast("int").alias("from_line"),
    )


def judged(lines: DataFrame, decided: DataFrame) -> DataFrame:
    """Lines with ``record``, the block and odd line with which the record they are in begins, or null.

    The decisions of a block come to its lines, which are already together.
    """

    def begins(line: Column) -> Column:
        own = F.try_element_at("begun", F.greatest(line, F.lit(1)))
        return F.when(line <= 0, F.col("entered")).otherwise(own)

    def named(line: Column) -> Column:
        entered = F.struct(F.col("from_block").alias("block"), F.col("from_line").alias("line"))
        return F.when(line <= 0, entered).otherwise(F.struct("block", line.alias("line")))

    joined = lines.join(decided, ["file", "block"])
    within = F.col("within")
    record = F.when((F.col("odd") == 1) & begins(within - 1), named(within - 1)).when(begins(within), named(within))
    return joined.withColumn("record", record).drop("begun", "entered", "from_block", "from_line")


def texts_of(lines: DataFrame) -> DataFrame:
    """The text of each record: put together in its block, and over blocks where it goes beyond one."""
    parts = F.array_sort(F.collect_list(F.struct("at", "value")))
    own = lines.groupBy("file", "block", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), LINE_END).alias("text"), F.sum("odd").alias("_odd")
    )
    # the first and the last line of a record are its two odd lines
    complete = own.filter("_odd = 2").select("text")
    over = F.array_sort(F.collect_list(F.struct("block", "text")))
    torn = own.filter("_odd < 2").groupBy("file", "record").agg(
        F.array_join(F.transform(over, lambda p: p["text"]), LINE_END).alias("text")
    )
    return complete.unionAll(torn.select("text"))


def records(spark: SparkSession, path: str, files: Files, headers: Sequence[str], breaks: Sequence[str] | None,
            raw_line: str, *, has_header: bool, parse: Parse) -> DataFrame:
    """Every line of ``files`` as part of one row: of its own, or of the record it belongs to.

    A line that opens a quote no record closes is malformed: it is parsed by itself and its raw
    text kept, and the lines after it are rows as ever. ``breaks`` names the columns that may hold line
    breaks; None stands for all. Blank lines are no rows. A record may have any length that a value
    can have, and go over any number of splits.
    """
    lines = written(told_lines(all_lines(spark, path, files)), "lines")
    allowed = None if breaks is None else [i for i, header in enumerate(headers) if header in breaks]
    # what the lines come to is learned without their texts
    parts = segments(numbered(lines.drop("value"), has_header), len(headers), allowed is not None)
    decided = decisions(block_sums(parts, len(headers), allowed), len(headers), allowed)
    told = judged(numbered(lines.select("file", "block", "at", "value", "odd"), has_header), decided)
    whole = texts_of(told.filter("record is not null")).select(parse(F.col("text")).alias("row"), F.lit(None).alias("odd_line"))
    blank = F.rlike("value", F.lit(r"\A[\x00-\x20]*\z"))
    singles = told.filter(F.col("record").isNull() & ~blank)
    open_line = F.when(F.col("odd") == 1, F.col("value"))
    singles = singles.select(parse(F.col("value")).alias("row"), open_line.alias("odd_line"))
    return whole.unionAll(singles).select(*fields_of(headers, raw_line, F.col("odd_line")))


def fields_of(headers: Sequence[str], raw_line: str, odd_line: Column) -> list[Column]:
    """The columns of a parsed ``row``; a line with an open quote is malformed however it was read."""
    names = [F.col(f"row.`{h}`").alias(h) for h in headers]
    return [*names, F.coalesce(odd_line, F.col(f"row.`{raw_line}`")).alias(raw_line)]
