"""CSV ingest (S1-S4, S10, P1-P4): one parse of the file gives clean rows, malformed rows and counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from casebook.functions.cleaning import blank_to_null, snake_case
from casebook.functions.rates import ones
from casebook.session import compiled_methods, move, scratch_path
from casebook.sources.records import Parse, few_or_table, fields_of, of_files, records, single_lines
from casebook.sources.specs import DatasetSpec

RAW_LINE = "_corrupt_record"
ROW_STATE = "_row_state"
#: Which conversions could not read their text; where a line is from, and whether its quotes are odd.
UNREAD, FILE, ODD = "_unread", "_file", "_odd"
NOT_ROWS = (RAW_LINE, ROW_STATE, UNREAD, FILE, ODD)
KEPT, ALL_NULL, MISSING_REQUIRED = "kept", "all_null", "missing_required"


class MissingInput(FileNotFoundError):
    """Raised once, naming every input that is not there."""


def require_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Check all inputs on the cluster's file system before any work starts."""
    absent = []
    for path in paths:
        try:
            spark.read.format("binaryFile").load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            absent.append(path)
    if absent:
        raise MissingInput("input not found: " + ", ".join(absent))


def parser(spec: DatasetSpec) -> Parse:
    """A line or record to a struct of its fields and, where it is malformed, its raw text."""
    schema = ", ".join(f"`{name}` string" for name in (*spec.headers, RAW_LINE))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_LINE, "quote": '"', "escape": '"'}
    return lambda text: F.from_csv(text, schema, options)


def check_headers(spark: SparkSession, path: str, spec: DatasetSpec) -> None:
    """Fail where the header of a file is not the declared one; this reads the files once more."""
    reader = spark.read.schema(StructType([StructField(name, StringType()) for name in spec.headers]))
    reader.options(header=True, enforceSchema=False, columnPruning=False, escape='"').csv(path).agg(F.count("*")).first()


def read_lines(spark: SparkSession, path: str, spec: DatasetSpec) -> DataFrame:
    """Every line as a row: the text columns, ``_corrupt_record`` holding the raw line of a malformed row,
    the file, and whether the line has an odd number of quotes."""
    lines = single_lines(spark, path, spec.has_header)
    odd_line = F.when(F.col("odd") == 1, F.col("value"))
    parsed = lines.select("file", "odd", odd_line.alias("odd_line"), parser(spec)(F.col("value")).alias("row"))
    return parsed.select(
        *fields_of(spec.headers, RAW_LINE, F.col("odd_line")), F.col("file").alias(FILE), F.col("odd").alias(ODD)
    )


def clean_columns(raw: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Snake-case names, trimmed strings, "no value" spellings to null (P3, P4) in one select."""
    types = dict(raw.dtypes)
    return raw.select(
        *(
            (blank_to_null(F.col(f"`{c}`")) if types[c] == "string" else F.col(f"`{c}`")).alias(snake_case(c))
            for c in raw.columns
            if c not in skip
        ),
        *skip,
    )


def any_value(columns: Iterable[Column]) -> Column:
    """True where at least one column is not null (the rows P1 keeps)."""
    return reduce(lambda a, b: a | b, (c.isNotNull() for c in columns))


def row_state(is_empty: Column, required: Iterable[str]) -> Column:
    """Why a row is kept or dropped."""
    missing = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in required), F.lit(False))
    return F.when(is_empty, ALL_NULL).when(missing, MISSING_REQUIRED).otherwise(KEPT)


def state_counts(extra: Iterable[Column] = ()) -> list[Column]:
    """The profile as aggregates over ``_row_state``."""
    return [
        F.count(F.lit(1)).alias("rows_in"),
        *(
            F.coalesce(F.sum(ones(F.col(ROW_STATE) == state)), F.lit(0)).cast("bigint").alias(state)
            for state in (ALL_NULL, MISSING_REQUIRED, KEPT)
        ),
        *extra,
    ]


def typed_rows(raw: DataFrame, spec: DatasetSpec, carried: Sequence[str] = ()) -> DataFrame:
    """Raw text to typed columns with ``_row_state`` and ``_unread``, a sign for each conversion: 1 where it
    could not read a text. Nothing is dropped yet; ``carried`` columns pass through."""
    skip = ("_empty", RAW_LINE, *carried)
    is_empty = ~any_value(F.col(f"`{h}`") for h in spec.headers)
    text = clean_columns(raw.withColumn("_empty", is_empty), skip=skip)

    sources = {name: spec.reads.get(name, name) for name in spec.conversions}
    columns = [*spec.columns, *(c for c in spec.conversions if c not in spec.columns)]
    typed = text.select(
        *(
            (spec.conversions[c](F.col(sources[c])) if c in spec.conversions else F.col(c)).alias(c)
            for c in columns
        ),
        *(F.col(sources[c]).alias(f"_text_{c}") for c in spec.conversions),
        *skip,
    )

    columns += [c for c in spec.derived if c not in columns]
    unread = [F.when(F.col(f"_text_{c}").isNotNull() & F.col(c).isNull(), "1").otherwise("0") for c in spec.conversions]
    return typed.select(
        *((spec.derived[c]() if c in spec.derived else F.col(c)).alias(c) for c in columns),
        RAW_LINE,
        row_state(F.col("_empty"), spec.required).alias(ROW_STATE),
        F.concat(F.lit(""), *unread).alias(UNREAD),
        *carried,
    )


def profile_counts(spec: DatasetSpec) -> list[Column]:
    """The profile of typed rows as aggregates: states, malformed lines, unreadable values of each conversion."""
    return state_counts(
        [
            F.count(RAW_LINE).alias("malformed"),
            *(
                F.coalesce(F.sum(ones(F.substring(UNREAD, i + 1, 1) == "1")), F.lit(0)).cast("bigint").alias(f"unread_{c}")
                for i, c in enumerate(spec.conversions)
            ),
        ]
    )


@dataclass(frozen=True)
class Loaded:
    """One ingested dataset: ``rows`` for analysis, ``malformed`` raw lines, ``profile`` counts."""

    rows: DataFrame
    malformed: DataFrame
    profile: dict[str, int]

    def profile_table(self) -> DataFrame:
        """The profile as a table: measure, rows."""
        return self.rows.sparkSession.createDataFrame(list(self.profile.items()), "measure string, rows long")


def load_csv(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec,
    *,
    stage: str | None = None,
    strict_header: bool = False,
) -> Loaded:
    """Parse the CSV once into a columnar table and read everything else from that table.

    ``stage`` is where the table goes; by default a new path in the shared folder. Analyses then
    read only the columns they use, and a lost executor costs no second parse.

    The files are read line by line, in splits, and each line is parsed as a row. Where the table then
    shows lines with an odd number of quotes, records may go over several lines: these files, told by the
    table, are read once more and their records put together; the rows of the others are taken from the
    table. With ``breaks=()`` no record can, and such lines are malformed as they stand.
    ``strict_header`` costs another read.
    """
    require_paths(spark, [path])
    if strict_header and spec.has_header:
        check_headers(spark, path, spec)
    target = stage or scratch_path(spark, spec.name)
    observation = Observation(f"{spec.name} lines")
    table = typed_rows(read_lines(spark, path, spec), spec, (FILE, ODD))
    with compiled_methods(spark):
        observed = table.observe(observation, *profile_counts(spec), F.coalesce(F.sum(ODD), F.lit(0)).alias(ODD))
        observed.write.mode("overwrite").parquet(target)
    profile = dict(observation.get)
    if profile.pop(ODD) and (spec.breaks is None or spec.breaks):
        staged = spark.read.schema(table.schema).parquet(target)
        target = scratch_path(spark, spec.name)
        profile = rewrite(spark, path, spec, staged, target)
        if stage:
            move(spark, target, stage)
            target = stage
    return staged_rows(spark, target, profile)


def staged_rows(spark: SparkSession, stage: str, profile: dict[str, int]) -> Loaded:
    """A dataset from the table it was staged to, with the profile taken then."""
    staged = spark.read.parquet(stage)
    return Loaded(
        rows=staged.filter(F.col(ROW_STATE) == KEPT).drop(*NOT_ROWS),
        malformed=staged.filter(F.col(RAW_LINE).isNotNull()).drop(UNREAD, FILE, ODD),
        profile=profile,
    )


def rewrite(spark: SparkSession, path: str, spec: DatasetSpec, staged: DataFrame, stage: str) -> dict[str, int]:
    """Write the table anew, with the records of the files that have lines with an odd number of quotes."""
    opened = few_or_table(staged.filter(F.col(ODD) == 1).select(FILE).distinct())
    found = records(
        spark, path, opened, spec.headers, spec.breaks, RAW_LINE, has_header=spec.has_header, parse=parser(spec)
    )
    found = found.select("*", F.lit(None).cast("string").alias(FILE), F.lit(0).alias(ODD))
    closed = of_files(staged, FILE, opened, kept=False)
    observation = Observation(f"{spec.name} records")
    table = closed.unionAll(typed_rows(found, spec, (FILE, ODD)))
    with compiled_methods(spark):
        table.observe(observation, *profile_counts(spec)).write.mode("overwrite").parquet(stage)
    return dict(observation.get)
