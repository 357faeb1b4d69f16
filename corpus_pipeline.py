"""A corpus in stages: toxic documents go, one of each group of near duplicates stays, documents
with test items go, sources are mixed to their weights, and token ids are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casebook.llm import decontamination, jaccard_join, mixing, token_files, toxicity
from casebook.llm.common import table
from casebook.llm.queries import TARGETS, vocabulary
from casebook.session import written

#: Text of a token file, and distinct chunks its task holds beside what earlier stages left in the executor.
TOKEN_FILE_BYTES = 20 << 20
TOKEN_PIECES = 200_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents not predicted toxic by a model of the labels table."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the least doc_id."""
    return jaccard_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of the benchmark table."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents repeated to the target weights of their sources, in a global shuffle."""
    return mixing.mixed_documents(docs, TARGETS)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the token files written."""
    path = vocabulary(spark, "byte_bpe_50k.json")
    return token_files.tokenize_to_files(docs, path, file_bytes=TOKEN_FILE_BYTES, tidy=True, kept=TOKEN_PIECES)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near-duplicates", one_of_each),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token-files", tokenized),
]
#: Toxicity is learned and tokens are encoded by a library, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again by the next.

    Rows are judged by their texts, each for itself: a row that goes takes no other of its doc_id with it.
    Rows without words pass all filters; of exact repeats one stays. In the mixture, rows of one doc_id are
    repeated alike. Further columns of documents pass through all stages but the last; an empty table
    gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
