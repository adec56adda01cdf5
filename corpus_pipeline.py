"""A corpus pipeline: language ID, exact dedup, near dedup, mixing to target weights, BPE encoding.

Every stage takes (spark, docs, sf_dir), works on all rows that the one before it kept, and returns a DataFrame,
which is written as Parquet and read again as the next stage's docs. All but the last return the columns of
`documents`, further columns too. An empty table stays empty in every stage. For nulls, empty texts and repeated rows:

* language_id: null, empty and letterless texts are rejected; repeated rows are judged alike, a null id is no matter.
* exact_dedup: a null text equals an empty one; of equal texts the largest id stays, null being the smallest; rows that
  repeat an id and its text leave one.
* near_dedup: null and blank texts stay; rows that repeat an id are told apart by their sets; a row without an id stays
  only where no text of its group has one.
* mixing: null and empty texts have no tokens, and leaves without tokens are left out; a null language or source is a key
  of its own; a repeated row counts as another row.
* bpe: a null text is the empty one, without ids; every row gives one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, exact_dedup, language_id, mixing, near_dedup
from tidemark.llm._common import materialise, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language compression tells; rejected ones go. The dictionaries come from docs' own labels."""
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased), the row with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked at a similarity of 0.8 over five-word shingles, the row with the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that fill the token budgets of the domain, language and source tree, none twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids array<int>: byte-level BPE token ids of every text."""
    return bpe.encode(docs, bpe.vocabulary_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Compression, MinHash components and BPE can't be put in SQL: tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written to the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
