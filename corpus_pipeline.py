"""A training corpus from ``documents``: quality rules, near-duplicates, source mix, tokens.

Every stage works on all rows of the one before and returns the columns of ``documents``, the last one
ids and digests; other columns, whatever they are called, go. An empty table passes as one.

- quality_rules: null, empty and very short texts fail the rule of fewest words and go, however
  often a row is repeated.
- near_duplicates: equal rows, and rows of one group, are reduced to the one with the smallest id;
  null ids come last, and rows without words stay. Of rows that tie in id and words any one stays.
- source_mix: a null source is a source of its own. Repeated rows are separate documents. Rows
  without words have no size and are not taken.
- bpe: a null text is an empty one, without tokens.

Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from triplewright.llm import bpe, mixing, near_dups, quality
from triplewright.llm.queries import BPE_PATTERN, BPE_RANKS
from triplewright.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Words of a shingle in the near-duplicate stage.
STAGE_WORDS = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the current quality policy."""
    judged = quality.apply_policy(quality.ledger(docs.select(*COLUMNS), keep_text=True))
    return judged.filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return near_dups.keep_one(docs.select(*COLUMNS), size=STAGE_WORDS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_rows(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of ids and decoded bytes."""
    return bpe.round_trip(docs.select("doc_id", "source", "text"), BPE_RANKS, BPE_PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("bpe", encode),
]

# Near-duplicate classes and tokenization are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
