"""Predicate statistics over raw N-Triples dumps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplewright.functions.text import regex_group, triple_pattern, without_ends
from triplewright.sources.triples import read_lines, read_predicate_counts


def _count_predicates(lines: DataFrame, base: str, *by: str) -> DataFrame:
    # The bracketed group is empty only where the pattern does not match, so one evaluation
    # of the pattern decides both; unmatched lines form one group that counts zero.
    return (
        lines.filter(F.col("value").contains(f"<{base}"))
        .select(*by, regex_group(F.col("value"), triple_pattern(base), 2).alias("iri"))
        .groupBy(*by, "iri")
        .agg(F.count(F.nullif("iri", F.lit(""))).alias("n"))
        .filter(F.col("n") > 0)
        .select(*by, without_ends(F.col("iri")).alias("pred"), "n")
    )


def predicate_stats(spark: SparkSession, base: str, *paths: str) -> DataFrame:
    """(pred, n): triples per full predicate IRI over lines with a subject under ``base``."""
    return _count_predicates(read_lines(spark, *paths), base)


def predicate_stats_by_dump(spark: SparkSession, base: str, dumps: dict[str, str]) -> DataFrame:
    """(source, pred, n): the same for several dumps (name -> path) at once."""
    lines = [read_lines(spark, path).select("value", F.lit(name).alias("source")) for name, path in dumps.items()]
    return _count_predicates(reduce(DataFrame.union, lines), base, "source")


def stored_predicate_stats(spark: SparkSession, base: str, dumps: dict[str, str]) -> DataFrame:
    """(source, pred, n) of several stored dumps (name -> path), from the counts made while they were stored for ``base``.

    The same as :func:`predicate_stats_by_dump` over their text, without reading it again.
    """
    counts = [
        read_predicate_counts(spark, path).filter(F.col("base") == base).select(F.lit(name).alias("source"), "pred", "n")
        for name, path in dumps.items()
    ]
    return reduce(DataFrame.union, counts)


def predicate_count(triples: DataFrame) -> DataFrame:
    """(pred, n): triples per predicate of a parsed frame."""
    return triples.groupBy("pred").agg(F.count("*").alias("n"))
