"""Small building blocks on (sub, pred, obj) frames, plain or stored."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplewright.functions.text import iri_id, literal_value
from triplewright.operators.stored import StoredTriples, Triples, rows_of


def facts(triples: Triples, *preds: str) -> DataFrame:
    """Triples of the given predicates: a partition filter on the stored layout."""
    rows = rows_of(triples)
    if len(preds) == 1:
        return rows.filter(F.col("pred") == preds[0])
    return rows.filter(F.col("pred").isin(*preds))


def by_subject(triples: Triples, pred: str) -> tuple[DataFrame, DataFrame | None] | None:
    """Triples of one predicate that is laid out by subject, and those of its hot subjects; None if it isn't."""
    return triples.clustered.get(pred) if isinstance(triples, StoredTriples) else None


def literals(triples: Triples, pred: str, key: str = "sub", value: str = "obj") -> DataFrame:
    """(key, literal value) of one predicate."""
    return facts(triples, pred).select(F.col("sub").alias(key), literal_value(F.col("obj")).alias(value))


def links(triples: Triples, preds: Iterable[str], key: str = "sub", target: str = "obj") -> DataFrame:
    """(key, id of the linked entity) over some predicates."""
    return facts(triples, *preds).select(F.col("sub").alias(key), iri_id(F.col("obj")).alias(target))


def in_steps(df: DataFrame, column: str, *steps: Callable[[Column], Column]) -> DataFrame:
    """Change a column step by step, each in a projection of its own.

    Catalyst keeps a projection apart whose result the next one uses several times, so
    every step is computed once per row.
    """
    for step in steps:
        df = df.withColumn(column, step(F.col(column)))
    return df


def with_object(df: DataFrame, *steps: Callable[[Column], Column]) -> DataFrame:
    """(sub, changed obj)."""
    return in_steps(df.select("sub", "obj"), "obj", *steps)


def as_facts(df: DataFrame, pred: str, *extra: str) -> DataFrame:
    """(sub, pred, obj, ...) with a constant predicate, in the one column order used everywhere."""
    return df.select("sub", F.lit(pred).alias("pred"), "obj", *extra)
