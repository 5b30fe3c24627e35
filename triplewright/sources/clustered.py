"""Predicates laid out by subject, so that work per subject needs no shuffle.

A predicate's rows are stored as a table that is bucketed and sorted by subject; the rows of its
hot subjects lie in a table of their own, as a bucket cannot be split. Buckets are counted by the
bytes that were summed while the dump was stored. Plans that choose among a subject's values
read both tables apart, see :func:`triplewright.operators.facts.fact_parts`.
"""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplewright.operators.facts import facts
from triplewright.operators.skew import hot_keys, split_hot
from triplewright.operators.stored import StoredTriples, probe
from triplewright.sources import versions

# Text of a bucket, before compression.
BUCKET_BYTES = 256 << 20
MAX_BUCKETS = 100_000


def table_names(database: str, dump: str, pred: str, number: int) -> tuple[str, str]:
    """The tables of one predicate in one version: by subject, and hot subjects."""
    plain = "".join(c if c.isascii() and c.isalnum() else "_" for c in f"{dump}_{pred}").lower()
    return f"{database}.{plain}_by_sub__{number}", f"{database}.{plain}_hot__{number}"


def _n_buckets(triples: StoredTriples, pred: str) -> int:
    size = triples.keys.filter((F.col("pred") == pred) & (F.col("key") == "sub")).agg(F.sum("bytes")).first()[0] or 0
    return min(MAX_BUCKETS, max(1, math.ceil(size / BUCKET_BYTES)))


def cluster_by_subject(
    spark: SparkSession, triples: StoredTriples, preds: list[str], database: str, root: str
) -> StoredTriples:
    """Lay out some predicates of the stored dump in ``root`` by subject; returns the triples with that layout.

    The files belong to the version in force, so they appear and go with it. Repeating
    this for the same version replaces them.
    """
    version = versions.current(spark, root)
    dump = root.rstrip("/").rsplit("/", 1)[1]
    for pred in preds:
        by_subject, hot_table = table_names(database, dump, pred, version.number)
        for table in (by_subject, hot_table):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        rows = facts(triples, pred)
        (hot,) = hot_keys([probe(triples, [pred], "sub")], "sub")
        hot_rows, rest = split_hot(rows, "sub", hot) if hot else (None, rows)
        buckets = _n_buckets(triples, pred)
        folder = f"{version.path}/by_subject/{by_subject.rsplit('.', 1)[1]}"
        (
            rest.repartition(buckets, "sub")
            .write.bucketBy(buckets, "sub")
            .sortBy("sub")
            .mode("overwrite")
            .option("path", folder)
            .saveAsTable(by_subject)
        )
        if hot:
            hot_rows.write.mode("overwrite").option("path", f"{folder}_hot").saveAsTable(hot_table)
    return with_clusters(spark, triples, preds, database, root)


def with_clusters(spark: SparkSession, triples: StoredTriples, preds: list[str], database: str, root: str) -> StoredTriples:
    """The triples with the layouts that :func:`cluster_by_subject` has made of their version."""
    version, dump = versions.current(spark, root), root.rstrip("/").rsplit("/", 1)[1]
    clustered: dict[str, tuple[DataFrame, DataFrame | None]] = {}
    for pred in preds:
        by_subject, hot = table_names(database, dump, pred, version.number)
        if spark.catalog.tableExists(by_subject):
            hot_rows = spark.read.table(hot) if spark.catalog.tableExists(hot) else None
            clustered[pred] = spark.read.table(by_subject), hot_rows
    return replace(triples, clustered=clustered)
