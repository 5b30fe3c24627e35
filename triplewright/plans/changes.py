"""What a new version of the dumps changes, and which rows of the attribute tables follow from it.

Every subject of a stored dump has an order-free digest of its triples. Subjects whose digests differ
between two versions were added, changed or removed; only attributes that depend on them are
derived again. Digests are compared by one partially aggregated ``groupBy``; triples are
read only for the subjects concerned.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplewright.operators.facts import links
from triplewright.operators.skew import existence_join
from triplewright.operators.stored import Triples
from triplewright.plans import company


def changed_subjects(old: DataFrame, new: DataFrame) -> DataFrame:
    """(sub): subjects whose digests (sub, n, digest) are not the same in both versions."""
    both = old.select("sub", "n", "digest").union(new.select("sub", "n", "digest"))
    return both.groupBy("sub", "n", "digest").agg(F.count("*").alias("sides")).filter(F.col("sides") == 1).select("sub").distinct()


def subject_digests_of(spark: SparkSession, version: str) -> DataFrame:
    """The stored digests of a version's subjects."""
    return spark.read.schema("sub string, n long, digest decimal(38,0)").parquet(f"{version}/subjects")


def _linked_to(triples: Triples, preds: Iterable[str], targets: DataFrame) -> DataFrame:
    """(sub): subjects with a link to one of the targets (sub)."""
    found = links(triples, preds, target="target")
    return existence_join(found, targets.select(F.col("sub").alias("target")), "target", "left_semi").select("sub")


def companies_by_link(organization: Triples, changed: DataFrame, preds: Iterable[str], changed_targets: DataFrame) -> DataFrame:
    """(sub): companies that changed, or link to something that did.

    A company whose link appeared or vanished has changed itself, so links are looked up in the new version only.
    """
    return changed.union(_linked_to(organization, preds, changed_targets)).distinct()


def companies_by_person(old: Triples, new: Triples, changed: DataFrame) -> DataFrame:
    """(sub): companies with a position that changed, or whose person did.

    Changed holders count with their positions in both versions. A person's holders are those of
    the new version: where they are others than before, the holder has changed itself.
    """
    own = changed.select(F.col("sub").alias("h"))
    of_persons = _linked_to(new, [company.HOLDER], changed).select(F.col("sub").alias("h"))
    holders = own.union(of_persons).distinct()
    found = [
        existence_join(links(triples, company.POSITIONS, key="h", target="sub"), holders, "h", "left_semi").select("sub")
        for triples in (old, new)
    ]
    return found[0].union(found[1]).distinct()
