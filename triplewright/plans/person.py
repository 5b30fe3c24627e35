"""Name tables of persons."""

from __future__ import annotations

from pyspark.sql import DataFrame

from triplewright.operators.facts import as_facts, literals
from triplewright.operators.resolve import drop_pairs
from triplewright.operators.stored import Triples, rows_of

# Wrong (person, name) pairs of the public dump, left out of the name tables.
FAMILY_NAME_EXCLUSIONS = [
    ("1-34413176823", "OBrien"),
    ("1-34423120002", "Monin de Flaugergues"),
    ("1-34423753018", "Chan M.P."),
]
GIVEN_NAME_EXCLUSIONS = [
    ("1-34413846240", "Zhi Wei"),
    ("1-34414106636", "Ginny"),
    ("1-34414227643", "Herman"),
    ("1-34424198806", "Eric"),
]


def _names(person: Triples, pred: str, excluded: DataFrame | list[tuple[str, str]]) -> DataFrame:
    names = as_facts(literals(person, pred).dropDuplicates(), pred)
    if isinstance(excluded, list):
        excluded = rows_of(person).sparkSession.createDataFrame(excluded, "sub string, obj string")
    return drop_pairs(names, excluded)


def person_family_name(person: Triples, excluded: DataFrame | list = FAMILY_NAME_EXCLUSIONS) -> DataFrame:
    """Distinct family names without the excluded (sub, obj) pairs: (sub, pred, obj)."""
    return _names(person, "family-name", excluded)


def person_given_name(person: Triples, excluded: DataFrame | list = GIVEN_NAME_EXCLUSIONS) -> DataFrame:
    """Distinct given names without the excluded (sub, obj) pairs: (sub, pred, obj)."""
    return _names(person, "given-name", excluded)
