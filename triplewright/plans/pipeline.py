"""The whole job: ingest the dumps, derive and save every attribute table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplewright.operators.skew import existence_join
from triplewright.operators.stored import Triples
from triplewright.plans import changes, company, extract, person
from triplewright.plans.stats import predicate_stats_by_dump, stored_predicate_stats
from triplewright.session import materialize, run_folder
from triplewright.sources import versions
from triplewright.sources.mappings import read_code_mapping, read_country_mapping
from triplewright.sources.sinks import append_table, save_table, write_predicate_reports
from triplewright.sources.triples import ingest_triples, open_version, triples_of_version

# Dump names. The first two are stored but feed no attribute table.
DUMPS = ["assetClass", "currency", "industry", "organization", "person", "quote"]

# The tables in the order in which they are derived, and the dumps that each depends on.
_TABLES = {
    "exchange": ["organization", "quote"],
    "name": ["organization"],
    "conflict_name": ["organization"],
    "address": ["organization"],
    "country": ["organization"],
    "industry": ["organization", "industry"],
    "url": ["organization"],
    "familyname": ["person"],
    "givenname": ["person"],
    "employee": ["person"],
}
_PERSON_TABLES = {"familyname", "givenname"}
_USED = ["organization", "quote", "industry", "person"]

# Tables that make up the extract.
_EXTRACTED = ["exchange", "country", "name", "address", "url", "employee"]


@dataclass(frozen=True)
class JobPaths:
    """Where the job reads and writes.

    dumps:       folder with one text dump (file or folder) per name in ``DUMPS``
    mappings:    folder with exchange_map, country_map and industry_map
    triples:     folder for the stored triples, one sub-folder per dump
    rejects:     folder for unparsable lines
    company:     prefix of the company table names, e.g. ``kg.company_``
    person:      prefix of the person table names
    """

    dumps: str
    mappings: str
    triples: str
    rejects: str
    company: str
    person: str


@dataclass(frozen=True)
class Choices:
    """What the attribute tables leave out or prefer."""

    family_exclusions: DataFrame | list = field(default_factory=lambda: person.FAMILY_NAME_EXCLUSIONS)
    given_exclusions: DataFrame | list = field(default_factory=lambda: person.GIVEN_NAME_EXCLUSIONS)
    sectors: list[str] = field(default_factory=lambda: company.SECTORS)
    preferred_industry: str = company.PREFERRED_INDUSTRY


def ingest(
    spark: SparkSession,
    paths: JobPaths,
    dumps: list[str] = DUMPS,
    database: str | None = None,
    bases: Iterable[str] = (),
) -> dict[str, dict]:
    """Store the dumps as triples, also as views of ``database`` if given; returns the line counts per dump.

    For subjects under ``bases`` triples are counted by predicate on the way.
    """
    places = {d: f"{paths.dumps}/{d}" for d in dumps}
    return ingest_triples(spark, places, paths.triples, paths.rejects, database, bases)


def report_predicates(
    spark: SparkSession, paths: JobPaths, base: str, target: str, dumps: list[str] = DUMPS, stored: bool = False
) -> None:
    """Write one report of triples per predicate for each dump, over subjects under ``base``.

    With ``stored``, from the counts that :func:`ingest` has made for this base, else from the dumps.
    """
    if stored:
        counts = stored_predicate_stats(spark, base, {d: f"{paths.triples}/{d}" for d in dumps})
    else:
        counts = predicate_stats_by_dump(spark, base, {d: f"{paths.dumps}/{d}" for d in dumps})
    write_predicate_reports(counts, target)


def save_extract(
    spark: SparkSession,
    paths: JobPaths,
    table: str,
    countries: Iterable[str] | None = None,
    with_country: bool = True,
    location: str | None = None,
    n_companies: int | None = None,
) -> str:
    """Save the graph of exchange-listed companies, from attribute tables that :func:`derive` has saved."""
    saved = {name: spark.read.table(f"{paths.company}{name}") for name in _EXTRACTED}
    attributes = [saved[name] for name in ("name", "address", "url", "employee")]
    if with_country:
        attributes.append(saved["country"])
    with run_folder(spark):
        listed = extract.listed_companies(saved["exchange"], saved["country"], countries, n_companies)
        listed = materialize(listed, "listed")
        rows = existence_join(extract.graph(*attributes), listed, "sub", "left_semi")
        save_table(rows, table, f"{location}/{table}" if location else None)
    return table


def derive(
    spark: SparkSession,
    paths: JobPaths,
    location: str | None = None,
    choices: Choices | None = None,
    changes_only: bool = False,
) -> list[str]:
    """Derive all attribute tables from stored triples and save them; returns the names of those that were saved.

    ``location`` puts the table files below a folder instead of the warehouse. Name conflicts
    and employees build on saved tables rather than computing them again. Intermediate
    files lie in a folder of the run and are deleted at its end; a cluster without a shared
    folder fails at once.

    ``changes_only`` derives again only what follows from subjects whose triples have changed since
    a table was saved, and leaves tables alone that are up to date. A table is derived as a whole if
    the dumps' version that it came from is gone, or if mappings or choices have changed since.
    """
    with run_folder(spark):
        return _Derivation(spark, paths, location, choices or Choices()).run(changes_only)


# Table properties that tell what a table was derived from.
_FROM = "derived.from."
_SETTINGS = "derived.settings"


class _Derivation:
    """One run over the versions of the dumps that are in force at its start."""

    def __init__(self, spark: SparkSession, paths: JobPaths, location: str | None, choices: Choices) -> None:
        self.spark, self.paths, self.location, self.choices = spark, paths, location, choices
        self.versions = {dump: versions.current(spark, f"{paths.triples}/{dump}") for dump in _USED}
        if missing := [dump for dump, version in self.versions.items() if version is None]:
            raise FileNotFoundError(f"not ingested: {missing}")
        self.triples = {dump: open_version(spark, version.path) for dump, version in self.versions.items()}
        self.exchange_map = read_code_mapping(spark, f"{paths.mappings}/exchange_map")
        self.industry_map = read_code_mapping(spark, f"{paths.mappings}/industry_map")
        self.country_map = read_country_mapping(spark, f"{paths.mappings}/country_map")
        self._changed: dict[tuple[str, int], DataFrame] = {}

    def _at(self, table: str) -> str | None:
        return f"{self.location}/{table}" if self.location else None

    def _settings(self) -> str:
        """A digest of mappings and choices."""
        tables = [self.exchange_map, self.industry_map, self.country_map]
        for excluded in (self.choices.family_exclusions, self.choices.given_exclusions):
            tables.append(excluded if isinstance(excluded, DataFrame) else self.spark.createDataFrame(excluded, "sub string, obj string"))
        sums = [
            df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).select(F.concat_ws(":", "*"))
            for df in tables
        ]
        parts = [row[0] for row in reduce(DataFrame.union, sums).collect()]
        text = "|".join([*parts, *self.choices.sectors, self.choices.preferred_industry])
        return hashlib.sha256(text.encode()).hexdigest()

    # What changed

    def _changed_since(self, dump: str, number: int) -> DataFrame:
        if (dump, number) not in self._changed:
            old = next(v for v in versions.published(self.spark, f"{self.paths.triples}/{dump}") if v.number == number)
            digests = [changes.subject_digests_of(self.spark, v.path) for v in (old, self.versions[dump])]
            self._changed[dump, number] = materialize(changes.changed_subjects(*digests), "changed")
        return self._changed[dump, number]

    def _affected(self, table: str, since: dict[str, int]) -> DataFrame:
        """(sub): the subjects whose rows of a table are derived again."""
        changed = {dump: self._changed_since(dump, number) for dump, number in since.items()}
        if table == "employee":
            path = next(v.path for v in versions.published(self.spark, f"{self.paths.triples}/person") if v.number == since["person"])
            old = triples_of_version(self.spark, path)
            return changes.companies_by_person(old, self.triples["person"], changed["person"])
        if table == "exchange":
            return changes.companies_by_link(self.triples["organization"], changed["organization"], [company.PRIMARY_QUOTE], changed["quote"])
        if table == "industry":
            return changes.companies_by_link(self.triples["organization"], changed["organization"], self.choices.sectors, changed["industry"])
        (own,) = changed.values()
        return own

    # Saving

    def _properties(self, table: str) -> dict[str, str]:
        if not self.spark.catalog.tableExists(table):
            return {}
        return {row["key"]: row["value"] for row in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}

    def _remember(self, table: str, dumps: list[str], settings: str) -> None:
        values = {f"{_FROM}{dump}": str(self.versions[dump].number) for dump in dumps} | {_SETTINGS: settings}
        listed = ", ".join(f"'{key}' = '{value}'" for key, value in values.items())
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")

    def _since(self, table: str, dumps: list[str], settings: str) -> dict[str, int] | None:
        """The versions that a table came from, if its changes since can be told."""
        known = self._properties(table)
        if known.get(_SETTINGS) != settings or any(f"{_FROM}{dump}" not in known for dump in dumps):
            return None
        since = {dump: int(known[f"{_FROM}{dump}"]) for dump in dumps}
        for dump, number in since.items():
            if number not in {v.number for v in versions.published(self.spark, f"{self.paths.triples}/{dump}")}:
                return None
        return since

    def _save(self, table: str, parts: dict[str | None, DataFrame], affected: DataFrame | None) -> None:
        """Replace a table, or its rows about the affected subjects. A part with a predicate is a run of the table."""
        for pred, rows in parts.items():
            if affected is not None:
                old = self.spark.read.table(table)
                own = old if pred is None else old.filter(F.col("pred") == pred)
                kept = existence_join(own.select(*rows.columns), affected, "sub", "left_anti")
                rows = kept.unionByName(rows)
                if pred is not None:
                    rows = materialize(rows, "updated")  # a table's partition can't be read and replaced at once
            if pred is None:
                save_table(rows, table, self._at(table))
            else:
                append_table(rows, table, self._at(table), pred, "pred")

    # Deriving

    def _organization(self, affected: DataFrame | None) -> Triples:
        whole = self.triples["organization"]
        return whole if affected is None else extract.restrict(whole, affected)

    def _person(self, affected: DataFrame | None) -> Triples:
        whole = self.triples["person"]
        return whole if affected is None else extract.restrict(whole, affected)

    def _rows(self, name: str, affected: DataFrame | None) -> dict[str | None, DataFrame]:
        """The rows of a table, or those about the affected subjects, by the run of the table that they are."""
        read, company_, person_ = self.spark.read.table, self.paths.company, self.paths.person
        if name == "employee":
            family, given = read(f"{person_}familyname"), read(f"{person_}givenname")
            return {None: company.company_employee(self.triples["person"], family, given, affected)}
        if name in ("familyname", "givenname"):
            derive_names = {"familyname": person.person_family_name, "givenname": person.person_given_name}[name]
            excluded = {"familyname": self.choices.family_exclusions, "givenname": self.choices.given_exclusions}[name]
            return {None: derive_names(self._person(affected), excluded)}
        own = self._organization(affected)
        if name == "exchange":
            return {None: company.company_exchange(own, self.triples["quote"], self.exchange_map)}
        if name == "industry":
            chosen = self.choices.sectors, self.choices.preferred_industry
            return {None: company.company_industry(own, self.triples["industry"], self.industry_map, *chosen)}
        if name == "country":
            # Two runs of one table, told apart by their predicate, so that either can be repeated.
            return {
                company.COUNTRY: company.company_country(own, self.country_map),
                company.COUNTRY_FROM_ADDRESS: company.company_country_from_address(own, self.country_map),
            }
        if name == "conflict_name":
            return {None: company.company_name_conflict(own, read(f"{company_}name") if affected is None else None)}
        return {None: {"name": company.company_name, "address": company.company_address, "url": company.company_url}[name](own)}

    def run(self, changes_only: bool) -> list[str]:
        settings, saved = self._settings(), []
        for name, dumps in _TABLES.items():
            table = f"{self.paths.person if name in _PERSON_TABLES else self.paths.company}{name}"
            since = self._since(table, dumps, settings) if changes_only else None
            if since == {dump: self.versions[dump].number for dump in dumps}:
                continue
            affected = None if since is None else materialize(self._affected(name, since), "affected")
            self._save(table, self._rows(name, affected), affected)
            self._remember(table, dumps, settings)
            saved.append(table)
        return saved
