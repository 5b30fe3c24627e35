"""The whole job over stored dumps, and properties of its tables."""

from dataclasses import replace

import pytest

from triplewright_checks.fixtures import BASE, Fixtures
from triplewright_checks.oracle import ORACLE
from triplewright_checks.queries import LISTED_COUNTRIES
from tests.compare import database, differences
from triplewright import session
from triplewright.operators.facts import facts
from triplewright.plans import company, extract, person, pipeline
from triplewright.sources.triples import read_triples

SF_DIR = "/root/testdata/sf0.001"


def choices(spark):
    return pipeline.Choices(family_exclusions=Fixtures(spark, SF_DIR).blocklist())


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    fixtures = Fixtures(spark, SF_DIR)
    for name in ("organization", "quote", "industry", "person"):
        lines = spark.read.text(fixtures.write_lines(getattr(fixtures, name)()))
        lines.write.text(f"{root}/dumps/{name}")
    for name in ("assetClass", "currency"):
        spark.createDataFrame([("<a/1> <b#label> x .",)], "value string").write.text(f"{root}/dumps/{name}")
    for name, mapping in (
        ("exchange_map", fixtures.exchange_map()),
        ("industry_map", fixtures.industry_map()),
        ("country_map", fixtures.geo_map()),
    ):
        spark.read.text(fixtures.write_mapping(mapping)).write.text(f"{root}/mappings/{name}")
    paths = pipeline.JobPaths(
        f"{root}/dumps", f"{root}/mappings", f"{root}/triples", f"{root}/rejects", "company_", "person_"
    )
    counts = pipeline.ingest(spark, paths)
    assert {name: c["rejected"] for name, c in counts.items()} == dict.fromkeys(pipeline.DUMPS, 0)
    tables = pipeline.derive(spark, paths, f"{root}/tables", choices(spark))
    return paths, tables, f"{root}/tables"


ORACLES = {
    "company_exchange": "company_exchange",
    "company_conflict_name": "company_name_conflict",
    "company_name": "company_name",
    "company_address": "company_address",
    "company_country": "company_country_all",
    "company_industry": "company_industry",
    "company_url": "company_url",
    "person_givenname": "person_given_name",
    "person_familyname": "person_family_name",
    "company_employee": "company_employee",
}


def test_tables_match_the_oracles(spark, job):
    _, tables, _ = job
    connection = database(SF_DIR)
    assert set(tables) == set(ORACLES)
    for table, oracle in ORACLES.items():
        assert differences(spark.read.table(table), connection, ORACLE[oracle]) == [], table


@pytest.mark.parametrize("name, options", [
    ("listed_company_graph", {}),
    ("listed_company_graph_by_country", {"countries": LISTED_COUNTRIES, "with_country": False}),
])
def test_extracts_match_the_oracles(spark, job, name, options):
    paths, _, location = job
    table = pipeline.save_extract(spark, paths, name, location=location, **options)
    assert differences(spark.read.table(table), database(SF_DIR), ORACLE[name]) == []


def test_predicate_reports(spark, job, tmp_path):
    paths, _, _ = job
    pipeline.report_predicates(spark, paths, BASE, str(tmp_path / "reports"))
    report = spark.read.csv(str(tmp_path / "reports/source=quote"), sep="\t", header=True)
    assert report.count() == 2


def test_intermediate_files_are_deleted(spark, job, tmp_path, monkeypatch):
    paths, _, _ = job
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path / "scratch"))
    pipeline.derive(spark, replace(paths, company="s_company_", person="s_person_"), f"{tmp_path}/t", choices(spark))
    assert (tmp_path / "scratch").exists() and list((tmp_path / "scratch").iterdir()) == []


def test_job_can_be_repeated(spark, job):
    paths, tables, location = job
    before = {t: spark.read.table(t).count() for t in tables}
    pipeline.derive(spark, paths, location, choices(spark))
    assert {t: spark.read.table(t).count() for t in tables} == before


def test_copies_of_lines_change_nothing(spark, job, tmp_path):
    paths, tables, _ = job
    for name in pipeline.DUMPS:
        lines = spark.read.text(f"{paths.dumps}/{name}")
        lines.union(lines).union(lines).write.text(f"{tmp_path}/dumps/{name}")
    copies = replace(
        paths, dumps=f"{tmp_path}/dumps", triples=f"{tmp_path}/triples", company="c3_company_", person="c3_person_"
    )
    pipeline.ingest(spark, copies)
    pipeline.derive(spark, copies, f"{tmp_path}/tables", choices(spark))
    for table in tables:
        once, thrice = spark.read.table(table), spark.read.table(f"c3_{table}")
        assert once.exceptAll(thrice).isEmpty() and thrice.exceptAll(once).isEmpty(), table


def subjects(df):
    return {r["sub"] for r in df.select("sub").distinct().collect()}


def test_names_are_split_completely(spark, job):
    paths, _, _ = job
    organization = read_triples(spark, f"{paths.triples}/organization")
    unique, conflict = subjects(spark.read.table("company_name")), subjects(spark.read.table("company_conflict_name"))
    assert unique.isdisjoint(conflict)
    assert unique | conflict == subjects(facts(organization, company.NAME))


def test_countries_from_addresses_fill_gaps_only(spark, job):
    paths, _, _ = job
    organization = read_triples(spark, f"{paths.triples}/organization")
    filled = subjects(facts(spark.read.table("company_country"), "isDomiciledInFromAddress"))
    assert filled
    assert filled.isdisjoint(subjects(facts(organization, company.DOMICILE)))


def test_extract_from_inputs_equals_extract_from_tables(spark, job):
    paths, _, _ = job
    organization, people = (read_triples(spark, f"{paths.triples}/{n}") for n in ("organization", "person"))
    listed = extract.listed_companies(
        spark.read.table("company_exchange"), spark.read.table("company_country"), ["ASIA", "EUROPE"]
    )
    family, given = spark.read.table("person_familyname"), spark.read.table("person_givenname")
    own = extract.restrict(organization, listed)
    from_inputs = extract.graph(
        company.company_name(own),
        company.company_url(own),
        company.company_employee(people, family, given, listed),
    )
    tables = [spark.read.table(f"company_{t}") for t in ("name", "url", "employee")]
    from_tables = extract.restrict(extract.graph(*tables), listed)
    assert from_inputs.exceptAll(from_tables).count() == 0
    assert from_tables.exceptAll(from_inputs).count() == 0
    assert from_tables.count() > 0


def test_excluded_person_names(spark):
    rows = [
        ("1-34413176823", "family-name", '"OBrien"'),
        ("1-34413176823", "family-name", "\"O'Brien\""),
        ("1-34424198806", "family-name", '"Eric"'),
        ("1-34424198806", "given-name", '"Eric"'),
        ("1-34424198806", "given-name", '"Erik"'),
    ]
    people = spark.createDataFrame(rows, "sub string, pred string, obj string")
    family, given = person.person_family_name(people), person.person_given_name(people)
    assert {r["obj"] for r in family.collect()} == {"O'Brien", "Eric"}
    assert {r["obj"] for r in given.collect()} == {"Erik"}


def test_equal_cleaned_names_still_conflict(spark):
    rows = [("1", company.NAME, '"A, B"'), ("1", company.NAME, '"A  B"'), ("2", company.NAME, '"A"')] * 2
    organization = spark.createDataFrame(rows, "sub string, pred string, obj string")
    assert {(r["sub"], r["origin"], r["obj"]) for r in company.company_name_conflict(organization).collect()} == {
        ("1", "A, B", "A B"),
        ("1", "A  B", "A B"),
    }
    assert [tuple(r) for r in company.company_name(organization).collect()] == [("2", company.NAME, "A", "A")]


def test_longest_address_is_measured_after_cleaning(spark):
    raw = [("1", '"ab     c"'), ("1", '"abc d"'), ("1", '"abcd"'), ("1", '"ab c"')]
    organization = spark.createDataFrame([(s, company.ADDRESS, o) for s, o in raw], "sub string, pred string, obj string")
    assert {r["obj"] for r in company.company_address(organization).collect()} == {"abc d"}
