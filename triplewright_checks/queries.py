"""One query per operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplewright_checks.fixtures import BASE, Fixtures
from triplewright.functions import text
from triplewright.operators import resolve
from triplewright.operators.facts import as_facts, facts, links, literals, with_object
from triplewright.operators.skew import existence_join, lookup_join, skew_join
from triplewright.operators.stored import StoredTriples
from triplewright.plans import changes, company, etl, extract, person, stats
from triplewright.session import remove_folder, scratch_path
from triplewright.sources import mappings, sinks, triples, versions
from triplewright.sources.clustered import cluster_by_subject

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STEPS_PER_FLOOR = 21
LISTED_COUNTRIES = ["AMERICA", "EUROPE"]
LISTED_COMPANIES = 40


def query(function: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    """Register ``function`` under its own name."""
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Fixtures(spark, sf_dir))
    return function


# Inputs shared by several queries.


def names(fx: Fixtures) -> DataFrame:
    return facts(fx.organization(), company.NAME).select("sub", "obj")


def plain_names(fx: Fixtures) -> DataFrame:
    return literals(fx.organization(), company.NAME)


def addresses(fx: Fixtures) -> DataFrame:
    return literals(fx.organization(), company.ADDRESS)


def hosts(fx: Fixtures) -> DataFrame:
    return with_object(facts(fx.organization(), company.URL), text.url_host)


def sectors(fx: Fixtures) -> DataFrame:
    return links(fx.organization(), company.SECTORS)


def family_name(fx: Fixtures) -> DataFrame:
    return person.person_family_name(fx.person(), fx.blocklist())


def given_name(fx: Fixtures) -> DataFrame:
    return person.person_given_name(fx.person())


# Scans and sources


@query
def scan_lines(fx):
    return triples.read_lines(fx.spark, fx.write_lines(fx.triples()))


@query
def parse_triples(fx):
    return triples.parse_triples(triples.read_lines(fx.spark, fx.write_lines(fx.triples())))


@query
def scan_map2(fx):
    return mappings.read_code_mapping(fx.spark, fx.write_mapping(fx.exchange_map()))


@query
def scan_map3(fx):
    return mappings.read_country_mapping(fx.spark, fx.write_mapping(fx.geo_map()))


@query
def scan_table(fx):
    table = _table("quote")
    sinks.save_table(fx.quote(), table, scratch_path(fx.spark, table))
    return facts(fx.spark.read.table(table), company.TICKER)


@query
def scan_parquet(fx):
    return fx.table("customer")


@query
def scan_nt_regex(fx):
    return triples.read_matching_lines(fx.spark, BASE + "1-", fx.write_lines(fx.triples()))


@query
def ingest_triples(fx):
    target = scratch_path(fx.spark, "triples")
    dumps = {"organization": fx.organization(), "quote": fx.quote(), "industry": fx.industry(), "person": fx.person()}
    triples.ingest_triples(fx.spark, {name: fx.write_lines(df, name) for name, df in dumps.items()}, target)
    stored = [triples.read_triples(fx.spark, f"{target}/{name}") for name in dumps]
    return extract.graph(*stored)


@query
def ingest_new_version(fx):
    """A dump is stored in part, then as a whole: the newer version is read, rejected lines and older rows are not."""
    root, spark = scratch_path(fx.spark, "triples"), fx.spark
    dump = fx.write_lines(fx.organization())
    whole = triples.read_lines(spark, dump)
    odd = whole.select(F.when(F.contains("value", F.lit("isDomiciledIn")), F.replace("value", F.lit(" "), F.lit("_"))).otherwise(F.col("value")).alias("value"))
    for path in (fx.write_text(odd), dump):
        triples.ingest_triples(spark, {"organization": path}, root)
        remove_folder(spark, path)
    return triples.read_triples(spark, f"{root}/organization")


def _stored(fx: Fixtures, *names: str) -> dict[str, StoredTriples]:
    """Some dumps, ingested and opened with the sketches of their keys."""
    target = scratch_path(fx.spark, "triples")
    dumps = {name: fx.write_lines(getattr(fx, name)(), name) for name in names}
    triples.ingest_triples(fx.spark, dumps, target)
    return {name: triples.open_triples(fx.spark, f"{target}/{name}") for name in names}


# Sinks


def _table(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


@query
def sink_table_overwrite(fx):
    table = _table("url")
    path = scratch_path(fx.spark, table)
    sinks.save_table(facts(fx.organization(), company.URL), table, path)
    sinks.save_table(company.company_url(fx.organization()), table, path)
    return fx.spark.read.table(table)


@query
def sink_table_append(fx):
    """Every run is done twice: what it wrote before is replaced."""
    table = _table("country")
    path = scratch_path(fx.spark, table)
    added = company.company_country_from_address(fx.organization(), fx.geo_map())
    for _ in range(2):
        sinks.append_table(company.company_country(fx.organization(), fx.geo_map()), table, path, "registered")
        sinks.append_table(added.select("origin", "obj", "pred", "sub"), table, path, "from address")
    return fx.spark.read.table(table).drop("run")


@query
def sink_csv(fx):
    path = scratch_path(fx.spark, "csv")
    customer = fx.table("customer")
    sinks.write_csv(customer, path)
    return fx.spark.read.schema(customer.schema).csv(path, header=True)


@query
def sink_parquet(fx):
    path, customer = scratch_path(fx.spark, "parquet"), fx.table("customer")
    sinks.write_parquet(customer.filter("c_custkey % 2 = 0"), path)
    sinks.write_parquet(customer, path)
    return fx.spark.read.parquet(path)


@query
def sink_stats_tsv(fx):
    path = scratch_path(fx.spark, "stats")
    sinks.write_predicate_report(stats.predicate_stats(fx.spark, BASE, fx.write_lines(fx.triples())), path)
    report = fx.spark.read.csv(path, sep="\t", header=True, schema="`Predicate` string, `# triple` long")
    return report.select(F.col("Predicate").alias("pred"), F.col("# triple").alias("n"))


# Scalar functions


@query
def literal_value(fx):
    return with_object(facts(fx.organization(), company.ADDRESS), text.literal_value)


@query
def iri_id(fx):
    return with_object(facts(fx.organization(), company.PRIMARY_QUOTE, *company.SECTORS), text.iri_id)


@query
def ascii_fold(fx):
    return with_object(names(fx), text.ascii_fold)


@query
def clean_name(fx):
    return with_object(plain_names(fx), text.clean_name)


@query
def clean_address(fx):
    return with_object(addresses(fx), text.clean_address)


@query
def address_country(fx):
    return with_object(addresses(fx), text.address_country)


@query
def url_host(fx):
    return hosts(fx)


@query
def url_host_strict(fx):
    return with_object(facts(fx.organization(), company.URL), lambda x: text.url_host(x, strict=True))


@query
def trim_space(fx):
    return with_object(plain_names(fx), F.trim)


@query
def collapse_ws(fx):
    return with_object(plain_names(fx), text.collapse_ws)


@query
def strip_apostrophe(fx):
    return with_object(plain_names(fx), text.strip_apostrophe)


@query
def str_length(fx):
    return hosts(fx).withColumn("len", F.length("obj").cast("long"))


@query
def concat_sep(fx):
    pair = F.concat_ws("$", "sub", "obj").alias("joined")
    return literals(fx.quote(), company.TICKER).select("sub", "obj", pair)


@query
def const_pred(fx):
    return as_facts(plain_names(fx), "hasName")


@query
def project_rename(fx):
    return sectors(fx).select(F.col("sub").alias("company"), F.col("obj").alias("ind"))


@query
def multiply_const(fx):
    return fx.employees().select("id", (F.col("floor") * F.lit(STEPS_PER_FLOOR)).alias("steps"))


@query
def regex_group(fx):
    lines = triples.read_matching_lines(fx.spark, BASE, fx.write_lines(fx.triples()))
    # The whole line is searched once; its head is short.
    heads = lines.select(text.regex_group(F.col("value"), text.triple_head_pattern(BASE), 1).alias("head"))
    subject, predicate = (text.regex_group(F.col("head"), text.HEAD_PARTS, i) for i in (1, 2))
    return heads.select(subject.alias("subject"), text.without_ends(predicate).alias("pred"))


# Filters


@query
def filter_pred_eq(fx):
    return facts(fx.organization(), company.ADDRESS)


@query
def filter_pred_any(fx):
    return facts(fx.organization(), *company.SECTORS)


@query
def filter_not_empty(fx):
    return fx.geo_map().filter(F.col("new") != "")


@query
def filter_count(fx):
    return resolve.with_key_count(plain_names(fx), "sub").filter(F.col("n") == 1)


@query
def filter_and(fx):
    counted = resolve.with_key_count(_mapped_industry(fx), "sub")
    return counted.filter((F.col("n") > 1) & (F.col("obj") == company.PREFERRED_INDUSTRY))


@query
def filter_rank1(fx):
    ranked = resolve.rank_longest(addresses(fx), "sub", "obj")
    return ranked.filter(F.col("rank") == 1)


@query
def exclude_pairs(fx):
    return resolve.drop_pairs(literals(fx.person(), "family-name"), fx.blocklist())


# Joins


def _mapped_industry(fx: Fixtures) -> DataFrame:
    labels = lookup_join(
        literals(fx.industry(), "label", key="ind", value="origin"), fx.industry_map(), "origin"
    )
    mapped = lookup_join(links(fx.organization(), company.SECTORS, target="ind"), labels, "ind")
    return mapped.select("sub", "origin", F.col("new").alias("obj")).dropDuplicates()


@query
def join_map(fx):
    exchange_map = mappings.read_code_mapping(fx.spark, fx.write_mapping(fx.exchange_map()))
    codes = literals(fx.quote(), company.EXCHANGE_CODE, value="origin")
    return lookup_join(codes, exchange_map, "origin").select("sub", "origin", "new")


@query
def join_entity(fx):
    holder = links(fx.person(), [company.HOLDER], key="h", target="p").dropDuplicates()
    position = links(fx.person(), company.POSITIONS, key="h", target="sub").dropDuplicates()
    return skew_join(position, holder, "h").select("h", "sub", "p")


@query
def join_two_attrs(fx):
    family = literals(fx.person(), "family-name", key="p", value="family").dropDuplicates()
    given = literals(fx.person(), "given-name", key="p", value="given").dropDuplicates()
    holder = links(fx.person(), [company.HOLDER], key="h", target="p").dropDuplicates()
    return skew_join(skew_join(holder, family, "p"), given, "p").select("h", "p", "family", "given")


@query
def join_back_count(fx):
    return resolve.with_key_count(hosts(fx), "sub")


@query
def join_anti(fx):
    organization = fx.organization()
    address = facts(organization, company.ADDRESS).select("sub", "obj")
    return existence_join(address, facts(organization, company.DOMICILE), "sub", "left_anti")


@query
def join_anti_filtered(fx):
    """The same as for a long list: a Bloom filter, and a shuffle of what passes it."""
    organization = fx.organization()
    address = facts(organization, company.ADDRESS).select("sub", "obj")
    return existence_join(address, facts(organization, company.DOMICILE), "sub", "left_anti", limit=0)


@query
def join_semi_filtered(fx):
    position = links(fx.person(), company.POSITIONS)
    urls = facts(fx.organization(), company.URL).select(F.col("sub").alias("obj"))
    return existence_join(position, urls, "obj", "left_semi", limit=0)


# Aggregation and distinct


@query
def count_by_key(fx):
    return resolve.count_by_key(fx.organization(), "sub")


@query
def count_distinct_values(fx):
    return resolve.count_distinct_values(fx.organization(), "sub", "obj")


@query
def distinct_rows(fx):
    return sectors(fx).dropDuplicates()


@query
def predicate_count(fx):
    return stats.predicate_count(fx.triples())


# Windows and set operations


@query
def rank_longest(fx):
    return resolve.rank_longest(hosts(fx), "sub", "obj")


@query
def top1_per_key(fx):
    return resolve.longest_per_key(hosts(fx), "sub", "obj")


@query
def union_by_name(fx):
    registered = company.company_country(fx.organization(), fx.geo_map())
    read_off = company.company_country_from_address(fx.organization(), fx.geo_map())
    return registered.select("obj", "sub", "pred", "origin").unionByName(read_off)


# Composite pipelines


@query
def company_exchange(fx):
    exchange_map = mappings.read_code_mapping(fx.spark, fx.write_mapping(fx.exchange_map()))
    return company.company_exchange(fx.organization(), fx.quote(), exchange_map)


@query
def company_name(fx):
    return company.company_name(fx.organization())


@query
def company_name_conflict(fx):
    return company.company_name_conflict(fx.organization())


@query
def company_address(fx):
    return company.company_address(fx.organization())


def _country_map(fx: Fixtures) -> DataFrame:
    return mappings.read_country_mapping(fx.spark, fx.write_mapping(fx.geo_map()))


@query
def company_country(fx):
    return company.company_country(fx.organization(), _country_map(fx))


@query
def company_country_from_address(fx):
    return company.company_country_from_address(fx.organization(), _country_map(fx))


@query
def company_country_all(fx):
    return company.company_country_all(fx.organization(), _country_map(fx))


@query
def company_industry(fx):
    industry_map = mappings.read_code_mapping(fx.spark, fx.write_mapping(fx.industry_map()))
    return company.company_industry(fx.organization(), fx.industry(), industry_map)


@query
def company_url(fx):
    return company.company_url(fx.organization())


@query
def person_family_name(fx):
    return family_name(fx)


@query
def person_given_name(fx):
    return given_name(fx)


@query
def company_employee(fx):
    return company.company_employee(fx.person(), family_name(fx), given_name(fx))


@query
def predicate_stats(fx):
    return stats.predicate_stats(fx.spark, BASE, fx.write_lines(fx.triples()))


@query
def predicate_stats_by_dump(fx):
    dumps = {"organization": fx.organization(), "quote": fx.quote(), "person": fx.person()}
    paths = {name: fx.write_lines(df, name) for name, df in dumps.items()}
    return stats.predicate_stats_by_dump(fx.spark, BASE, paths)


@query
def stored_predicate_stats(fx):
    """Counts made while the dumps are stored, for two nested bases."""
    target = scratch_path(fx.spark, "triples")
    dumps = {"organization": fx.organization(), "quote": fx.quote(), "person": fx.person()}
    paths = {name: fx.write_lines(df, name) for name, df in dumps.items()}
    triples.ingest_triples(fx.spark, paths, target, bases=[BASE, BASE + "1-"])
    return stats.stored_predicate_stats(fx.spark, BASE, {name: f"{target}/{name}" for name in dumps})


def _laid_out(fx: Fixtures, pred: str) -> StoredTriples:
    """Organizations, ingested, with one predicate laid out by subject."""
    target = scratch_path(fx.spark, "triples")
    triples.ingest_triples(fx.spark, {"organization": fx.write_lines(fx.organization())}, target)
    root, database = f"{target}/organization", _table("by_subject")
    fx.spark.sql(f"CREATE DATABASE {database}")
    return cluster_by_subject(fx.spark, triples.open_triples(fx.spark, root), [pred], database, root)


@query
def company_name_by_subject(fx):
    return company.company_name(_laid_out(fx, company.NAME))


@query
def company_address_by_subject(fx):
    return company.company_address(_laid_out(fx, company.ADDRESS))


@query
def company_url_by_subject(fx):
    return company.company_url(_laid_out(fx, company.URL))


@query
def employee_steps(fx):
    return etl.employee_steps(fx.employees(), STEPS_PER_FLOOR)


def _listed_graph(fx: Fixtures, **options) -> DataFrame:
    return extract.listed_company_graph(
        fx.organization(),
        fx.quote(),
        fx.person(),
        family_name(fx),
        given_name(fx),
        fx.exchange_map(),
        fx.geo_map(),
        **options,
    )


@query
def listed_company_graph(fx):
    return _listed_graph(fx)


@query
def listed_company_graph_by_country(fx):
    return _listed_graph(fx, countries=LISTED_COUNTRIES, with_country=False)


@query
def listed_company_graph_by_size(fx):
    return _listed_graph(fx, n_companies=LISTED_COMPANIES)


@query
def listed_company_graph_stored(fx):
    """Over stored triples, whose sketches tell the hot keys."""
    stored = _stored(fx, "organization", "quote", "person")
    names = [
        person.person_family_name(stored["person"], fx.blocklist()),
        person.person_given_name(stored["person"]),
    ]
    return extract.listed_company_graph(*stored.values(), *names, fx.exchange_map(), fx.geo_map())


# Changes


def _two_versions(fx: Fixtures) -> tuple[StoredTriples, StoredTriples, DataFrame]:
    """Organizations as they were and as they are, and the subjects that differ."""
    root, spark = scratch_path(fx.spark, "triples"), fx.spark
    new = fx.organization()
    number = F.substring("sub", F.lit(3), F.length("sub")).cast("long")
    # Some companies are missing, some have a triple less, some have other objects.
    old = new.filter((number % 6 != 0) & ((number % 7 != 0) | (F.col("pred") != company.DOMICILE))).withColumn(
        "obj", F.when((number % 10 == 3) & (F.col("pred") == company.ADDRESS), F.lit('"elsewhere\\nNATION_3\\n"')).otherwise(F.col("obj"))
    )
    for version in (old, new):
        triples.ingest_triples(spark, {"organization": fx.write_lines(version)}, root)
    before, after = versions.published(spark, f"{root}/organization")
    digests = [changes.subject_digests_of(spark, version.path) for version in (before, after)]
    opened = [triples.open_version(spark, version.path) for version in (before, after)]
    return *opened, changes.changed_subjects(*digests)


@query
def changed_subjects(fx):
    return _two_versions(fx)[2]


@query
def company_address_changes(fx):
    """Addresses of the older version, with those of changed companies derived again."""
    old, new, changed = _two_versions(fx)
    kept = existence_join(company.company_address(old), changed, "sub", "left_anti")
    return kept.unionByName(company.company_address(extract.restrict(new, changed)))
