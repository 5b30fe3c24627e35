"""spark-submit prepare.py: ingest the dumps, derive all attribute tables, and what is asked for besides."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from triplewright.plans import company, person, pipeline
from triplewright.session import shared_folder


def _pairs(spark: SparkSession, path: str | None, default: list) -> object:
    """(sub, obj) pairs of a tab-separated file, or the default."""
    if path is None:
        return default
    return spark.read.csv(path, sep="\t", schema="sub string, obj string")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--dumps", required=True, help="folder with one text dump per name")
    parser.add_argument("--mappings", required=True, help="folder with exchange_map, country_map, industry_map")
    parser.add_argument("--triples", required=True, help="folder for the stored triples")
    parser.add_argument("--rejects", required=True, help="folder for unparsable lines")
    parser.add_argument("--company", default="company_", help="prefix of the company tables")
    parser.add_argument("--person", default="person_", help="prefix of the person tables")
    parser.add_argument("--location", help="folder for the table files, instead of the warehouse")
    parser.add_argument("--database", help="also store raw triples as tables of this database")
    parser.add_argument("--family-exclusions", help="tab-separated (person, family name) pairs to leave out")
    parser.add_argument("--given-exclusions", help="tab-separated (person, given name) pairs to leave out")
    parser.add_argument("--sectors", nargs="+", default=company.SECTORS, help="predicates that name a sector")
    parser.add_argument("--preferred-industry", default=company.PREFERRED_INDUSTRY)
    parser.add_argument("--changes-only", action="store_true", help="derive only what follows from changed subjects")
    parser.add_argument("--extract", help="table for the graph of exchange-listed companies")
    parser.add_argument("--countries", nargs="+", help="keep listed companies of these mapped countries only")
    parser.add_argument("--companies", type=int, help="keep exactly so many listed companies, the same ones in each run")
    parser.add_argument("--without-country", action="store_true", help="leave countries out of the extract")
    parser.add_argument("--reports", help="folder for reports of triples per predicate")
    parser.add_argument("--base", help="IRI prefix of the subjects that the reports count")
    options = parser.parse_args()
    if options.reports and not options.base:
        parser.error("--reports needs --base")
    spark = SparkSession.builder.appName("triplewright").getOrCreate()
    shared_folder(spark)  # fails here, not hours later
    paths = pipeline.JobPaths(
        options.dumps, options.mappings, options.triples, options.rejects, options.company, options.person
    )
    bases = [options.base] if options.base else []
    for name, counts in pipeline.ingest(spark, paths, database=options.database, bases=bases).items():
        print(f"{name}: {counts['lines']} lines, {counts['rejected']} rejected")
    choices = pipeline.Choices(
        _pairs(spark, options.family_exclusions, person.FAMILY_NAME_EXCLUSIONS),
        _pairs(spark, options.given_exclusions, person.GIVEN_NAME_EXCLUSIONS),
        options.sectors,
        options.preferred_industry,
    )
    for table in pipeline.derive(spark, paths, options.location, choices, options.changes_only):
        print(f"saved {table}")
    if options.extract:
        with_country = not options.without_country
        pipeline.save_extract(
            spark, paths, options.extract, options.countries, with_country, options.location, options.companies
        )
        print(f"saved {options.extract}")
    if options.reports:
        pipeline.report_predicates(spark, paths, options.base, options.reports, stored=True)
    spark.stop()


if __name__ == "__main__":
    main()
