"""Attribute tables of companies, all (sub, pred, obj[, origin]).

``organization``, ``quote``, ``industry`` and ``person`` are triples: frames, or stored ones whose
key sketches spare the search for hot keys. Mappings are lookup frames as read by
:mod:`triplewright.sources.mappings`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplewright.functions.text import (
    NAME_STEPS,
    address_country,
    clean_address,
    collapse_ws,
    literal_value,
    url_host,
)
from triplewright.operators.facts import as_facts, by_subject, facts, in_steps, links, literals, with_object
from triplewright.operators.resolve import (
    conflicting_values,
    longest_by_window,
    longest_of_few,
    longest_per_key,
    prefer_on_conflict,
    single_value,
)
from triplewright.operators.skew import KeySketch, existence_join, lookup_join, scanned_once, skew_join
from triplewright.operators.stored import Triples, probe
from triplewright.session import materialize

# Predicate names of the dumps.
NAME = "organization-name"
ADDRESS = "HeadquartersAddress"
URL = "hasURL"
TICKER = "hasExchangeTicker"
EXCHANGE_CODE = "hasExchangeCode"
PRIMARY_QUOTE = "hasOrganizationPrimaryQuote"
DOMICILE = "isDomiciledIn"
INCORPORATION = "isIncorporatedIn"
SECTORS = ["hasPrimaryIndustryGroup", "hasPrimaryBusinessSector", "hasPrimaryEconomicSector"]
POSITIONS = ["isTenureIn", "isPositionIn"]
HOLDER = "hasHolder"

# Predicates of the country table.
COUNTRY = "hasCountry"
COUNTRY_FROM_ADDRESS = "isDomiciledInFromAddress"

# Fixed value: the industry that wins when a company has several.
PREFERRED_INDUSTRY = "Real Estate"


def company_exchange(organization: Triples, quote: Triples, exchange_map: DataFrame) -> DataFrame:
    """``code$ticker`` of each company's primary quotes.

    Code and ticker lists are made distinct before they meet, which makes their join
    distinct, too. It is written out, so that hot quotes are looked for among the products of
    codes and tickers. Links to quotes are written out, too, unless sketches tell their hot quotes. Two quotes of one
    company may still give equal rows.
    """
    company = links(organization, [PRIMARY_QUOTE], target="q")
    ticker = literals(quote, TICKER, key="q", value="ticker")
    raw_code = literals(quote, EXCHANGE_CODE, key="q", value="origin")
    code = lookup_join(raw_code, exchange_map, "origin", distinct=True, probe=probe(quote, [EXCHANGE_CODE], "value", "origin"))
    listing = skew_join(
        code.select("q", F.col("new").alias("ex_code")),
        ticker,
        "q",
        left_probe=probe(quote, [EXCHANGE_CODE], "sub", "q"),
        right_probe=probe(quote, [TICKER], "sub", "q"),
        distinct=["left", "right"],
    )
    company, by_quote = scanned_once(company, probe(organization, [PRIMARY_QUOTE], "id", "q"), "quoted")
    listed = skew_join(company, materialize(listing, "listings"), "q", left_probe=by_quote, distinct=["left"])
    return as_facts(listed.select("sub", F.concat_ws("$", "ex_code", "ticker").alias("obj")), "hasExchange")


def _with_clean_name(names: DataFrame) -> DataFrame:
    return as_facts(in_steps(names.withColumn("obj", F.col("origin")), "obj", *NAME_STEPS), NAME, "origin")


def _raw_names(rows: DataFrame) -> DataFrame:
    return rows.select("sub", literal_value(F.col("obj")).alias("origin"))


def company_name(organization: Triples) -> DataFrame:
    """Companies with exactly one raw name: raw form (origin) and cleaned form (obj)."""
    parts = by_subject(organization, NAME) or (facts(organization, NAME), None)
    single = [single_value(_raw_names(rows), "sub", "origin") for rows in parts if rows is not None]
    return _with_clean_name(reduce(DataFrame.unionByName, single))


def company_name_conflict(organization: Triples, unique: DataFrame | None = None) -> DataFrame:
    """All names of companies with several raw names, even if their cleaned forms agree.

    ``unique`` is the table of :func:`company_name`, if it has been saved already.
    """
    names = literals(organization, NAME, value="origin")
    return _with_clean_name(conflicting_values(names, "sub", "origin", unique))


def _longest(organization: Triples, pred: str, clean: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Longest cleaned value per company, ties kept."""
    laid_out = by_subject(organization, pred)
    if laid_out is None:
        sought = probe(organization, [pred], "sub")
        return as_facts(longest_per_key(clean(facts(organization, pred)), "sub", "obj", sought), pred)
    rows, hot = laid_out
    longest = longest_by_window(clean(rows), "sub", "obj")
    if hot is not None:
        longest = longest.unionByName(longest_of_few(clean(hot), "sub", "obj"))
    return as_facts(longest, pred)


def company_address(organization: Triples) -> DataFrame:
    """Longest cleaned headquarters address per company, ties kept."""
    return _longest(organization, ADDRESS, lambda rows: with_object(rows, literal_value, clean_address, collapse_ws))


def company_url(organization: Triples, strict: bool = False) -> DataFrame:
    """Longest web host per company, ties kept."""
    return _longest(organization, URL, lambda rows: with_object(rows, lambda x: url_host(x, strict)))


def company_country(organization: Triples, country_map: DataFrame) -> DataFrame:
    """Mapped countries of domicile and incorporation; a company may have several."""
    region = facts(organization, DOMICILE, INCORPORATION).select("sub", F.col("obj").alias("g"))
    mapped = lookup_join(region, country_map, "g", distinct=True, probe=probe(organization, [DOMICILE, INCORPORATION], "value", "g"))
    country = mapped.select("sub", F.col("new").alias("obj"), "origin")
    return as_facts(country.dropDuplicates(), COUNTRY, "origin")


def company_country_from_address(organization: Triples, country_map: DataFrame) -> DataFrame:
    """Countries read off the address of companies without domicile.

    Mapping and deduplication come first and leave at most one row per company and country. The
    domiciled companies are broadcast, or a Bloom filter of them that keeps most rows from
    being shuffled.
    """
    named = literals(organization, ADDRESS).select("sub", address_country(F.col("obj")).alias("origin"))
    country = (
        lookup_join(named, country_map.filter(F.col("new") != ""), "origin", distinct=True)
        .select("sub", F.col("new").alias("obj"), "origin")
        .dropDuplicates()
    )
    domiciled = facts(organization, DOMICILE).select("sub").dropDuplicates()
    return as_facts(existence_join(country, domiciled, "sub", "left_anti", balanced=True), COUNTRY_FROM_ADDRESS, "origin")


def company_country_all(organization: Triples, country_map: DataFrame) -> DataFrame:
    """Registered countries and those read off addresses."""
    return company_country(organization, country_map).unionByName(
        company_country_from_address(organization, country_map)
    )


def company_industry(
    organization: Triples,
    industry: Triples,
    industry_map: DataFrame,
    sectors: list[str] = SECTORS,
    preferred: str = PREFERRED_INDUSTRY,
) -> DataFrame:
    """One mapped industry per company: the only one, or the preferred one among several."""
    named = literals(industry, "label", key="ind", value="origin")
    labels = lookup_join(named, industry_map, "origin", probe=probe(industry, ["label"], "value", "origin"))
    sector = links(organization, sectors, target="ind")
    mapped = lookup_join(sector, labels.select("ind", "new"), "ind", distinct=True, probe=probe(organization, sectors, "id", "ind"))
    return as_facts(
        prefer_on_conflict(mapped.select("sub", F.col("new").alias("obj")), "sub", "obj", preferred), "hasIndustry"
    )


def _part_of(whole: DataFrame | KeySketch, rows: DataFrame) -> DataFrame | KeySketch:
    """Where to look for hot keys of some of the rows."""
    return replace(whole, whole=False) if isinstance(whole, KeySketch) else rows


def company_employee(
    person: Triples, family_name: DataFrame, given_name: DataFrame, companies: DataFrame | None = None
) -> DataFrame:
    """``family given`` names of the persons with a position or tenure in a company.

    The (company, person) pairs and each person's combined names are written out before they
    join: finding hot persons needs both, and counts the products of family and given names. So are
    positions and holders, unless sketches tell their hot keys. ``companies`` (sub) restricts the result.
    """
    holder = links(person, [HOLDER], key="h", target="p")
    position = links(person, POSITIONS, key="h", target="company")
    by_holder, position_probe = probe(person, [HOLDER], "sub", "h"), probe(person, POSITIONS, "sub", "h")
    if companies is not None:
        own = companies.select(F.col("sub").alias("company"))
        position = existence_join(position, own, "company", "left_semi", probe(person, POSITIONS, "id", "company"))
        position_probe = _part_of(position_probe, position)
    position, position_probe = scanned_once(position, position_probe, "held")
    holder, by_holder = scanned_once(holder, by_holder, "holders")
    # Copies of one side are kept: they add as many rows as there are, and leave with the last distinct.
    pairs = skew_join(
        holder, position, "h", left_probe=by_holder, right_probe=position_probe, copies=True, distinct=["right"]
    ).select("company", "p")
    pairs = materialize(pairs, "positions")
    family = family_name.select(F.col("sub").alias("p"), F.col("obj").alias("family"))
    given = given_name.select(F.col("sub").alias("p"), F.col("obj").alias("given"))
    raw = [probe(person, [pred], "sub", "p") for pred in ("family-name", "given-name")]
    names = skew_join(family, given, "p", *raw).select("p", F.concat_ws(" ", "family", "given").alias("obj"))
    names = materialize(in_steps(names, "obj", collapse_ws), "names")
    employee = skew_join(pairs, names, "p", copies=True)
    return as_facts(employee.select(F.col("company").alias("sub"), "obj").dropDuplicates(), "hasEmployee")
