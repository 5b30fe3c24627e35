"""The part of the graph that concerns exchange-listed companies."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplewright.operators.resolve import smallest_by_hash
from triplewright.operators.skew import existence_join, present
from triplewright.operators.stored import StoredTriples, Triples
from triplewright.plans import company
from triplewright.session import materialize


def listed_companies(
    exchange: DataFrame,
    country: DataFrame | None = None,
    countries: Iterable[str] | None = None,
    n_companies: int | None = None,
) -> DataFrame:
    """Distinct ids of companies with an exchange code, optionally only those of some countries,
    and of these exactly ``n_companies`` (or all, if fewer): always the same ones, by the MD5 of their ids."""
    listed = exchange.select("sub").dropDuplicates()
    if countries is not None:
        inside = country.filter(F.col("obj").isin(*countries)).select("sub").dropDuplicates()
        listed = present(listed, inside, "sub")
    if n_companies is None:
        return listed
    return smallest_by_hash(materialize(listed, "listed_all"), "sub", n_companies)


def restrict(triples: Triples, companies: DataFrame) -> Triples:
    """Rows about the given companies.

    Every attribute of a company depends on its own triples only, so restricting the
    input triples gives the same graph as restricting the attribute tables, much cheaper.
    """
    if isinstance(triples, StoredTriples):
        return triples.restricted_to(existence_join(triples.rows, companies, "sub", "left_semi", triples.sketch("sub")))
    return existence_join(triples, companies, "sub", "left_semi")


def graph(*attributes: DataFrame) -> DataFrame:
    """Attribute tables as one (sub, pred, obj) frame."""
    return reduce(DataFrame.union, [a.select("sub", "pred", "obj") for a in attributes])


def listed_company_graph(
    organization: Triples,
    quote: Triples,
    person: Triples,
    family_name: DataFrame,
    given_name: DataFrame,
    exchange_map: DataFrame,
    country_map: DataFrame,
    countries: Iterable[str] | None = None,
    with_country: bool = True,
    n_companies: int | None = None,
) -> DataFrame:
    """Name, address, web host, people and (optionally) countries of the exchange-listed companies.

    ``countries`` keeps only companies of these mapped countries, ``n_companies`` only so many. The
    ids of the listed companies are written out once, as every attribute is restricted to them.
    """
    exchange = company.company_exchange(organization, quote, exchange_map)
    country = None if countries is None else company.company_country_all(organization, country_map)
    listed = materialize(listed_companies(exchange, country, countries, n_companies), "listed")
    own = restrict(organization, listed)
    attributes = [
        company.company_name(own),
        company.company_address(own),
        company.company_url(own),
        company.company_employee(person, family_name, given_name, listed),
    ]
    if with_country:
        attributes.append(company.company_country_all(own, country_map))
    return graph(*attributes)
