"""Triples, lookup tables and raw lines derived from the given tables (recipes: FIXTURES.md).

Ids divisible by five are folded onto the next id, so some companies carry two names,
addresses and hosts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplewright.session import scratch_path, shuffles_deleted

BASE = "https://kg.example/"
ONTOLOGY = "http://kg.example/ontology/ns#"
LINES_PER_FILE = 1_000_000
STRING_TYPE = "^^<http://www.w3.org/2001/XMLSchema#string>"


class Fixtures:
    """Lazy frames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def organization(self) -> DataFrame:
        documents, pages, lineitem = self.table("documents"), self.table("pages"), self.table("lineitem")
        doc = F.col("doc_id")
        sub = F.concat(F.lit("1-"), F.when(doc % 5 == 0, doc + 1).otherwise(doc))

        def in_one_line(x: Column) -> Column:
            return F.replace(x, F.lit("\n"), F.lit("\\n"))

        def region(number: Column) -> Column:
            return F.concat(F.lit("<http://geo.example/"), number, F.lit("/>"))

        def sector(number: Column) -> Column:
            return F.concat(F.lit(f"<{BASE}4-"), number, F.lit(">"))

        name = F.concat(
            F.lit('"'),
            F.when(doc % 3 == 0, "'").otherwise(" "),
            in_one_line(F.col("text")),
            F.when(doc % 2 == 0, "  Ltd.").otherwise(", Inc"),
            F.lit('"'),
        )
        def address(x: Column) -> Column:
            return F.concat(F.lit('"'), in_one_line(x), F.lit("\\nNATION_"), doc % 25, F.lit('\\n"' + STRING_TYPE))

        page = F.col("page_id")
        site = F.concat(F.lit("1-"), F.when(page % 5 == 0, page + 1).otherwise(page))
        quoted = lineitem.select("l_suppkey", "l_partkey").dropDuplicates()
        return _union(
            _triples(documents, sub, "organization-name", name),
            _triples(documents, sub, "HeadquartersAddress", address(F.col("text"))),
            # Ties: as long as the address, in reverse.
            _triples(documents.filter(doc % 11 == 0), sub, "HeadquartersAddress", address(F.reverse("text"))),
            _triples(documents.filter(doc % 7 != 0), sub, "isDomiciledIn", region(doc % 25)),
            _triples(documents.filter(doc % 4 == 0), sub, "isIncorporatedIn", region((doc + 3) % 25)),
            _triples(documents, sub, "hasPrimaryEconomicSector", sector(doc % 6)),
            _triples(documents.filter(doc % 3 == 0), sub, "hasPrimaryBusinessSector", sector((doc + 1) % 6)),
            _triples(pages, site, "hasURL", F.concat(F.lit("<"), "url", F.lit(">"))),
            # Odd runs of slashes, before the host and in the path.
            _triples(pages.filter(page % 13 == 0), site, "hasURL", F.concat(F.lit("<http:///"), page, F.lit(".a/b>"))),
            _triples(pages.filter(page % 17 == 0), site, "hasURL", F.concat(F.lit("<http://a/b///"), page, F.lit(">"))),
            _triples(
                quoted,
                F.concat(F.lit("1-"), "l_suppkey"),
                "hasOrganizationPrimaryQuote",
                F.concat(F.lit(f"<{BASE}1-8"), "l_partkey", F.lit(">")),
            ),
        )

    def quote(self) -> DataFrame:
        part = self.table("part")
        sub = F.concat(F.lit("1-8"), "p_partkey")
        ticker = F.concat(F.lit('"'), F.upper(F.replace("p_name", F.lit(" "), F.lit("."))), F.lit('"'))
        code = F.concat(F.lit('"'), "p_brand", F.lit('"' + STRING_TYPE))
        return _union(_triples(part, sub, "hasExchangeTicker", ticker), _triples(part, sub, "hasExchangeCode", code))

    def industry(self) -> DataFrame:
        # The handful of distinct part types, numbered in order.
        number = F.row_number().over(Window.orderBy("p_type")) - 1
        types = self.table("part").select("p_type").dropDuplicates().withColumn("number", number)
        return _triples(
            types, F.concat(F.lit("4-"), "number"), "label", F.concat(F.lit('"'), "p_type", F.lit('"'))
        )

    def person(self) -> DataFrame:
        customer, orders, lineitem = self.table("customer"), self.table("orders"), self.table("lineitem")
        person = F.concat(F.lit("1-3"), "c_custkey")
        holder = F.concat(F.lit("2-"), "l_orderkey", F.lit("-"), "l_linenumber")
        held = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
        # Tenures and positions together, in one scan.
        kind = F.when(F.col("l_returnflag") == "R", "isTenureIn").otherwise("isPositionIn")
        company = F.concat(F.lit(f"<{BASE}1-"), "l_suppkey", F.lit(">"))
        return _union(
            _triples(customer, person, "family-name", F.concat(F.lit('"'), "c_mktsegment", F.lit('"'))),
            _triples(customer.filter("c_custkey % 50 = 0"), person, "family-name", F.lit('"Alt"')),
            _triples(
                customer,
                person,
                "given-name",
                F.concat(F.lit('"'), F.replace("c_name", F.lit("#"), F.lit(" # ")), F.lit('"')),
            ),
            _triples(held, holder, "hasHolder", F.concat(F.lit(f"<{BASE}1-3"), "o_custkey", F.lit(">"))),
            _triples(lineitem.filter("l_returnflag IS NOT NULL"), holder, kind, company),
        )

    def triples(self) -> DataFrame:
        return _union(self.organization(), self.quote(), self.industry(), self.person())

    def geo_map(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.concat(F.lit("<http://geo.example/"), "n_nationkey", F.lit("/>")).alias("g"),
            F.col("n_name").alias("origin"),
            F.when(F.col("n_nationkey") % 9 == 0, "").otherwise(F.col("r_name")).alias("new"),
        )

    def exchange_map(self) -> DataFrame:
        brand = F.substring("p_brand", 7, 10).cast("int")
        return (
            self.table("part")
            .filter(brand % 5 != 0)
            .select(F.col("p_brand").alias("origin"), F.concat(F.lit("EX"), brand % 7).alias("new"))
            .dropDuplicates()
        )

    def industry_map(self) -> DataFrame:
        return self.spark.createDataFrame(
            [
                ("STANDARD", "Real Estate"),
                ("ECONOMY", "Retail"),
                ("MEDIUM", "Retail"),
                ("PROMO", "Services"),
                ("SMALL", "Services"),
            ],
            "origin string, new string",
        )

    def blocklist(self) -> DataFrame:
        return (
            self.table("customer")
            .filter("c_custkey % 50 = 0 AND c_custkey % 100 <> 0")
            .select(F.concat(F.lit("1-3"), "c_custkey").alias("sub"), F.lit("Alt").alias("obj"))
        )

    def employees(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_mktsegment").alias("first_name"),
            F.col("c_name").alias("second_name"),
            F.col("c_nationkey").cast("long").alias("floor"),
        )

    def write_lines(self, triples: DataFrame, name: str = "dump") -> str:
        """Triples as N-Triples text; returns the folder."""
        lines = triples.select(
            F.concat(F.lit(f"<{BASE}"), "sub", F.lit(f"> <{ONTOLOGY}"), "pred", F.lit("> "), "obj", F.lit(" .")).alias("value")
        )
        return self.write_text(lines, name)

    def write_text(self, lines: DataFrame, name: str = "dump") -> str:
        """Lines as compressed text, as dumps are published; returns the folder.

        A compressed file is read by one task, so no file takes more than ``LINES_PER_FILE`` lines.
        """
        path = scratch_path(self.spark, name)
        writer = lines.write.option("maxRecordsPerFile", LINES_PER_FILE).option("zlib.compress.level", "BEST_SPEED")
        with shuffles_deleted(self.spark):
            writer.text(path, compression="gzip")
        return path

    def write_mapping(self, mapping: DataFrame, name: str = "mapping") -> str:
        """A lookup frame as tab-separated text; returns the folder."""
        path = scratch_path(self.spark, name)
        mapping.select(F.concat_ws("\t", *mapping.columns)).write.text(path)
        return path


def _triples(df: DataFrame, sub: Column, pred: str | Column, obj: Column) -> DataFrame:
    return df.select(sub.alias("sub"), F.lit(pred).alias("pred"), obj.alias("obj"))


def _union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, frames)
