"""Lookup files: tab-separated text without header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_mapping(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Fields of each line under the given names. Empty fields stay empty strings, missing ones are null."""
    fields = F.split("value", "\t", -1)
    return spark.read.schema("value string").text(path).select(
        *[F.get(fields, i).alias(name) for i, name in enumerate(columns)]
    )


def read_code_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Two columns (origin, new), as used for exchanges and industries."""
    return read_mapping(spark, path, ["origin", "new"])


def read_country_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Three columns (g, origin, new): bracketed region IRI, country name, mapped name."""
    return read_mapping(spark, path, ["g", "origin", "new"])
