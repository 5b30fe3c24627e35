"""Writing results: catalog tables, CSV, Parquet and the predicate report."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from triplewright.sources import versions


def _default_root(spark: SparkSession, table: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_versions/{table}"


def _described(spark: SparkSession, table: str) -> tuple[list[tuple[str, str]], str] | None:
    """Columns and kind of a catalog table; None if there is none."""
    if not spark.catalog.tableExists(table):
        return None
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(table)], spark.catalog.getTable(table).tableType


def save_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace the content of a catalog table all at once; readers see the old rows until then.

    The rows are written as a new version below ``path`` (or below the warehouse), published,
    and the table is pointed there. A run that ends early leaves the table as it was. A table
    whose columns change, or one stored in another way, is created anew.
    """
    spark, root = df.sparkSession, path or _default_root(df.sparkSession, table)
    staged = versions.stage(root)
    df.write.parquet(staged)
    versions.publish(spark, root, staged)
    wanted = [(name, kind) for name, kind in df.dtypes]
    found = _described(spark, table)
    if found == (wanted, "EXTERNAL"):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{staged}'")
    else:
        if found:
            spark.sql(f"DROP TABLE {table}")
        columns = ", ".join(f"`{name}` {kind}" for name, kind in wanted)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{staged}'")
    spark.catalog.refreshTable(table)
    versions.drop_old(spark, root)


@contextmanager
def _replacing_partitions(spark: SparkSession) -> Iterator[None]:
    """Overwriting a table replaces only the partitions that the new rows have."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_table(df: DataFrame, table: str, path: str | None = None, run: str | None = None, column: str = "run") -> None:
    """Add the rows of one run to a catalog table; columns are matched by name.

    The table is partitioned by ``column``, which has the value ``run`` in all these rows. Repeating
    a run replaces its rows, which may be none by now, and leaves all others alone. Without ``run``
    each call is a run of its own.
    """
    spark, run = df.sparkSession, run or uuid.uuid4().hex
    seen = Observation()
    rows = df.withColumn(column, F.lit(run)).observe(seen, F.count(F.lit(1)).alias("n"))
    if not spark.catalog.tableExists(table):
        (rows.write.option("path", path) if path else rows.write).partitionBy(column).saveAsTable(table)
        return
    stored = spark.read.table(table).columns
    if [c.name for c in spark.catalog.listColumns(table) if c.isPartition] != [column]:
        raise ValueError(f"{table} is not partitioned by {column}, so a run could not be repeated")
    if set(stored) != set(rows.columns):
        raise ValueError(f"{table} has the columns {stored}, the rows have {rows.columns}")
    with _replacing_partitions(spark):
        rows.select(*stored).write.mode("overwrite").insertInto(table)
    if seen.get["n"] == 0:
        value = run.replace("\\", "\\\\").replace("'", "\\'")
        names = [name for name in stored if name != column]
        nothing = spark.createDataFrame([], df.select(*names).schema)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{column}` = '{value}') SELECT * FROM {{nothing}}", nothing=nothing)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, one file per partition."""
    df.write.csv(path, header=True, mode="overwrite")


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path, mode="overwrite")


def write_predicate_report(stats: DataFrame, path: str) -> None:
    """Tab-separated report of (pred, n) with the header ``Predicate``, ``# triple``; values unquoted."""
    stats.select(F.col("pred").alias("Predicate"), F.col("n").alias("# triple")).write.csv(
        path, sep="\t", header=True, mode="overwrite", quote="", emptyValue=""
    )


def write_predicate_reports(stats: DataFrame, directory: str) -> None:
    """One report per dump for (source, pred, n): folders ``source=<dump name>`` below ``directory``."""
    stats.select("source", F.col("pred").alias("Predicate"), F.col("n").alias("# triple")).write.partitionBy(
        "source"
    ).csv(directory, sep="\t", header=True, mode="overwrite", quote="", emptyValue="")
