"""Reading triple dumps, and storing them as versions that appear all at once.

A version of a stored dump has

    lines       (sub, obj) by kind (triple or reject) and pred
    keys        sketches of the keys of each predicate, see :mod:`triplewright.operators.stored`
    predicates  (base, pred, n): triples per full predicate IRI, if bases were given
    subjects    (sub, n, digest): an order-free digest of each subject's triples, see :mod:`triplewright.plans.changes`
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from triplewright.functions.text import (
    is_plain_triple,
    is_triple_pattern,
    local_name,
    path_end,
    regex_group,
    triple_pattern,
    without_ends,
)
from triplewright.operators.stored import StoredTriples, sketch_predicates
from triplewright.session import materialize, remove_folder, setting, shuffles_deleted
from triplewright.sources import versions

# Bytes of text from which a task's lines of one predicate are worth a file of their own.
FILE_BYTES = 2 << 20
# Smaller files that a task may leave on average, before they are collected by a shuffle.
SMALL_FILES = 4
# Predicates whose lines are told apart as large, while those of others are shuffled.
MOST_IN_PLACE = 1000
# Files that a task keeps open, one a predicate, before it sorts its rows instead; and the most bytes that each holds in memory.
OPEN_FILES, OPEN_FILE_BYTES = 16, 32 << 20


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of a dump: ``value``."""
    return spark.read.schema("value string").text(list(paths))


def read_matching_lines(spark: SparkSession, base: str, *paths: str) -> DataFrame:
    """N-Triples lines with a subject under ``base`` and a closing `` .``."""
    line = F.col("value")
    return read_lines(spark, *paths).filter(line.contains(f"<{base}") & line.rlike(is_triple_pattern(base)))


def _has_predicate() -> Column:
    return F.contains(F.col("value"), F.lit(" "))


def _with_tokens(lines: DataFrame, *more: Column) -> DataFrame:
    """Lines, their first two tokens (null where there is none), and the rest behind them."""
    tokens = F.split("value", " ", 3).alias("tokens")
    # A projection of its own, so that lines are split once.
    split = lines.select("value", tokens, *more)
    first, second, rest = (F.get("tokens", i) for i in range(3))
    rest = F.coalesce(rest, F.lit("")).alias("rest")
    return split.select("value", first.alias("first"), second.alias("second"), rest, *split.columns[2:])


def _object() -> Column:
    """The rest up to its last space."""
    last = F.substring_index("rest", " ", -1)
    return F.left("rest", F.greatest(F.length("rest") - F.length(last) - 1, F.lit(0)))


def parse_triples(lines: DataFrame) -> DataFrame:
    """``<subject> <predicate> object .`` -> (sub, pred, obj); see :func:`rejected_lines` for the rest.

    Subject and predicate keep their local names only. The object is all text between the
    second and the last space, in its raw form.
    """
    tokens = _with_tokens(lines.filter(_has_predicate()))
    return tokens.select(path_end(F.col("first")).alias("sub"), local_name(F.col("second")).alias("pred"), _object().alias("obj"))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines of fewer than two space-separated tokens."""
    return lines.filter(~_has_predicate())


_LINES = "sub string, obj string, kind string, pred string"


def _partition() -> list[Column]:
    """The kind and the predicate of a line by its second token."""
    second = F.col("second")
    return [F.when(second.isNotNull(), "triple").otherwise("reject").alias("kind"), local_name(second).alias("pred")]


def _sorted_out(lines: DataFrame) -> DataFrame:
    """Triples, and rejected lines as objects."""
    parsed = F.col("second").isNotNull()
    sub, obj = F.when(parsed, path_end(F.col("first"))), F.when(parsed, _object()).otherwise(F.col("value"))
    return _with_tokens(lines).select(sub.alias("sub"), obj.alias("obj"), *_partition())


def _stored_lines(spark: SparkSession, version: str) -> DataFrame:
    return spark.read.schema(_LINES).parquet(f"{version}/lines")


def _triples_of(lines: DataFrame) -> DataFrame:
    """The empty predicate, which partition folders cannot name, is restored."""
    return lines.select("sub", F.coalesce("pred", F.lit("")).alias("pred"), "obj")


def _counted_iri(base: str) -> Column:
    """The bracketed predicate IRI that a line counts for under a base, empty or null where there is none."""
    value, first, second = F.col("value"), F.col("first"), F.col("second")
    searched = F.when(value.contains(f"<{base}"), regex_group(value, triple_pattern(base), 2))
    # A subject has a character of its own between base and bracket.
    bare = F.endswith(first, F.lit(f"<{base}>")) | F.endswith(first, F.lit(f"<{base}"))
    return F.when(F.col("plain") & ~bare, F.when(first.contains(f"<{base}"), second)).otherwise(searched)


def _lines_by_task(lines: DataFrame, bases: list[str]) -> DataFrame:
    """(task, kind, pred, iris, n, bytes): numbers of lines by the task that reads them, and by the predicate IRI under each base."""
    tokens = _with_tokens(lines, F.octet_length("value").cast("long").alias("bytes"), F.spark_partition_id().alias("task"))
    if bases:
        tokens = tokens.withColumn("plain", is_plain_triple(F.col("first"), F.col("second"), F.col("rest")))
    iris = {f"iri_{i}": _counted_iri(base) for i, base in enumerate(bases)}
    by_iri = tokens.select("task", "second", "bytes", *[iri.alias(name) for name, iri in iris.items()])
    counts = by_iri.groupBy("task", "second", *iris).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    return counts.select("task", *_partition(), F.array(*iris).cast("array<string>").alias("iris"), "n", "bytes")


def _predicate_counts(by_task: DataFrame, bases: list[str]) -> DataFrame:
    """(base, pred, n): triples per full predicate IRI under each base."""
    pairs = F.explode(F.arrays_zip(F.array(*map(F.lit, bases)).alias("base"), F.col("iris").alias("iri"))).alias("counted")
    counts = by_task.select(pairs, "n").select("counted.*", "n").filter("iri <> ''").groupBy("base", "iri").agg(F.sum("n").alias("n"))
    return counts.select("base", without_ends(F.col("iri")).alias("pred"), "n")


def _layout(by_task: DataFrame) -> Row:
    """What the tasks that read a dump would write: one row of numbers of lines, rejected lines, tasks and small files, and
    the largest predicates (kind, pred) whose files would not be small."""
    by_task = by_task.groupBy("task", "kind", "pred").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    files = by_task.groupBy("kind", "pred").agg(
        F.count("*").alias("files"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), (F.max("task") + 1).alias("tasks")
    )
    small = F.col("bytes") < F.col("files") * FILE_BYTES
    large = F.collect_list(F.when(~small, F.struct("bytes", "kind", "pred")))
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lines"),
        F.coalesce(F.sum(F.when(F.col("kind") == "reject", F.col("n"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.max("tasks"), F.lit(0)).alias("tasks"),
        F.coalesce(F.sum(F.when(small, F.col("files"))), F.lit(0)).alias("small_files"),
        F.slice(F.sort_array(large, asc=False), 1, MOST_IN_PLACE).alias("large"),
    ).first()


def _write_lines(rows: DataFrame, path: str, layout: Row) -> None:
    """Write each predicate's rows from the tasks that read them, or, where that made many small files, collected by a shuffle."""

    def write(part: DataFrame, **options) -> None:
        part.write.partitionBy("kind", "pred").mode("append").options(**options).parquet(path, compression="zstd")

    def write_in_place(part: DataFrame) -> None:
        """Tasks write to a file of each predicate at once; they would sort their rows otherwise."""
        with setting(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
            write(part, **{"parquet.block.size": str(OPEN_FILE_BYTES)})

    if layout["small_files"] <= SMALL_FILES * layout["tasks"]:
        write_in_place(rows)
        return
    names = [x["pred"] for x in layout["large"] if x["kind"] == "triple"]
    rejects = [x for x in layout["large"] if x["kind"] == "reject"]
    in_place = F.when(F.col("kind") == "reject", F.lit(bool(rejects))).otherwise(F.coalesce(F.col("pred").isin(names), F.lit(False)))
    if layout["large"]:
        write_in_place(rows.filter(in_place))
    write(rows.filter(~in_place).hint("rebalance", "kind", "pred"))


def _write_version(spark: SparkSession, path: str, version: str, bases: list[str]) -> dict[str, int]:
    """Store one dump and what plans need to know of it; returns the counts of its lines."""
    lines = read_lines(spark, path)
    by_task = _lines_by_task(lines, bases)
    if bases:
        by_task = materialize(by_task, "by_task", f"{version}/by_task")
        _predicate_counts(by_task, bases).write.parquet(f"{version}/predicates")
    with shuffles_deleted(spark):
        layout = _layout(by_task)
        if bases:
            remove_folder(spark, f"{version}/by_task")
        _write_lines(_sorted_out(lines), f"{version}/lines", layout)
        triples = _triples_of(_stored_lines(spark, version).filter(F.col("kind") == "triple"))
        sketch_predicates(triples).write.parquet(f"{version}/keys")
        subject_digests(triples).write.parquet(f"{version}/subjects", compression="zstd")
    return {name: layout[name] for name in ("lines", "rejected")}


def subject_digests(triples: DataFrame) -> DataFrame:
    """(sub, n, digest): number of triples and the sum of their hashes, whatever their order.

    Upper and lower halves are added up on their own, as long integers: their sums have room for 2^31 triples of a subject.
    """
    halves = triples.select("sub", F.xxhash64("pred", "obj").alias("h"))
    upper, lower = F.sum(F.shiftright("h", 32)), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)))
    sums = halves.groupBy("sub").agg(F.count("*").alias("n"), upper.alias("upper"), lower.alias("lower"))
    upper, lower = (F.col(half).cast("decimal(38,0)") for half in ("upper", "lower"))
    return sums.select("sub", "n", (upper * F.lit(2**32) + lower).cast("decimal(38,0)").alias("digest"))


def _register(spark: SparkSession, version: versions.Version, database: str, name: str) -> None:
    """The version as a catalog table, and ``database.name`` as a view of its triples: replaced in one step."""
    stored = f"{database}.{name}__{version.number}"
    spark.sql(f"DROP TABLE IF EXISTS {stored}")
    spark.sql(
        f"CREATE TABLE {stored} (sub STRING, obj STRING, kind STRING, pred STRING) USING parquet "
        f"PARTITIONED BY (kind, pred) LOCATION '{version.path}/lines'"
    )
    spark.sql(f"ALTER TABLE {stored} RECOVER PARTITIONS")
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{name} AS "
        f"SELECT sub, coalesce(pred, '') AS pred, obj FROM {stored} WHERE kind = 'triple'"
    )


def _forget_tables(spark: SparkSession, database: str, name: str, kept: set[int]) -> None:
    for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{name.lower()}__*'").collect():
        number = row["tableName"].rsplit("__", 1)[1]
        if number.isdigit() and int(number) not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{row['tableName']}")


def ingest_triples(
    spark: SparkSession,
    dumps: dict[str, str],
    target: str,
    rejects: str | None = None,
    database: str | None = None,
    bases: Iterable[str] = (),
) -> dict[str, dict]:
    """Store each dump (name -> path) as the next version of ``target/name``, partitioned by predicate.

    Each dump is scanned once for the bytes of its predicates. The tasks that read it then write the rows of
    large predicates without a shuffle; if the others made many small files, they take a scan of
    their own, and the rebalance hint groups each predicate's rows into few files. The version is published when it is complete:
    a run that ends before that leaves the last version as it is, and can simply be repeated.
    Unparsable lines are kept apart from all triples, whatever their predicates are called, and are
    also written as text to ``rejects/name``. With ``database``, ``database.name`` becomes a view of
    the version's triples. ``bases`` are IRI prefixes of subjects whose triples are counted by
    predicate. Returns the counts per dump.
    """
    counts, bases = {}, list(bases)
    for name, path in dumps.items():
        root = f"{target}/{name}"
        staged = versions.stage(root)
        counts[name] = _write_version(spark, path, staged, bases)
        version = versions.publish(spark, root, staged)
        if database:
            _register(spark, version, database, name)
        if rejects:
            read_rejects(spark, root).write.mode("overwrite").text(f"{rejects}/{name}")
        versions.drop_old(spark, root)
        if database:
            _forget_tables(spark, database, name, {v.number for v in versions.published(spark, root)})
    return counts


def _in_force(spark: SparkSession, path: str) -> str:
    version = versions.current(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing has been published in {path}")
    return version.path


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """The triples of a stored dump in its version in force; or of a plain folder, partitioned by predicate."""
    if not versions.is_versioned(spark, path):
        return _triples_of(spark.read.schema("sub string, obj string, pred string").parquet(path))
    return triples_of_version(spark, _in_force(spark, path))


def triples_of_version(spark: SparkSession, version: str) -> DataFrame:
    """The triples of one version."""
    if not versions.exists(spark, f"{version}/lines/kind=triple"):
        return spark.createDataFrame([], "sub string, pred string, obj string")
    return _triples_of(spark.read.schema("sub string, obj string, pred string").parquet(f"{version}/lines/kind=triple"))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The unparsable lines of a stored dump: ``value``."""
    lines = _stored_lines(spark, _in_force(spark, path))
    return lines.filter(F.col("kind") == "reject").select(F.col("obj").alias("value"))


def read_predicate_counts(spark: SparkSession, path: str) -> DataFrame:
    """(base, pred, n) of a stored dump, for the bases that were given when it was stored."""
    version = _in_force(spark, path)
    if not versions.exists(spark, f"{version}/predicates"):
        raise FileNotFoundError(f"{path} was stored without bases to count for")
    return spark.read.schema("base string, pred string, n long").parquet(f"{version}/predicates")


def open_triples(spark: SparkSession, path: str) -> StoredTriples:
    """The triples of a stored dump with the sketches of their keys."""
    return open_version(spark, _in_force(spark, path))


def open_version(spark: SparkSession, version: str) -> StoredTriples:
    """The same for one version."""
    keys = spark.read.parquet(f"{version}/keys")
    totals = {(row["pred"], row["key"]): row["n"] for row in keys.select("pred", "key", "n").collect()}  # a row per predicate and key
    return StoredTriples(triples_of_version(spark, version), keys, totals)
