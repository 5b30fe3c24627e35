"""Choosing among several values of one key. Keys and values are non-null, as in stored triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplewright.operators.skew import KeySketch, existence_join, hot_keys, lookup_join, split_hot


def count_by_key(df: DataFrame, key: str) -> DataFrame:
    """Rows per key."""
    return df.groupBy(key).agg(F.count("*").alias("n"))


def count_distinct_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values per key; Spark deduplicates (key, value) first, so a hot key is spread."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n"))


def with_key_count(df: DataFrame, key: str) -> DataFrame:
    """Every row with the number ``n`` of rows of its key.

    One shuffle with a window. Rows of hot keys are counted with partial aggregation
    instead and get their count from a broadcast of at most a thousand rows.
    """
    (hot,) = hot_keys([df], key)
    counted = F.count("*").over(Window.partitionBy(key))
    if not hot:
        return df.withColumn("n", counted)
    hot_rows, rest = split_hot(df, key, hot)
    counts = F.broadcast(count_by_key(hot_rows, key))
    return hot_rows.join(counts, key).unionByName(rest.withColumn("n", counted)).select(*df.columns, "n")


def rank_longest(df: DataFrame, key: str, value: str) -> DataFrame:
    """Every row with ``len`` of its value and ``rank`` by descending length in its key; ties share a rank.

    For hot keys the rank is computed on row counts per (key, length) and joined back.
    """
    df = df.withColumn("len", F.length(value).cast("long"))
    by_length = Window.partitionBy(key).orderBy(F.desc("len"))
    ranked = F.rank().over(by_length).cast("long")
    (hot,) = hot_keys([df], key)
    if not hot:
        return df.withColumn("rank", ranked)
    hot_rows, rest = split_hot(df, key, hot)
    longer = F.sum("n").over(by_length.rowsBetween(Window.unboundedPreceding, -1))
    ranks = (
        hot_rows.groupBy(key, "len")
        .agg(F.count("*").alias("n"))
        .withColumn("rank", F.coalesce(longer, F.lit(0)) + 1)
        .drop("n")
    )
    both = lookup_join(hot_rows, ranks, [key, "len"], copies=True).unionByName(rest.withColumn("rank", ranked))
    return both.select(*df.columns, "rank")


def longest_per_key(df: DataFrame, key: str, value: str, probe: DataFrame | KeySketch | None = None) -> DataFrame:
    """Distinct rows whose value is the longest of its key; all ties stay.

    Duplicates do not change a maximum, so they are removed after the filter, on the
    window's own partitioning: one shuffle. Hot keys, looked for in ``probe`` if given, get their
    maximum by partial aggregation and a broadcast of at most a thousand rows.
    """
    (hot,) = hot_keys([df if probe is None else probe], key)
    if not hot:
        return longest_by_window(df, key, value)
    hot_rows, rest = split_hot(df, key, hot)
    return longest_of_few(hot_rows, key, value).unionByName(longest_by_window(rest, key, value))


def longest_by_window(df: DataFrame, key: str, value: str) -> DataFrame:
    """:func:`longest_per_key` without hot keys."""
    ranked = df.withColumn("len", F.length(value)).withColumn(
        "rank", F.rank().over(Window.partitionBy(key).orderBy(F.desc("len")))
    )
    return ranked.filter(F.col("rank") == 1).select(*df.columns).dropDuplicates()


def longest_of_few(df: DataFrame, key: str, value: str) -> DataFrame:
    """:func:`longest_per_key` of at most a thousand keys, whatever their number of rows."""
    longest = F.broadcast(df.groupBy(key).agg(F.max(F.length(value)).alias("longest")))
    best = df.join(longest, key).filter(F.length(value) == F.col("longest"))
    return best.select(*df.columns).dropDuplicates()


def single_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) of the keys that have exactly one distinct value. One shuffle, partially aggregated."""
    return (
        df.groupBy(key)
        .agg(F.min(value).alias(value), F.max(value).alias("other"))
        .filter(F.col(value) == F.col("other"))
        .select(key, value)
    )


def conflicting_values(df: DataFrame, key: str, value: str, single: DataFrame | None = None) -> DataFrame:
    """Distinct (key, value) of the keys that have several values.

    The complement of :func:`single_value`, whose result may be given as ``single``. Grouping
    whole (key, value) pairs collapses copies before the shuffle and gathers no key in one place.
    """
    if single is None:
        single = single_value(df, key, value)
    return (
        df.select(key, value, F.lit(0).alias("single"))
        .unionByName(single.select(key, value, F.lit(1).alias("single")))
        .groupBy(key, value)
        .agg(F.max("single").alias("single"))
        .filter(F.col("single") == 0)
        .select(key, value)
    )


def prefer_on_conflict(df: DataFrame, key: str, value: str, preferred: str) -> DataFrame:
    """One value per key: the only one, or ``preferred`` if it is among several; other keys vanish."""
    return (
        df.groupBy(key)
        .agg(
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.bool_or(F.col(value) == preferred).alias("has_preferred"),
        )
        .filter((F.col("low") == F.col("high")) | F.col("has_preferred"))
        .select(key, F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(preferred).alias(value))
    )


def drop_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose (sub, obj) is not listed."""
    return existence_join(df, pairs, ["sub", "obj"], "left_anti")


# Digits of the hash that one step of a cut looks at: 65,536 cells.
CUT_DIGITS = 4
# Rows that are sorted at the end of a cut.
CUT_ROWS = 10_000


def smallest_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows whose ``key`` has the smallest MD5; keys are distinct and not null. All rows if there are fewer.

    Rows are counted by the first digits of their hash, partially aggregated, until the cell is
    found in which the n-th row lies; within it, by the next digits, until few rows are left to
    be sorted. ``df`` is scanned once a step, so it should be stored.
    """
    if n <= 0:
        return df.limit(0)
    digest, inside, taken = F.md5(F.col(key).cast("string")), "", 0

    def cell(digits: int) -> Column:
        return F.substring(digest, 1, digits)

    while True:
        digits = len(inside) + CUT_DIGITS
        within = df.filter(F.startswith(digest, F.lit(inside)))
        until = F.sum("n").over(Window.orderBy("cell"))
        row = (
            within.groupBy(cell(digits).alias("cell"))  # at most 65,536 rows, whatever the input
            .agg(F.count("*").alias("n"))
            .withColumn("until", until)
            .filter(F.col("until") >= n - taken)
            .orderBy("cell")
            .first()
        )
        if row is None:
            return df
        taken, inside = taken + row["until"] - row["n"], row["cell"]
        if row["n"] <= CUT_ROWS or digits >= 32:
            break
    last = df.filter(cell(digits) == inside).orderBy(digest, key).limit(n - taken).select(key)
    bound = last.agg(F.max(F.struct(digest.alias("digest"), F.col(key).alias("key"))).alias("bound")).first()["bound"]
    at_most = (digest < bound["digest"]) | ((digest == bound["digest"]) & (F.col(key) <= F.lit(bound["key"])))
    return df.filter(at_most)
