"""Groups of spelling variants among the words of a corpus.

Words are the longest runs of Latin letters, A-Z lower-cased, of which one occurrence pattern
in 199, chosen by a checksum of document and run, loses a letter. Two words are near if they differ
by one inserted, deleted or replaced letter. A word's form is its most frequent near word if
that is frequent enough beside it; following forms leads to its root.

Near words come from a pair dictionary over two tries, one of the words, one of the reversed
words. Words are sorted in ranges; each range numbers the nodes that its words add, and what a
range shares with the one before it is settled from the ranges' first and last words. Every word
then yields integer pairs: (node of a prefix, node of the suffix behind the next letter) for
each letter skipped, and (node of a prefix, node of the rest) for each place where a letter
could be inserted. Words that replace a letter share a skipping pair; a word with a letter more
has as a skipping pair an inserting one of the shorter word. The join of equal pairs is exact, has
at most one inserting word a pair, and at most one skipping word for each letter there is.

Defined results: null and empty texts have no words. A null id counts as an empty one in the
checksum. Repeated rows count again; equal counts go to the word that comes first in code-point
order. An empty table, or one without frequent words, gives an empty result. Words of any length
cost in proportion to their length. Other columns don't matter.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplewright.llm.words import utf8
from triplewright.session import materialize

MIN_LETTERS = 6
MIN_COUNT = 5
# A form occurs at least so many times as often as the word.
FORM_RATIO = 5
# One in so many checksums deletes a letter.
DELETE_EVERY = 199
# Distinct words that a task keeps before it passes their counts on.
TASK_WORDS = 1 << 20
# Words of a sorted range, on average.
RANGE_WORDS = 200_000

_RUN = re.compile("[a-zÀ-ÿ]+")


# Counting


def _count_words(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                prefix = zlib.crc32(f"{'' if key is None else key}:".encode())
                lowered = utf8(text).lower().decode("utf-8", "surrogatepass")  # bytes know the case of A-Z only
                for word, n in Counter(_RUN.findall(lowered)).items():
                    if len(word) < least:  # it only gets shorter
                        continue
                    checksum = zlib.crc32(word.encode(), prefix)
                    if checksum % DELETE_EVERY == 0:
                        at = checksum % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    counts[word] += n
            if len(counts) > TASK_WORDS:
                yield rows(counts)
                counts.clear()
        if counts:
            yield rows(counts)

    return run


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", letters: int = MIN_LETTERS, least: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of at least ``letters`` letters that occur at least ``least`` times."""
    found = df.select(F.col(key).cast("string"), text).mapInArrow(_count_words(letters), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# Tries


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _number_range(table: pa.Table) -> pa.Table:
    """Words of a range with the numbers of their nodes, counted from 1 within the range."""
    words = table["turned"].to_pylist()
    order = sorted(range(len(words)), key=words.__getitem__)
    nodes: list[list[int]] = [[]] * len(words)
    path: list[int] = []
    before, last = "", 0
    for i in order:
        own = _shared(before, words[i])
        path = path[:own] + list(range(last + 1, last + 1 + len(words[i]) - own))
        last = max(last, path[-1])
        nodes[i], before = path, words[i]
    return table.append_column("nodes", pa.array(nodes, pa.list_(pa.int64())))


def _carries(ranges: list) -> list[tuple[int, int, list[int]]]:
    """Of each range in order: its number, its first free node number less one, and the nodes that it shares with earlier ones."""
    found, offset, before, path = [], 0, "", []
    for row in ranges:
        carried = path[: _shared(before, row["first_word"])]
        found.append((row["part"], offset, carried))
        # The last word's nodes, as numbered over all ranges.
        path = [carried[n - 1] if n <= len(carried) else offset + n - len(carried) for n in row["last_nodes"]]
        offset, before = offset + row["n_nodes"] - len(carried), row["last_word"]
    return found


def number_trie(words: DataFrame, n_words: int, turned: Column) -> DataFrame:
    """Add ``nodes``, the trie's node number of each prefix of ``turned``, from length 1 on.

    Numbers grow with the order of the words: those of whole words sort like the words.
    """
    spark, n_ranges = words.sparkSession, max(1, math.ceil(n_words / RANGE_WORDS))
    ranged = words.withColumn("turned", turned).repartitionByRange(n_ranges, "turned").withColumn("part", F.spark_partition_id())
    # Written, so that ranges don't change when a task runs again.
    ranged = materialize(ranged, "word_ranges")
    schema = ", ".join(f"{name} {kind}" for name, kind in [*ranged.dtypes, ("nodes", "array<bigint>")])
    numbered = materialize(ranged.groupBy("part").applyInArrow(_number_range, schema), "trie")
    ranges = (
        numbered.groupBy("part")
        .agg(
            F.min("turned").alias("first_word"),
            F.max("turned").alias("last_word"),
            F.max_by("nodes", "turned").alias("last_nodes"),
            F.max(F.get("nodes", F.size("nodes") - 1)).alias("n_nodes"),
        )
        .sort("part")
        .collect()  # one row for RANGE_WORDS words
    )
    carries = spark.createDataFrame(_carries(ranges), "part int, offset long, carried array<bigint>")
    n_carried = F.size("carried")
    settled = F.transform(
        "nodes", lambda n: F.when(n <= n_carried, F.get("carried", (n - 1).cast("int"))).otherwise(F.col("offset") + n - n_carried)
    )
    return numbered.join(F.broadcast(carries), "part").withColumn("nodes", settled).drop("part", "turned", "offset", "carried")


# Neighbours


def _pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prefix, suffix, id, n, first) for each skipped letter, (prefix, suffix, id, n) for each place of an inserted one.

    ``first`` marks the first of equal neighbouring letters: skipping the others gives the same.
    """
    size = F.length("word")
    # Numbers by length, the root for the empty prefix or suffix.
    tries = words.select("id", "n", "word", F.concat(F.array(F.lit(0).cast("long")), "prefixes").alias("p"), F.concat(F.array(F.lit(0).cast("long")), "suffixes").alias("s"))

    def at(place: Column, skipped: int) -> list[Column]:
        return [F.get("p", place).alias("prefix"), F.get("s", size - place - skipped).alias("suffix")]

    place = F.col("place")
    letter = F.substring("word", place + 1, F.lit(1))
    skipping = tries.withColumn("place", F.explode(F.sequence(F.lit(0), size - 1))).select(
        *at(place, 1), "id", "n", ((place == 0) | (letter != F.substring("word", place, F.lit(1)))).alias("first")
    )
    inserting = tries.withColumn("place", F.explode(F.sequence(F.lit(0), size))).select(*at(place, 0), "id", "n")
    return skipping, inserting


def near_words(words: DataFrame) -> DataFrame:
    """(id, near_id, near_n) of all pairs of near words, in both directions; ``words`` has id, n, word, prefixes, suffixes."""
    skipping, inserting = _pairs(words)
    other = skipping.select("prefix", "suffix", F.col("id").alias("near_id"), F.col("n").alias("near_n"), F.lit(False).alias("longer")).unionByName(
        inserting.select("prefix", "suffix", F.col("id").alias("near_id"), F.col("n").alias("near_n"), F.lit(True).alias("longer"))
    )
    met = skipping.join(other, ["prefix", "suffix"]).filter(F.when(F.col("longer"), F.col("first")).otherwise(F.col("id") != F.col("near_id")))
    there = F.struct("id", "near_id", "near_n")
    back = F.struct(F.col("near_id").alias("id"), F.col("id").alias("near_id"), F.col("n").alias("near_n"))
    # A join of two skipping pairs gives both directions already.
    both = F.when(F.col("longer"), F.array(there, back)).otherwise(F.array(there))
    return met.select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) of the words with a form, by doubling: counts grow along forms, so there is no cycle."""
    reached = materialize(forms.select("id", F.col("form_id").alias("root")), "roots")
    while True:
        on = reached.select(F.col("id").alias("root"), F.col("root").alias("next"))
        further = materialize(
            reached.join(on, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        if not further.agg(F.bool_or("moved")).first()[0]:
            return further.select("id", "root")
        reached = further.select("id", "root")


def spelling_variants(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    letters: int = MIN_LETTERS,
    least: int = MIN_COUNT,
    ratio: int = FORM_RATIO,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of all frequent words."""
    words = materialize(count_words(df, key, text, letters, least), "words")
    return group_variants(words, ratio)


def group_variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """The same for given (word, n), distinct and without nulls or empty words."""
    n_words = words.count()
    forward = number_trie(words, n_words, F.col("word")).withColumnRenamed("nodes", "prefixes")
    backward = number_trie(words.select("word"), n_words, F.reverse("word")).withColumnRenamed("nodes", "suffixes")
    # The node of a whole word is its id; ids sort like words.
    numbered = materialize(
        forward.join(backward, "word").withColumn("id", F.get("prefixes", F.size("prefixes") - 1)), "numbered_words"
    )
    best = F.max(F.struct("near_n", (-F.col("near_id")).alias("first")))
    near = near_words(numbered).groupBy("id").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = F.col("best.near_n") >= ratio * F.col("n")
    found = materialize(
        numbered.select("id", "word", "n")
        .join(near, "id", "left")
        .select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, -F.col("best.first")).alias("form_id"),
            F.when(is_form, F.col("best.near_n")).alias("form_n"),
        ),
        "near_words",
    )
    roots = _roots(found.filter("form_id IS NOT NULL"))
    names = numbered.select(F.col("id").alias("name_id"), F.col("word").alias("name"))
    named = (
        found.filter("form_id IS NOT NULL")
        .select("id", "form_id")
        .join(roots, "id")
        .join(names.select(F.col("name_id").alias("form_id"), F.col("name").alias("form")), "form_id")
        .join(names.select(F.col("name_id").alias("root"), F.col("name").alias("root_word")), "root")
        .select("id", "form", "root_word")
    )
    return found.join(named, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
