"""Licence detection by ordered signature rules, in native expressions only.

Texts become lower-cased words between single spaces. A few plain strings tell which texts
need a closer look; of those, each distinct content is examined once: a rule's keyword is
searched first, its regular expression runs only where the keyword occurs. Matches are word
intervals. A match is suppressed when another one contains it and has the same or a higher
priority (of equal intervals and priorities, the earlier rule stays). What is left gives
labels and a score, the highest confidence.

Defined results: a null text has no words. Equal texts, hot or not, are examined once.
Other columns pass through; result columns replace input columns of the same names. An
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplewright.llm.license_rules import GATE, RAW_GATE, RULES
from triplewright.session import materialize

# Phrase and label of the base detections.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def spaced_words(text: Column) -> Column:
    """The lower-cased words, each with one space before and after it; one space without words."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), _BETWEEN_WORDS, " ")


def _spaces(words: Column) -> Column:
    return F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))


def _whole_words(regex: str) -> str:
    return f"(?<= )(?:{regex})(?= )"


def _phrase_places(words: Column, phrase: str) -> Column:
    """(n, first, last): occurrences of a phrase and their smallest and largest first word."""
    parts = F.split(words, _whole_words(phrase), -1)
    found = F.struct(
        (F.size(parts) - 1).cast("long").alias("n"),
        (_spaces(F.element_at(parts, 1)) - 1).cast("long").alias("first"),
        (_spaces(words) - _spaces(F.element_at(parts, -1)) - F.lit(phrase.count(" ")) - 1).cast("long").alias("last"),
    )
    return F.when(F.contains(words, F.lit(f" {phrase} ")), found)


def base_places(df: DataFrame, words: str) -> DataFrame:
    """Add the base detections of a column of spaced words."""
    column = F.col(words)
    for i, phrase in enumerate(BASE):
        df = df.withColumn(f"__base{i}", _phrase_places(column, phrase))
    found = [F.col(f"__base{i}") for i in range(len(BASE))]
    labels = F.array_compact(F.array(*[F.when(f.isNotNull(), F.lit(label)) for f, label in zip(found, BASE.values())]))
    return df.withColumns(
        {
            "n_base": reduce(Column.__add__, [F.coalesce(f["n"], F.lit(0).cast("long")) for f in found]),
            "first_word": F.least(*[f["first"] for f in found]),
            "last_word": F.greatest(*[f["last"] for f in found]),
            "__base_labels": labels,
        }
    ).drop(*[f"__base{i}" for i in range(len(BASE))])


def _rule_literals() -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("rule"),
                F.lit(rule.label).alias("label"),
                F.lit(rule.priority).alias("priority"),
                F.lit(rule.confidence).alias("confidence"),
                F.lit(rule.keyword).alias("keyword"),
                F.lit(_whole_words(rule.regex)).alias("regex"),
            )
            for i, rule in enumerate(RULES)
        ]
    )


def detections(contents: DataFrame, key: str, words: str) -> DataFrame:
    """(key, rule, label, priority, confidence, first_word, last_word) of all matches that stay.

    ``contents`` has one row per key.
    """
    tried = contents.select(
        key, words, F.inline(F.filter(_rule_literals(), lambda rule: F.contains(F.col(words), rule["keyword"])))
    )
    # Matches and the text before each, in turn; both as numbers of spaces.
    matches = F.regexp_extract_all(words, F.col("regex"), F.lit(0))
    gaps = F.split(words, F.col("regex"), -1)
    pieces = F.zip_with(
        matches,
        F.slice(gaps, 1, F.size(gaps) - 1),
        lambda match, gap: F.struct(_spaces(gap).alias("gap"), _spaces(match).alias("inside")),
    )
    turns = tried.select(
        key, "rule", "label", "priority", "confidence", F.posexplode(pieces).alias("turn", "piece")
    )
    in_order = Window.partitionBy(key, "rule").orderBy("turn")
    last = F.sum(F.col("piece.gap") + F.col("piece.inside")).over(in_order) - 1
    spans = turns.withColumn("last_word", last).withColumn("first_word", F.col("last_word") - F.col("piece.inside"))
    # In this order whatever contains a match stands before it.
    outer_first = Window.partitionBy(key).orderBy(
        "first_word", F.col("last_word").desc(), F.col("priority").desc(), "rule"
    ).rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted({rule.priority for rule in RULES})
    for level in levels:
        reach = F.max(F.when(F.col("priority") >= level, F.col("last_word"))).over(outer_first)
        spans = spans.withColumn(f"reach{level}", reach)
    own_reach = F.coalesce(*[F.when(F.col("priority") == level, F.col(f"reach{level}")) for level in levels])
    stays = own_reach.isNull() | (own_reach < F.col("last_word"))
    return spans.filter(stays).select(key, "rule", "label", "priority", "confidence", "first_word", "last_word")


def _any_of(column: str, words: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.contains(column, F.lit(word)) for word in words])


def _once(expression: Column) -> Column:
    """The expression as a generated column: filters on it then read its value, where they would
    otherwise be moved below and evaluate the expression once for each word they look for."""
    return F.explode(F.array(expression))


def scan_licenses(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by n_words, the base detections, and labels and score of all detections."""
    rows = (
        df.drop(*[c for c in RESULTS if c != text])
        .withColumn("__n_words", F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(_WORD)).cast("long"))
        .withColumn("__content", F.md5(text))
        .drop(text)
        .withColumnRenamed("__n_words", "n_words")
    )
    marked = (
        df.select(F.col(text).alias("__text"))
        .select("__text", _once(F.lower("__text")).alias("__lower"))
        .filter(_any_of("__lower", RAW_GATE))
        .select("__text", _once(spaced_words(F.col("__text"))).alias("__words"))
        .filter(_any_of("__words", GATE))
    )
    contents = marked.select(F.md5("__text").alias("__content"), "__words").dropDuplicates(["__content"])
    contents = materialize(contents, "license_texts")
    found = (
        detections(contents, "__content", "__words")
        .groupBy("__content")
        .agg(F.collect_set("label").alias("__labels"), F.max("confidence").alias("__score"))
    )
    judged = base_places(contents, "__words").drop("__words").join(found, "__content", "left")
    nothing = F.array().cast("array<string>")
    both = F.array_union(F.coalesce("__base_labels", nothing), F.coalesce("__labels", nothing))
    # One row per marked content: copies of a content are split over tasks by adaptive execution.
    return (
        rows.join(judged, "__content", "left")
        .withColumns(
            {
                "n_base": F.coalesce("n_base", F.lit(0).cast("long")),
                "base_labels": F.array_join(F.array_sort(F.array_distinct(F.coalesce("__base_labels", nothing))), ","),
                "labels": F.array_join(F.array_sort(F.array_distinct(both)), ","),
                "score": F.coalesce("__score", F.lit(0.0)),
            }
        )
        .drop("__content", "__base_labels", "__labels", "__score")
    )
