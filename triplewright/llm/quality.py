"""Quality rules as a ledger of bitmasks.

Every rule is evaluated once per text. The ledger keeps, per row, all measurements and one
64-bit integer with a bit per failed rule; the texts are no longer needed. Policies are
versioned sets of rules: a row is kept when none of the policy's bits is set. Changing a
policy, or asking what each rule alone removes, is bit arithmetic on the ledger.

Defined results: a null text measures as an empty one (it fails ``few_words``). Rows are
judged one by one, so repeated rows, null ids and an empty table need no special case.
Measurement columns replace columns of the same name in the input; other columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplewright.llm.batches import Columns, add_columns
from triplewright.llm.words import SEPARATORS, utf8, window_hashes, word_hashes

WINDOW_WORDS = 8
_SYMBOLS = b"#*$%&|<>"
_MEASURES = ", ".join(
    f"{name} long"
    for name in (
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines",
        "n_letters",
        "n_exclamations",
    )
)


@dataclass(frozen=True)
class Rule:
    """A failure condition in SQL over the measurements. The place in RULES is its bit."""

    name: str
    fails: str


# New rules are added at the end, so stored bits keep their meaning.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("few_letters", "10 * n_letters < 4 * word_chars"),
    Rule("many_exclamations", "5 * n_exclamations > n_words"),
    Rule("very_long", "n_words > 1000000"),
)

# Fixed versions: what a version enforces never changes, a new version is added instead.
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: (
        "few_words",
        "repeated_words",
        "many_symbols",
        "short_words",
        "long_words",
        "repeated_lines",
        "few_letters",
        "many_exclamations",
    ),
}
CURRENT_POLICY = 2


def _lines(data: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [line for line in data.split(b"\n") if line.strip(SEPARATORS)]
    return len(lines), len(lines) - len(set(lines))


def _letters(text: str) -> int:
    """Letters of any script."""
    if text.isascii():
        data = text.encode()
        return len(data) - len(data.translate(None, _ASCII_LETTERS))
    return sum(map(str.isalpha, text))


_ASCII_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))


def _measured(column: list[str | None]) -> Columns:
    """All measurements of a batch of texts."""
    strings = ["" if text is None else text for text in column]
    texts = [utf8(text) for text in strings]
    n_words = np.zeros(len(texts), dtype=np.int64)
    repeated = np.zeros(len(texts), dtype=np.int64)
    for rows, hashes, bounds in word_hashes(texts, lower=False):
        where = slice(rows.start, rows.stop)
        n_words[where] = np.diff(bounds)
        repeated[where] = _repeated_words(hashes, bounds)
    lines = [_lines(data) for data in texts]
    return {
        "n_words": n_words,
        "word_chars": [len(s) - (len(d) - len(d.translate(None, SEPARATORS))) for s, d in zip(strings, texts)],
        "n_symbols": [len(d) - len(d.translate(None, _SYMBOLS)) for d in texts],
        "n_dup_lines": [copies for _, copies in lines],
        "n_repeat_words": repeated,
        "n_lines": [n for n, _ in lines],
        "n_letters": [_letters(s) for s in strings],
        "n_exclamations": [d.count(b"!") for d in texts],
    }


def _repeated_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in a window occurring at least twice in that text."""
    covered = np.zeros(len(hashes) + 1, dtype=np.int64)
    if len(hashes) >= WINDOW_WORDS:
        text_of = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
        windows = window_hashes(hashes, WINDOW_WORDS)
        first = np.flatnonzero(text_of[: len(windows)] == text_of[WINDOW_WORDS - 1 :])
        keys = windows[first] + text_of[first] * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        starts = first[order[twice]]
        covered[starts] += 1
        covered[starts + WINDOW_WORDS] -= 1
        covered = (np.cumsum(covered) > 0).astype(np.int64)
    totals = np.concatenate([[0], np.cumsum(covered[: len(hashes)])])
    return totals[bounds[1:]] - totals[bounds[:-1]]


def measure(df: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The rows with all measurements of ``text``; without the text unless ``keep_text``."""
    return add_columns(df, [text], _MEASURES, _measured, drop=not keep_text)


def failure_bits() -> Column:
    """One bit per failed rule."""
    bits = F.lit(0).cast("long")
    for place, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << place)).otherwise(0).cast("long"))
    return bits


def ledger(df: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Measurements and ``failed_bits`` of every row."""
    return measure(df, text, keep_text).withColumn("failed_bits", failure_bits())


def policy_mask(version: int) -> int:
    """The bits a policy enforces."""
    places = {rule.name: place for place, rule in enumerate(RULES)}
    return sum(1 << places[name] for name in POLICIES[version])


def apply_policy(ledger_df: DataFrame, version: int = CURRENT_POLICY, column: str = "kept") -> DataFrame:
    """Add whether each row passes the policy."""
    mask = F.lit(policy_mask(version)).cast("long")
    return ledger_df.withColumn(column, F.col("failed_bits").bitwiseAND(mask) == 0)


def ablation(ledger_df: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """Per rule of a policy: rows it fails, rows only it removes, rows the policy removes.

    The ledger is first counted by bit pattern, of which there are at most 2**rules.
    """
    mask = policy_mask(version)
    patterns = (
        ledger_df.select(F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
        .groupBy("bits")
        .agg(F.count("*").alias("n"))
    )
    listed = F.array(
        *[
            F.struct(F.lit(rule.name).alias("rule"), F.lit(1 << place).cast("long").alias("bit"))
            for place, rule in enumerate(RULES)
            if mask >> place & 1
        ]
    )
    return (
        patterns.select("bits", "n", F.inline(listed))
        .groupBy("rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
            F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("n_removed"),
        )
    )
